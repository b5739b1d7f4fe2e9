"""Padded token batches for training (R4): truncation, batches of like length,
padding to each batch's longest row, attention mask and completion-only labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pkgsift.functions.prompts import completion_mask, template_start
from pkgsift.operators.prefix_sums import md5_order, running_total
from pkgsift.operators.split import _stored


def token_batches(df: DataFrame, key: str, ids_col: str, template: Column, batch_size: int, max_length: int, pad_id: int = 0,
                  bucket_width: int = 64, seed: int = 42) -> DataFrame:
    """Every row with ``batch``, ``input_ids``, ``attention_mask`` and ``labels``.

    Rows are truncated to ``max_length`` tokens and dealt, in an order that
    ``seed`` shuffles, to batches of ``batch_size`` among rows whose lengths fall
    in the same ``bucket_width``; only the last batch of a length is smaller.
    Batches are numbered from 0, shortest lengths first.  All rows of a batch are
    padded to its longest one.  Labels are the ids from the last ``template`` on,
    ``IGNORE_INDEX`` before it, at padding, and everywhere if it is missing.

    Rows get their places from sums over cells of the order, so no length,
    however common, is sorted in one task; ``key`` should be distinct (rows that
    share a key share a cell).  Null ids count as an empty row.
    """
    ids = F.slice(F.coalesce(F.col(ids_col), F.array().cast("array<int>")), 1, max_length)
    rows = _stored(df.withColumn(ids_col, ids).withColumns({
        "_bucket": F.floor(F.size(ids_col) / F.lit(bucket_width)).cast("int"), "_order": md5_order(seed, F.coalesce(F.col(key).cast("string"), F.lit(""))),
        "_row": F.monotonically_increasing_id()}), "batch-rows")
    sizes = rows.groupBy("_bucket").agg(F.count("*").alias("n"))
    first = (sizes.withColumn("batches", F.ceil(F.col("n") / F.lit(batch_size)).cast("bigint"))
             .select(F.col("_bucket").alias("_b"), F.coalesce(F.sum("batches").over(
                 Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_first")))  # one row per length
    # places first, on narrow rows; the ids move once, to their batch
    narrow = running_total(rows.select(F.col(key).alias("_key"), "_row", "_bucket", "_order"), ["_bucket"], "_order", F.lit(1), "_place", ["_key", "_row"])
    placed = narrow.join(first, F.col("_bucket") == F.col("_b")).select(
        "_row", (F.col("_first") + F.floor(F.col("_place") / F.lit(batch_size))).cast("bigint").alias("batch"))
    dealt = rows.join(placed, "_row").drop("_row", "_bucket", "_order")
    width = F.max(F.size(ids_col)).over(Window.partitionBy("batch"))
    marked = dealt.withColumns({"_start": template_start(F.col(ids_col), template), "_n": F.size(ids_col), "_width": width})
    blank = F.greatest(F.col("_width") - F.col("_n"), F.lit(0))
    return marked.withColumns({
        "input_ids": F.concat(F.col(ids_col), F.array_repeat(F.lit(pad_id), blank)),
        "attention_mask": F.concat(F.array_repeat(F.lit(1), F.col("_n")), F.array_repeat(F.lit(0), blank)),
        "labels": F.concat(completion_mask(F.col(ids_col), F.col("_start")), F.array_repeat(F.lit(-100), blank)),
    }).drop("_start", "_n", "_width", ids_col)
