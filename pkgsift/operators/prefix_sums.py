"""Running totals over very large groups, without sorting a group in one task."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows that a cell of the hash order should hold.
CELL_ROWS = 20_000


def md5_order(seed: int, key: Column) -> Column:
    """An order that a seed shuffles: the MD5 digest of seed and key, in hexadecimal."""
    return F.md5(F.concat(F.lit(f"{seed}|"), key.cast("string")))


def running_total(df: DataFrame, group: list[str], order: str, weight: Column, out: str = "before", ties: list[str] | None = None,
                  rows: int | None = None, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Add ``out``: the sum of ``weight`` over the rows of the same ``group`` that
    come earlier by ``order`` (a hexadecimal digest) and then by ``ties``.

    Cells of the digest's first digits are summed first (partial sums run before the
    shuffle); a row then needs its cell's total so far and the rows of its own
    cell, which the digest keeps to about ``cell_rows`` unless they share one digest.
    """
    rows = df.count() if rows is None else rows
    digits = max(1, math.ceil(math.log(max(2, rows / cell_rows), 16)))
    placed = df.withColumns({"_cell": F.substring(order, 1, digits), "_w": weight.cast("bigint")})
    cells = placed.groupBy(*group, "_cell").agg(F.sum("_w").alias("_sum"))
    earlier = Window.partitionBy(*group).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    before = cells.select(*(F.col(g).alias(f"_of_{g}") for g in group), F.col("_cell").alias("_of"), F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_off"))
    same = F.col("_cell") == F.col("_of")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_of_{g}"))
    own = Window.partitionBy(*group, "_cell").orderBy(order, *(ties or [])).rowsBetween(Window.unboundedPreceding, -1)
    return (placed.join(before, same).withColumn(out, F.col("_off") + F.coalesce(F.sum("_w").over(own), F.lit(0)))
            .select(*df.columns, out))
