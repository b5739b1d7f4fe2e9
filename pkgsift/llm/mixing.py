"""Mixing sources to target weights by capped water-filling (operator 4).

Every source has a weight and a size; the targets share the total size by
weight.  A source is clamped at ``max_epochs`` times its size and the excess is
shared among the others by weight until no source is above: sorted by size per
weight, the clamped sources are a prefix, so one pass of running sums finds the
level.

A source's documents are then repeated: the whole part of target / size for all
of them, and once more for those that stand first in a seeded hash order, up to
the words still missing.  The place where that order is cut is found from sums
per hash bucket and the documents of one bucket, so no task sees a whole source,
and every document can tell its own copies from its source's plan row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pkgsift.llm.common import table

#: Hash buckets of one source: 16 ** BUCKET_DIGITS.
BUCKET_DIGITS = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _order(doc_id: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))))


def water_fill(sizes: DataFrame, weights: tuple[int, ...], max_epochs: int) -> DataFrame:
    """source, source_size, target from (source, source_size), one row per source.

    Weights repeat over the sources in code point order, null last.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array([F.lit(w) for w in weights]), (place % len(weights) + 1).cast("int"))
    rows = sizes.withColumn("w", weight.cast("long")).withColumn("cap", max_epochs * F.col("source_size"))
    order = Window.orderBy((F.col("cap") / F.col("w")).asc(), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    behind = order.rowsBetween(0, Window.unboundedFollowing)
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.select("*", (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))).alias("left"),
                       F.sum("w").over(behind).alias("share"))
    rows = rows.withColumn("level", F.col("left").cast("double") / F.col("share"))
    # the level of the first source that stays below its cap holds for all behind it
    fits = F.when(F.col("level") * F.col("w") <= F.col("cap"), F.struct((F.col("cap") / F.col("w")).alias("r"), F.col("level").alias("l")))
    level = F.min(fits).over(everything)["l"]
    return rows.select("source", "source_size", F.least(F.col("cap").cast("double"), level * F.col("w")).alias("target"))


def mix_plan(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), max_epochs: int = 3, seed: int = 42,
             id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per source: source, source_size, target, whole, cut, cut_size.

    Every document of the source is taken ``whole`` times, and once more if its
    (hash, size) is at most (cut, cut_size).
    """
    narrow = table(docs.select(F.col(source_col).cast("string").alias("source"), word_count(F.col(text_col)).alias("size"),
                               _order(F.col(id_col), seed).alias("h"))
                   .groupBy("source", "h", "size").agg(F.count("*").alias("copies"))
                   .withColumn("bucket", F.substring("h", 1, BUCKET_DIGITS)).withColumn("words", F.col("size") * F.col("copies")), "sizes")
    buckets = table(narrow.groupBy("source", "bucket").agg(F.sum("words").alias("words")), "buckets")
    plan = water_fill(buckets.groupBy("source").agg(F.sum("words").alias("source_size")), weights, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    plan = table(plan.withColumn("whole", whole).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")), "plan")

    running = Window.partitionBy("source").orderBy("bucket")
    ends = buckets.withColumn("end", F.sum("words").over(running))
    key = plan.select(F.col("source").alias("of"), "rest")
    here = F.col("source").eqNullSafe(F.col("of"))
    edge = (ends.join(key, here).where("end > rest").groupBy("source", "rest")
            .agg(F.min(F.struct("bucket", (F.col("end") - F.col("words")).alias("begin"))).alias("e"))
            .select(F.col("source").alias("of"), "rest", F.col("e.bucket").alias("edge"), F.col("e.begin").alias("begin")))
    edge = table(edge, "edge")
    inner = Window.partitionBy("source").orderBy("h", "size").rowsBetween(Window.unboundedPreceding, -1)
    last = (narrow.join(edge, here & (F.col("bucket") == F.col("edge")))
            .withColumn("ahead", F.col("begin") + F.coalesce(F.sum("words").over(inner), F.lit(0)))
            .where(2 * F.col("ahead") + F.col("size") <= 2 * F.col("rest"))
            .groupBy("source").agg(F.max(F.struct("h", "size")).alias("m")))
    plan = (plan.join(edge.select("of", "edge"), here, "left").drop("of")
            .join(last.select(F.col("source").alias("of"), "m"), here, "left").drop("of"))
    # without a cut bucket the rest takes all; in a cut bucket of which nothing fits, all before it
    return table(plan.select("source", "source_size", "target", "whole", F.coalesce("m.h", "edge", F.lit("g")).alias("cut"),
                             F.coalesce("m.size", F.lit(-1)).alias("cut_size")), "plan")


def _copies(docs: DataFrame, plan: DataFrame, seed: int, id_col: str, source_col: str, size: Column) -> DataFrame:
    """``docs`` with the plan's columns and ``_copies``; joined on the source alone,
    where the skew rule splits a hot source."""
    p = plan.select(*(F.col(c).alias(f"_{c}") for c in plan.columns))
    joined = docs.join(p, F.col(source_col).cast("string").eqNullSafe(F.col("_source")))
    h = _order(F.col(id_col), seed)
    more = (h < F.col("_cut")) | ((h == F.col("_cut")) & (size <= F.col("_cut_size")))
    return joined.withColumn("_copies", F.col("_whole") + more.cast("long"))


def mix_report(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), max_epochs: int = 3, seed: int = 42,
               id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, size, source_size, target, taken: per row, the words the mix takes.

    A null or empty text has size 0 and takes 0; a null source is a source of its
    own; sources without words get no target.  Repeated rows (equal id and size)
    fare alike.  Texts of any length count whole.  Other columns are ignored; an
    empty table gives no rows.
    """
    plan = mix_plan(docs, weights, max_epochs, seed, id_col, text_col, source_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"))
    return _copies(rows, plan, seed, "doc_id", "source", F.col("size")).select(
        "doc_id", "size", F.col("_source_size").alias("source_size"), F.col("_target").alias("target"), (F.col("size") * F.col("_copies")).alias("taken"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), max_epochs: int = 3, seed: int = 42,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mixture itself: the columns of ``docs``, each row as often as it is taken."""
    plan = mix_plan(docs, weights, max_epochs, seed, id_col, text_col, source_col)
    dealt = _copies(docs, plan, seed, id_col, source_col, word_count(F.col(text_col)))
    one = dealt.where("_copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    return one.select(*docs.columns)


#: The same in DuckDB, for weights 5, 2, 1, three epochs and seed 42.
ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5('42:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS h
  FROM documents),
g AS (SELECT source, h, size, count(*) AS copies FROM d GROUP BY ALL),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w, 3 * source_size AS cap FROM s),
l AS (
  SELECT *, CAST((SELECT sum(source_size) FROM s)
                 - coalesce(sum(cap) OVER (ORDER BY CAST(cap AS DOUBLE) / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
            / CAST(sum(w) OVER (ORDER BY CAST(cap AS DOUBLE) / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
  FROM w),
v AS (SELECT level FROM l WHERE level * w <= cap ORDER BY CAST(cap AS DOUBLE) / w, level LIMIT 1),
p AS (
  SELECT source, source_size, least(CAST(cap AS DOUBLE), (SELECT level FROM v) * w) AS target,
         CASE WHEN source_size > 0 THEN floor(least(CAST(cap AS DOUBLE), (SELECT level FROM v) * w) / source_size) ELSE 0 END AS whole
  FROM l),
c AS (
  SELECT g.*, p.source_size, p.target, p.whole, p.target - p.whole * p.source_size AS rest,
         coalesce(sum(g.size * g.copies) OVER (PARTITION BY g.source ORDER BY h, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM g JOIN p ON g.source IS NOT DISTINCT FROM p.source)
SELECT d.doc_id, d.size, c.source_size, c.target,
       CAST(d.size * (c.whole + CASE WHEN 2 * c.ahead + c.size <= 2 * c.rest THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM d JOIN c ON d.source IS NOT DISTINCT FROM c.source AND d.h = c.h AND d.size = c.size
"""
