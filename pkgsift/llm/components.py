"""Connected components of an edge table, by alternating stars.

Every round rewrites each edge towards the smallest neighbour.  Rounds are
aggregates and equi-joins over (src, dst) rows; a hub is pre-aggregated on the
map side, its join rows can be split by the skew rule, and no neighbour list is
ever gathered.  Each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pkgsift.llm.common import table


#: Edges (16 bytes each) that one task handles by itself: a shuffle of so few rows
#: costs more than the work.  More edges are dealt out by key.
ONE_TASK_EDGES = 1 << 20


def _star(rows: DataFrame, keep) -> DataFrame:
    low = rows.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return rows.join(low, "u").where(keep)


def connected_components(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """(node, component): the smallest node reachable, for each node of an edge.

    Self-loops, repeated and reversed edges and nulls are allowed and change
    nothing (an edge with a null end is no edge); an empty table gives no rows.
    """
    e = (edges.select(F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v"))
         .where(F.col(src).isNotNull() & F.col(dst).isNotNull() & (F.col(src) != F.col(dst))).distinct())
    e = table(e, "cc")
    few = e.count() <= ONE_TASK_EDGES
    seen = None
    while True:
        e = e.coalesce(1) if few else e
        both = e.select(F.inline(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))))
        large = _star(both, F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = table(large.where("u != v").distinct(), "cc")
        large = large.coalesce(1) if few else large
        # here v < u on every row; the row's own node joins its smallest neighbour too
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.inline(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))))
        e = table(small.where("u != v").distinct(), "cc")
        state = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    roots = e.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
