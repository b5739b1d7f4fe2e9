"""Groups that must not be torn apart: values linked by shared keys, transitively."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pkgsift.operators.split import _stored


def linked_groups(df: DataFrame, node: str, shared: list[str]) -> DataFrame:
    """(node, group): the smallest ``node`` value that is reachable through equal
    values of any ``shared`` column, for every distinct ``node`` (nulls link nothing).

    Each shared value links its nodes to the smallest of them, one narrow row per
    node.  Then every node takes the smallest label among its neighbours, and its label's label, until nothing
    changes: each round is a pre-aggregated minimum and two equi-joins, and the
    labels' own jumps halve the way, so rounds grow with the logarithm of a chain.
    """
    nodes = df.select(F.col(node).alias("u")).where("u is not null").distinct()
    edges = None
    for key in shared:
        pairs = df.select(F.col(key).alias("k"), F.col(node).alias("u")).where("k is not null and u is not null").distinct()
        low = pairs.groupBy("k").agg(F.min("u").alias("v"))
        own = pairs.join(low, "k").where("u != v").select("u", "v")
        edges = own if edges is None else edges.union(own)
    edges = _stored(edges.distinct(), "group-edges")
    both = edges.union(edges.select("v", "u")).toDF("u", "v")
    labels = _stored(nodes.withColumn("l", F.col("u")), "group-labels")
    while True:
        near = (both.join(labels.withColumnRenamed("u", "v"), "v").groupBy("u").agg(F.min("l").alias("m")))
        moved = labels.join(near, "u", "left").select("u", F.col("l").alias("old"), F.least("l", F.coalesce("m", "l")).alias("l"))
        # hook: a label's holder takes the smallest label any of its members has found
        hooks = moved.groupBy(F.col("old").alias("h")).agg(F.min("l").alias("hl"))
        jumped = _stored(moved.join(hooks, moved["l"] == hooks["h"], "left")
                         .select("u", "old", F.least("l", F.coalesce("hl", "l")).alias("l")), "group-labels")
        if jumped.where("l != old").isEmpty():
            return jumped.select(F.col("u").alias(node), F.col("l").alias("group"))
        labels = jumped.select("u", "l")
