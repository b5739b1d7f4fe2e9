"""Exact metric range join of embeddings within a label (operator 8).

Unit vectors with cosine >= c lie within the distance r = sqrt(2 - 2c).  Pivots
of a label split its vectors into cells, each vector at home with its nearest
pivot.  By the triangle inequality a vector v can have a partner in the cell of
pivot q only if d(v, q) - d(v, home) <= 2 r (its partner u has
d(u, q) <= d(u, home pivot of v)), so v visits exactly those cells.  Each cell is
joined on its own: home vectors in blocks of bounded size, visitors streamed
past them.

Equal vectors form one class and are compared once.  Counts come from the
blocks; only one edge per vector and block leaves them, so a dense group costs
arithmetic, not rows.  How far cells prune depends on the data: vectors spread
evenly over many dimensions visit nearly all cells.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pkgsift.llm.common import bounded_batches, table
from pkgsift.llm.components import connected_components

#: Home vectors that a cell aims at, and most home vectors of one block.
CELL = 2048
BLOCK = 2048
#: Most pivots of one label (a task holds one label's pivots at a time).
MAX_PIVOTS = 256
#: Most rows of pivots in all, so that they can be broadcast.
MAX_PIVOT_ROWS = 16_384
#: Numerical slack on distances.
SLACK = 1e-9


def unit(values: list | None) -> np.ndarray | None:
    """The vector scaled to length 1, in double precision; None if it has none."""
    if not values or any(x is None for x in values):
        return None
    v = np.asarray(values, np.float64)
    top = np.abs(v).max()
    if not np.isfinite(v).all() or top == 0:
        return None
    v = v / top
    return v / np.sqrt(v @ v)


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (x @ pivots.T)))


def _classes(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> tuple[DataFrame, DataFrame]:
    """(vec_id, class key) of every row, and one row per class of usable vectors."""
    v = F.col(vector_col).cast("array<double>")
    usable = (F.col(label_col).isNotNull() & v.isNotNull() & (F.size(v) > 0)
              & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0))
    # -0.0 and 0.0 are one value; the shortest decimals of the values, with the label, name a class
    same = F.transform(v, lambda x: x + F.lit(0.0))
    key = F.when(usable, F.sha2(F.concat_ws(",", F.col(label_col).cast("string"), same.cast("string")), 256))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), key.alias("key"), F.col(label_col).cast("string").alias("label"), same.alias("v"))
    classes = (rows.where("key is not null").groupBy("key")
               .agg(F.min("vec_id").alias("id"), F.count("*").alias("copies"), F.first("label").alias("label"), F.first("v").alias("v"))
               .where("id is not null"))
    return rows.select("vec_id", "key"), classes


def _pivots(classes: DataFrame, cell: int) -> dict[tuple[str, int], np.ndarray]:
    """Pivots per (label, dimension): class vectors of least key, about one per
    ``cell`` classes, at most ``MAX_PIVOTS`` each and ``MAX_PIVOT_ROWS`` in all."""
    from pyspark.sql import Window

    sizes = classes.groupBy("label", F.size("v").alias("dim")).agg(F.count("*").alias("n")).where(F.col("n") > cell)
    want = sizes.withColumn("want", F.least(F.ceil(F.col("n") / cell), F.lit(MAX_PIVOTS)).cast("int"))
    # a hash range expected to hold twice the wanted number keeps the ranking small
    place = F.pmod(F.xxhash64("key"), F.lit(1 << 30)) / float(1 << 30)
    near = (classes.withColumn("dim", F.size("v")).join(want, ["label", "dim"])
            .where(place <= 2.0 * F.col("want") / F.col("n") + 8.0 / F.col("n")))
    first = Window.partitionBy("label", "dim").orderBy("key")
    picked = near.withColumn("k", F.row_number().over(first)).where("k <= want").orderBy("k", "label", "dim").limit(MAX_PIVOT_ROWS)
    out: dict[tuple[str, int], list] = {}
    for r in sorted(picked.select("label", "dim", "k", "v").collect(), key=lambda r: (r["label"], r["dim"], r["k"])):
        out.setdefault((r["label"], r["dim"]), []).append(unit(r["v"]))
    return {k: np.stack(v) for k, v in out.items()}


def _place(classes: DataFrame, radius: float, cell: int, block: int) -> DataFrame:
    """Rows (label, dim, cell, block, kind, id, copies, v): each class at home once
    (kind 0) and as a visitor (kind 1) of every block of every cell it may have
    partners in."""
    spark = classes.sparkSession
    pivots = spark.sparkContext.broadcast(_pivots(classes, cell))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, vs = batch.column(1).to_pylist(), batch.column(3).to_pylist()
            homes, visits = [], []
            by_label: dict = {}
            for k, (lab, v) in enumerate(zip(labels, vs)):
                by_label.setdefault((lab, len(v)), []).append(k)
            homes, visits = [0] * len(vs), [[0]] * len(vs)
            for key, own in by_label.items():
                p = pivots.value.get(key)
                if p is None or len(p) < 2:
                    continue
                d = _distances(np.stack([unit(vs[k]) for k in own]), p)
                home = d.argmin(1)
                near = d - d[np.arange(len(own)), home][:, None] <= 2 * radius + SLACK
                for j, k in enumerate(own):
                    homes[k], visits[k] = int(home[j]), np.flatnonzero(near[j]).tolist()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), batch.column(3),
                                              pa.array(homes, pa.int32()), pa.array(visits, pa.list_(pa.int32()))],
                                             names=["id", "label", "copies", "v", "home", "visits"])

    placed = classes.select("id", "label", "copies", "v").mapInArrow(
        run, "id long, label string, copies long, v array<double>, home int, visits array<int>")
    placed = table(placed.withColumn("dim", F.size("v")), "placed")
    blocks = placed.groupBy("label", "dim", F.col("home").alias("cell")).agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    # a home vector's block is a hash of its id: blocks hold about ``block`` vectors
    part = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    home = placed.withColumn("cell", F.col("home")).join(blocks, ["label", "dim", "cell"]).withColumn("block", part).withColumn("kind", F.lit(0))
    guest = (placed.withColumn("cell", F.explode("visits")).join(blocks, ["label", "dim", "cell"])
             .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("kind", F.lit(1)))
    cols = ["label", "dim", "cell", "block", "kind", "id", "copies", "v"]
    return home.select(*cols).unionByName(guest.select(*cols))


def _join_cells(placed: DataFrame, cosine: float) -> DataFrame:
    """(id, other, links): per visitor and block, how many home vectors it links
    to (copies counted, itself not) and one of them, or null; homes that share a
    visitor come out linked to one of theirs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = [("id", pa.int64()), ("other", pa.int64()), ("links", pa.int64())]
        now, ids, copies, vectors, home, part = None, [], [], [], None, None

        def rows(a, b, n):
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, (_, t) in zip((a, b, n), kind)], names=[k for k, _ in kind])

        def merged():
            """Home vectors joined through visitors, each to the first of its group."""
            if home is None:
                return rows([], [], [])
            own = np.asarray(ids)
            moved = np.flatnonzero(part != np.arange(len(part)))
            return rows(own[moved], own[part[moved]], np.zeros(len(moved), int))

        for batch in batches:
            cols = [batch.column(k).to_pylist() for k in range(8)]
            guests: list[int] = []

            def flush():
                nonlocal home, part
                if home is None:
                    home, part = np.stack(vectors), np.arange(len(ids))
                out = ([], [], [])
                weights, own = np.asarray(copies), np.asarray(ids)
                for a in range(0, len(guests), 512):
                    some = guests[a:a + 512]
                    hit = np.stack([unit(cols[7][k]) for k in some]) @ home.T >= cosine
                    for row, k in enumerate(some):
                        g = cols[5][k]
                        same = own == g
                        hit[row] |= same
                        linked = np.flatnonzero(hit[row])
                        if not len(linked):
                            continue
                        # its own class counts its other copies
                        out[2].append(int(weights[linked].sum()) - int(same.any()))
                        out[0].append(g)
                        out[1].append(int(own[linked[0]]))
                        if len(linked) > 1:
                            groups = np.unique(part[linked])
                            if len(groups) > 1:
                                part[np.isin(part, groups)] = groups[0]
                return rows(*out)

            for k, key in enumerate(zip(*cols[:4])):
                if key != now:
                    if guests:
                        yield flush()
                        guests.clear()
                    yield merged()
                    now, ids, copies, vectors, home, part = key, [], [], [], None, None
                if cols[4][k] == 0:
                    ids.append(cols[5][k])
                    copies.append(cols[6][k])
                    vectors.append(unit(cols[7][k]))
                elif ids:
                    guests.append(k)
            if guests:
                yield flush()
        yield merged()

    spark = placed.sparkSession
    keys = ["label", "dim", "cell", "block"]
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (placed.repartition(4 * width, *keys).sortWithinPartitions(*keys, "kind", "id")
            .mapInArrow(run, "id long, other long, links long"))


def embedding_components(vectors: DataFrame, cosine: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding",
                         label_col: str = "label", cell: int = CELL, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``vectors``.

    Two rows link when their labels are equal and not null and their cosine, in
    double precision, is at least ``cosine`` (above 0).  n_links counts the other
    rows linked directly, component_id is the smallest vec_id reachable, kept
    says that the row is that one.

    Null or empty vectors, zero vectors and ones with null or non-finite
    components, and rows without a label, link with nothing.  So do vectors of
    different length.  Repeated rows are rows of their own: each links with the
    other.  Vectors are compared by class: a class is named by its smallest id,
    so ids should be distinct; a class without any id links with nothing.  An
    empty table gives no rows.  Other columns are ignored.
    """
    spark = vectors.sparkSession
    bounded_batches(spark)
    rows, classes = _classes(vectors, id_col, vector_col, label_col)
    classes = table(classes, "classes")
    radius = float(np.sqrt(2 - 2 * cosine))
    found = table(_join_cells(_place(classes, radius, cell, block), cosine), "found")
    parts = connected_components(found, "id", "other")
    links = found.groupBy("id").agg(F.sum("links").alias("n_links"))
    named = (classes.select("key", "id").join(links, "id", "left").join(parts.withColumnRenamed("node", "id"), "id", "left")
             .select("key", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component", "id").alias("component_id")))
    return (rows.join(named, "key", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))
