"""Hard-negative mining over Hilbert-ordered blocks with zone maps (operator 11).

Candidate vectors of integers are range-sorted by label and by their place on a
Hilbert curve, cut into blocks of one label, and written as Parquet with each
block's smallest and largest value per dimension (its zone).  Anchors are cut
into blocks of their own in the same way.

For an anchor and a zone, interval arithmetic bounds every inner product inside
the block from both sides.  A search reads blocks twice.  First, in each group of zones, the block
with the highest bound of the wanted labels: its rows give a score that the last
wanted row has at least.  Then every other block whose interval meets a window of
the anchor at or above that score, and no other.  So the rows found are exact.

Anchors meet all zones in blocks against groups of zones: both numbers are rows
divided by the block size, and no row meets another one outside a chosen block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pkgsift.llm.common import bounded_batches, table

#: Candidates of a block, anchors of a block, and zones that are compared at a time.
BLOCK, ANCHORS, ZONES = 1024, 128, 256
#: Bits of a place on the curve: every dimension gets as many as fit, 1 to 8.
CURVE_BITS = 256
#: Integers up to which doubles are exact.
_EXACT = 1 << 53

#: No score lies beyond these.
_LEAST, _MOST = -(1 << 62), 1 << 62


def hilbert_keys(cells: np.ndarray, bits: int) -> list[bytes]:
    """Places on the Hilbert curve of the rows of ``cells`` (integers of ``bits``
    bits per dimension), as byte strings in the curve's order.

    Each dimension's bits are turned from Gray code cell by cell, highest bit
    first, and then interleaved (the published method of J. Skilling, 2004, for all
    rows at once).
    """
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    if not n:
        return [b""] * len(cells)
    top = 1 << (bits - 1)
    q = top
    while q > 1:
        low = q - 1
        for i in range(n):
            turned = (x[i] & q) != 0
            swapped = np.where(turned, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(turned, low, swapped)
            x[i] ^= swapped
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = top
    while q > 1:
        turn ^= np.where(x[-1] & q, q - 1, 0)
        q >>= 1
    x ^= turn
    planes = (x[None] >> np.arange(bits - 1, -1, -1)[:, None, None]) & 1
    packed = np.packbits(planes.reshape(bits * n, -1).T.astype(np.uint8), axis=1)
    return [row.tobytes() for row in packed]


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of all rows of ``a`` and ``b``: in doubles where
    these are exact, else in 64-bit integers."""
    high = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if high < _EXACT:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def bounds(a: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest inner product of each row of ``a`` with any vector of each zone."""
    up, down = np.maximum(a, 0), np.minimum(a, 0)
    return products(up, low) + products(down, high), products(up, high) + products(down, low)


def _kind(low: int, high: int) -> str:
    """The narrowest integers that hold both ends."""
    return next((k for k in ("<i2", "<i4") if np.iinfo(k).min <= low and high <= np.iinfo(k).max), "<i8")


def _blocks(rows: DataFrame, total: int, scale: dict[int, tuple[int, int]], size: int) -> DataFrame:
    """(block, dim, label, ids, data, low, high): ``rows`` (id, label, dim, v) in
    the order of label and curve, equal rows once, cut into blocks of one label.
    Inside a block rows stand in the order of their ids."""

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims = b.column("dim").to_numpy()
            for d in np.unique(dims).tolist():
                own = b.filter(pa.array(dims == d))
                lo, hi = scale[d]
                bits = max(1, min(8, CURVE_BITS // max(d, 1)))
                v = own.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(own.num_rows, d)
                cells = np.clip((v.astype(np.float64) - lo) / (float(hi) - float(lo) + 1) * (1 << bits), 0, (1 << bits) - 1).astype(np.int64)
                small = v.astype(_kind(lo, hi))
                yield pa.RecordBatch.from_pydict({"id": own.column("id"), "label": own.column("label"), "dim": own.column("dim"),
                                                  "key": hilbert_keys(cells, bits), "v": [x.tobytes() for x in small]}, schema=keyed)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held, now, before = [], None, None
        for row in (r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("id", "v", "label", "dim")))):
            if row == before:  # equal rows stand together
                continue
            before = row
            if held and (now != row[2:] or len(held) == size):
                yield block(number, held, *now)
                held, number = [], number + 1
            now = row[2:]
            held.append(row[:2])
        if held:
            yield block(number, held, *now)

    def block(number: int, held: list[tuple[int, bytes]], label: int, dim: int) -> pa.RecordBatch:
        held = sorted(held)
        data = np.frombuffer(b"".join(v for _, v in held), _kind(*scale[dim])).reshape(len(held), dim)
        return pa.RecordBatch.from_pydict({
            "block": [number], "dim": [dim], "label": [label], "ids": [[i for i, _ in held]], "data": [data.tobytes()],
            "low": [data.min(axis=0).tolist() if dim else []], "high": [data.max(axis=0).tolist() if dim else []]}, schema=cuts)

    keyed = pa.schema([("id", pa.int64()), ("label", pa.int64()), ("dim", pa.int32()), ("key", pa.binary()), ("v", pa.binary())])
    longs = pa.list_(pa.int64())
    cuts = pa.schema([("block", pa.int64()), ("dim", pa.int32()), ("label", pa.int64()), ("ids", longs), ("data", pa.binary()), ("low", longs), ("high", longs)])
    width = max(1, min(-(-total // (4 * size)), 4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    order = ["dim", "label", "key", "id", "v"]
    return (rows.mapInArrow(placed, "id long, label long, dim int, key binary, v binary")
            .repartitionByRange(width, *order).sortWithinPartitions(*order)
            .mapInArrow(cut, "block long, dim int, label long, ids array<long>, data binary, low array<long>, high array<long>"))


def _each(column: pa.Array, k: int) -> pa.Array:
    return column.slice(k, 1).flatten()


class _Anchors:
    """One row's anchor block: vectors, and for every anchor and window its ends
    and the score that its last wanted row has at least."""

    def __init__(self, b: pa.RecordBatch, k: int, kind: str):
        self.block, self.label, dim = b.column("ablock")[k].as_py(), b.column("alabel")[k].as_py(), b.column("dim")[k].as_py()
        self.ids = _each(b.column("aids"), k).to_numpy()
        self.rows = np.frombuffer(b.column("adata")[k].as_py(), kind).reshape(len(self.ids), dim).astype(np.int64)
        windows = _each(b.column("windows"), k)
        pos, w, low, high = (windows.field(c).to_numpy() for c in ("pos", "w", "low", "high"))
        shape = len(self.ids), int(w.max(initial=-1)) + 1
        self.low, self.high = np.full(shape, 1, np.int64), np.zeros(shape, np.int64)  # empty where none is given
        self.low[pos, w], self.high[pos, w] = low, high
        self.first_low = self.low.copy()
        floors = _each(b.column("floors"), k)
        at = floors.field("pos").to_numpy(), floors.field("w").to_numpy()
        self.low[at] = np.maximum(self.low[at], floors.field("low").to_numpy())


def _choose(meet: DataFrame, kinds: dict[int, str], same: bool, rest: bool) -> DataFrame:
    """(ablock, block, wanted): the blocks to read, and for which anchors.

    Of the zones whose interval meets a window, the one with the highest bound comes
    first for an anchor; ``rest`` asks for all others at or above the floors.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ablocks, blocks, wanted = [], [], []
            for k in range(b.num_rows):
                dim = b.column("dim")[k].as_py()
                a = _Anchors(b, k, kinds[dim])
                zones = _each(b.column("zones"), k)
                number, label = zones.field("block").to_numpy(), zones.field("label").to_numpy()
                ends = [zones.field(c).flatten().to_numpy(zero_copy_only=False).reshape(len(number), dim) for c in ("low", "high")]
                least, most = bounds(a.rows, *ends)
                # the windows as they are without floors choose the first block in both passes
                fits = ((label == a.label) == same) & _meets(least, most, a.first_low, a.high)
                if not fits.any():
                    continue
                first = np.where(fits, most, _LEAST).argmax(axis=1)
                is_first = np.zeros_like(fits)
                is_first[np.arange(len(first)), first] = fits.any(axis=1)
                need = fits & _meets(least, most, a.low, a.high) & ~is_first if rest else is_first
                for z in np.flatnonzero(need.any(axis=0)).tolist():
                    ablocks.append(a.block)
                    blocks.append(number[z])
                    wanted.append(np.flatnonzero(need[:, z]))
            yield pa.RecordBatch.from_arrays([pa.array(ablocks, pa.int64()), pa.array(blocks, pa.int64()), pa.array(wanted, pa.list_(pa.int32()))],
                                             ["ablock", "block", "wanted"])

    return meet.mapInArrow(run, "ablock long, block long, wanted array<int>")


def _meets(least: np.ndarray, most: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Whether an anchor's interval for a zone meets one of its windows."""
    found = np.zeros(least.shape, bool)
    for w in range(low.shape[1]):
        open_ = low[:, w] <= high[:, w]
        found |= open_[:, None] & (most >= low[:, w, None]) & (least <= high[:, w, None])
    return found


def _read(pairs: DataFrame, kinds: dict[int, str], same: bool, keep: int) -> DataFrame:
    """(ablock, pos, anchor, w, id, score): of each chosen block, the first ``keep``
    rows of every wanted anchor's windows, by score and then by id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                dim = b.column("dim")[k].as_py()
                a = _Anchors(b, k, kinds[dim])
                ids = _each(b.column("ids"), k).to_numpy()
                rows = np.frombuffer(b.column("data")[k].as_py(), kinds[dim]).reshape(len(ids), dim).astype(np.int64)
                wanted = _each(b.column("wanted"), k).to_numpy()
                scores = -products(a.rows[wanted], rows)
                order = np.argsort(scores, axis=1, kind="stable")  # equal scores stay in the order of ids
                out: list[tuple[np.ndarray, np.ndarray, int, int]] = []
                for i, pos in enumerate(wanted.tolist()):
                    own = order[i]
                    if same:
                        own = own[ids[own] != a.ids[pos]]
                    falling = scores[i, own]
                    for w in range(a.low.shape[1]):
                        if a.low[pos, w] > a.high[pos, w]:
                            continue
                        at = np.searchsorted(falling, -a.high[pos, w], "left")
                        to = min(at + keep, np.searchsorted(falling, -a.low[pos, w], "right"))
                        if to > at:
                            out.append((ids[own[at:to]], -falling[at:to], pos, w))
                sizes = [len(o[0]) for o in out]
                total = sum(sizes)
                pos = np.repeat(np.array([o[2] for o in out], np.int32), sizes)
                yield pa.RecordBatch.from_pydict({
                    "ablock": np.full(total, a.block), "pos": pos, "anchor": a.ids[pos], "w": np.repeat(np.array([o[3] for o in out], np.int32), sizes),
                    "id": np.concatenate([o[0] for o in out] or [np.zeros(0, np.int64)]), "score": np.concatenate([o[1] for o in out] or [np.zeros(0, np.int64)])})

    return pairs.mapInArrow(run, "ablock long, pos int, anchor long, w int, id long, score long")


def _first(found: DataFrame, keep: int) -> DataFrame:
    """The first ``keep`` of every anchor's window (a partial limit runs before the shuffle)."""
    order = Window.partitionBy("ablock", "pos", "w").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)


def _search(anchors: DataFrame, windows: DataFrame, blocks: DataFrame, zones: DataFrame, groups: dict[int, int], kinds: dict[int, str], same: bool,
            keep: int) -> DataFrame:
    """The first ``keep`` rows of every window, among the blocks of the anchor's label or of all others."""
    none = F.array().cast("array<struct<pos:int,w:int,low:long>>")
    held = windows.groupBy("ablock").agg(F.collect_list(F.struct("pos", "w", "low", "high")).alias("windows"))
    state = anchors.join(held, "ablock")
    number = F.create_map(*[F.lit(x) for pair in groups.items() for x in pair])[F.col("dim")]

    def passed(floors: DataFrame | None) -> DataFrame:
        own = state.withColumn("floors", none) if floors is None else (
            state.join(floors, "ablock", "left").withColumn("floors", F.coalesce("floors", none)))
        meet = own.withColumn("group", F.explode(F.sequence(F.lit(0), number - 1))).join(zones, ["dim", "group"])
        pairs = table(_choose(meet, kinds, same, floors is not None), "chosen")
        # a pair carries its anchors to the block, whose rows stay where they are
        return _first(_read(pairs.join(own, "ablock").join(blocks.select("block", "ids", "data"), "block"), kinds, same, keep), keep)

    seeds = table(passed(None), "seeds")
    full = seeds.groupBy("ablock", "pos", "w").agg(F.min("score").alias("low"), F.max("rank").alias("n")).where(F.col("n") == keep)
    floors = full.groupBy("ablock").agg(F.collect_list(F.struct("pos", "w", "low")).alias("floors"))
    return _first(seeds.drop("rank").unionByName(passed(floors).drop("rank")), keep)


def mine(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, least_percent: int = 30, most_percent: int = 90,
         id_col: str = "id", label_col: str = "label", vector_col: str = "v", block: int = BLOCK, anchor_block: int = ANCHORS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` hold integer vectors (array<long>).  An anchor's positives are the
    first ``positives`` other rows of its label by inner product, ties by smaller id;
    for each, the first ``negatives`` rows of other labels follow whose
    product is ``least_percent`` to ``most_percent`` of the positive's.  The result is exact for any data; only the
    blocks read depend on it.

    Rows without an id, a label or a vector, or with a null component, take no
    part.  Equal rows count once; rows that share an id and differ otherwise are rows of their own,
    but an anchor never has its own id as a positive.  Vectors meet only those of the
    same length (lengths are few); empty ones have the product 0.  Products
    must lie within 2^62.  An empty table, or one without anchors, gives no rows; other columns are ignored.
    """
    spark = rows.sparkSession
    bounded_batches(spark)
    v = F.col(vector_col)
    plain = (rows.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.size(v).alias("dim"), v.cast("array<long>").alias("v"),
                         is_anchor.alias("anchor"))
             .where(F.col("id").isNotNull() & F.col("label").isNotNull() & v.isNotNull() & F.coalesce(F.forall("v", lambda x: x.isNotNull()), F.lit(False))))
    about = plain.groupBy("dim").agg(F.count("*").alias("n"), F.sum(F.when(F.col("anchor"), 1).otherwise(0)).alias("anchors"),
                                     F.coalesce(F.min(F.array_min("v")), F.lit(0)).alias("lo"), F.coalesce(F.max(F.array_max("v")), F.lit(0)).alias("hi")).collect()
    scale = {r["dim"]: (r["lo"], r["hi"]) for r in about}
    kinds = {d: _kind(*ends) for d, ends in scale.items()}
    columns = ["id", "label", "dim", "v"]
    blocks = table(_blocks(plain.select(*columns), sum(r["n"] for r in about), scale, block), "blocks")
    anchors = table(_blocks(plain.where("anchor").select(*columns), sum(r["anchors"] for r in about), scale, anchor_block)
                    .select(F.col("block").alias("ablock"), "dim", F.col("label").alias("alabel"), F.col("ids").alias("aids"), F.col("data").alias("adata")), "anchors")
    groups = {r["dim"]: -(-r["n"] // ZONES) for r in blocks.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    if not groups or anchors.isEmpty():
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    number = F.create_map(*[F.lit(x) for pair in groups.items() for x in pair])[F.col("dim")]
    zones = table(blocks.withColumn("group", F.pmod(F.xxhash64("block"), number).cast("int")).groupBy("dim", "group")
                  .agg(F.sort_array(F.collect_list(F.struct("block", "label", "low", "high"))).alias("zones")), "zones")
    everything = anchors.select("ablock", F.posexplode("aids").alias("pos", "aid")).select(
        "ablock", "pos", F.lit(0).alias("w"), F.lit(_LEAST).alias("low"), F.lit(_MOST).alias("high"))
    near = table(_search(anchors, everything, blocks, zones, groups, kinds, True, positives)
                 .select("ablock", "pos", "anchor", (F.col("rank") - 1).cast("int").alias("w"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    p = F.col("positive_score")
    # 100 * score from least * p to most * p; a negative p leaves no window
    windows = near.where(p >= 0).select("ablock", "pos", "w", F.expr(f"({least_percent} * positive_score + 99) div 100").alias("low"),
                                        F.expr(f"{most_percent} * positive_score div 100").alias("high"))
    far = _search(anchors, windows, blocks, zones, groups, kinds, False, negatives)
    return (far.select("ablock", "pos", "w", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
            .join(near, ["ablock", "pos", "w"])
            .select(F.col("anchor").alias("anchor_id"), "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"))


def quantised(vectors: DataFrame, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """id, label, v: components times ``scale``, rounded down; null vectors and ones with null or non-finite components are left out."""
    v = F.col(vector_col)
    finite = F.forall(v, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    return vectors.where(v.isNotNull() & finite).select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
        F.transform(v, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long")).alias("v"))
