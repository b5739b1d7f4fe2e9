"""N-gram Jaccard join by several global token orders (operator 1).

A document's set is its distinct word shingles, as 64-bit hashes.  Equal sets
form one class.  For sets x, y with Jaccard similarity t or more,
|x & y| >= t * |x|, so under *any* total order of the tokens the first
|x| - ceil(t |x|) + 1 tokens of both sets share one.  Three orders are used:

* order 0, rare tokens first: tokens of one text, then repeated ones by hash,
  then frequent ones by their count.  Its prefixes are posted and joined.
* orders 1 and 2, two other hash orders: a pair from order 0 must also share a
  prefix token under each of them before the two whole sets are fetched and
  intersected.

Every token is counted, but any order is right: only the work depends on it.  So
what the tasks know of the counts has a bounded size and can be broadcast: a bit
per token hash (found ``bar`` times or more; ``bar`` is 2 until half of the most
bits are set) and a list of the most frequent tokens.  While ``bar`` is 2, a
token without its bit is in one set only and is not posted at all; a bit set by
another token only posts what need not be.  One text of each class counts, posts
and fetches (``_class_texts``), so copies alone mark nothing.

Components need no full pair list.  Rounds 1 and 2 verify the sets of a posting
group against the group's first set (a star); round 3 takes the groups that
still hold several components and finds pairs across components: all pairs of
small groups, and in larger ones by what the
sets differ from the first one in (``_across``), so a dense family below the threshold costs rows
in proportion to its members.  Any link left out joins two sets that are already in one component.
Postings that can be of no use for either, as most chance meetings of two sets, are
dropped before any set is fetched.

Numpy runs inside tasks only to hash whole texts; grouping, filters and
intersections are Spark expressions.  Intermediate tables are written to the
shared folder.  Two different sets share a class key with probability about
N^2 / 2^65 for N classes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pkgsift.llm.common import bounded_batches, table, tidy
from pkgsift.llm.components import connected_components

#: Sets a token must be in to count as frequent, and the most tokens listed.
MIN_FREQUENT = 16
MAX_FREQUENT = 1 << 18
#: Counts that may mark a token as repeated, log2 of the usual most marking bits and of the
#: bits that travel in one row, and the bits there are for a marked token while they are fewer.
BARS = (2, 3, 4, 6, 8, 12, 16, 32, 64, 256, 1024)
MARK_BITS = 28
RUN_BITS = 20
BITS_EACH = 64
#: log2 of the most marking bits: taken once marked tokens are so many sixteenths of the bits.
MOST_BITS = 30
FULL = 11
#: log2 of the most bits that mark class keys, and bits there are for a class while they are fewer.
CLASS_BITS = 26
CLASS_BITS_EACH = 64
#: Members of a posting group, besides its first set, whose pairs are all looked at.
SMALL_GROUP = 16
#: Tokens a task sorts at once while counting, and tokens per counting group.
FLUSH_TOKENS = 2 << 20
GROUP_TOKENS = 2 << 20
KEY_BITS = 48
#: Class keys a task remembers to skip copies.
SEEN_SETS = 200_000
#: Times that members without a possible partner are left out (any number is right).
PRUNED = 2
_ODD = [np.uint64(2 * xxhash.xxh64_intdigest(b"order", k) + 1 & (1 << 64) - 1) for k in range(64)]


def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finalizer (xor-shift and odd multipliers)."""
    x = (x ^ (x >> np.uint64(31))) * _ODD[seed]
    x = (x ^ (x >> np.uint64(29))) * _ODD[seed + 1]
    return x ^ (x >> np.uint64(32))


#: Bytes hashed at once; longer words than this are hashed one by one.
CHUNK_BYTES = 1 << 20
LONG_WORD = 32
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_BLANK = np.array([b == 32 or 9 <= b <= 13 for b in range(256)])
#: A random 64-bit value per byte, and odd factors per place in a word.
_VALUE = np.array([xxhash.xxh64_intdigest(b"byte", k) for k in range(256)], np.uint64)
_PLACE = np.array([xxhash.xxh64_intdigest(b"place", k) | 1 for k in range(LONG_WORD)], np.uint64)


def _word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(start, 64-bit hash) of every word of a buffer, A-Z as a-z."""
    raw = np.frombuffer(data, np.uint8)
    blank = _BLANK[raw]
    at = np.flatnonzero(~blank)
    if not len(at):
        return at, np.zeros(0, np.uint64)
    first = np.ones(len(at), bool)
    first[1:] = at[1:] != at[:-1] + 1
    begin = np.flatnonzero(first)  # index into ``at`` of each word's first byte
    size = np.diff(begin, append=len(at))
    place = np.arange(len(at)) - np.repeat(begin, size)
    with np.errstate(over="ignore"):
        value = _VALUE[_LOWER[raw[at]]] * _PLACE[np.minimum(place, LONG_WORD - 1)]
        hashes = np.add.reduceat(value, begin) + size.astype(np.uint64) * _ODD[60]
    starts = at[begin]
    for k in np.flatnonzero(size > LONG_WORD):
        hashes[k] = xxhash.xxh64_intdigest(data[starts[k]:starts[k] + size[k]].lower())
    return starts, hashes


def shingle_sets(texts: list[bytes], n: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text.  A-Z count as a-z; words
    are runs without ASCII white space; a text of fewer than ``n`` words is one
    shingle, one without words has none."""
    out: list[np.ndarray] = []
    a = 0
    while a < len(texts):
        b, size = a, 0
        while b < len(texts) and (b == a or size + len(texts[b]) <= CHUNK_BYTES):
            size += len(texts[b]) + 1
            b += 1
        out += _chunk_sets(texts[a:b], n)
        a = b
    return out


def _chunk_sets(texts: list[bytes], n: int) -> list[np.ndarray]:
    starts, flat = _word_hashes(b"\n".join(texts))
    sizes = np.array([len(t) + 1 for t in texts])
    ends = np.searchsorted(starts, np.cumsum(sizes))
    total = len(flat)
    with np.errstate(over="ignore"):
        runs = np.zeros(max(0, total - n + 1), np.uint64)
        for j in range(n):
            runs += flat[j:total - n + 1 + j] * _ODD[8 + j % 40]
        runs = _mix(runs, 0)
        out, at = [], 0
        for end in ends.tolist():
            if end - at >= n:
                s = np.sort(runs[at:end - n + 1])
                fresh = np.empty(len(s), bool)
                fresh[0] = True
                np.not_equal(s[1:], s[:-1], out=fresh[1:])
                out.append(s[fresh])
            elif end > at:
                short = np.uint64(end - at) * _ODD[56]
                for j, h in enumerate(flat[at:end]):
                    short = short + h * _ODD[50 + j % 6]
                out.append(_mix(np.array([short], np.uint64), 58))
            else:
                out.append(np.zeros(0, np.uint64))
            at = end
    return out


def _prefix_length(size: int, percent: int) -> int:
    return size - -(-percent * size // 100) + 1


def _keys(s: np.ndarray) -> tuple[int, int]:
    """Two hashes of a set as signed longs: wrapped sums over its mixed tokens."""
    with np.errstate(over="ignore"):
        m = _mix(s, 2)
        return int(m.sum(dtype=np.uint64).astype(np.int64)), int((m * m * _ODD[4]).sum(dtype=np.uint64).astype(np.int64))


def _sets(batches, n: int, text: int = 0) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in batches:
        yield batch, shingle_sets([x.as_py() or b"" for x in batch.column(text)], n)


def signatures(docs: DataFrame, n: int) -> DataFrame:
    """doc_id, n_shingles, s1, s2: set size and two set hashes (null if empty)."""

    def run(batches):
        for batch, sets in _sets(batches, n, 1):
            keys = [_keys(s) if len(s) else (None, None) for s in sets]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0),
                "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                "s1": pa.array([k for k, _ in keys], pa.int64()),
                "s2": pa.array([k for _, k in keys], pa.int64()),
            })

    return docs.mapInArrow(run, "doc_id long, n_shingles long, s1 long, s2 long")


def _marked(bits: np.ndarray, key: int) -> bool:
    """Whether a key has its bit among ``_marked_classes``."""
    place = (key & (1 << 64) - 1) >> (62 - len(bits).bit_length())  # 8 * len(bits) is a power of two
    return bool(bits[place >> 3] >> (place & 7) & 1)


def _new_sets(batches, n: int, kept: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """(class key, set) of each non-empty set that this task has not just seen.

    With the bits of ``_class_texts`` the second column is the doc_id, and texts
    without a bit are copies of one that has it."""
    seen: set[int] = set()
    for batch, sets in _sets(batches, n):
        if len(seen) > SEEN_SETS:
            seen.clear()
        ids = batch.column(1).to_pylist() if kept is not None else [0] * len(sets)
        for i, s in zip(ids, sets):
            if len(s) and (k := _keys(s)[0]) not in seen and (kept is None or _marked(kept, _text_key(i, k))):
                seen.add(k)
                yield k, s


def _text_key(doc_id: int, s1: int) -> int:
    """A key of a text by its id and class: Spark's ``xxhash64``, as in ``_class_texts``."""
    return xxhash.xxh64_intdigest((doc_id ^ s1).to_bytes(8, "little", signed=True), 42)


def _class_texts(signed: DataFrame, rows: int) -> np.ndarray:
    """Bits that mark one text of each class, the one of least doc_id.  A text whose
    bit another one has set is an extra copy and changes nothing."""
    least = signed.groupBy("s1", "s2").agg(F.min("doc_id").alias("doc_id"))
    return _marked_classes(least.select(F.xxhash64(F.col("doc_id").bitwiseXOR(F.col("s1"))).alias("s")), rows)


def _pack(keys: np.ndarray) -> bytes:
    """Sorted keys as byte planes of their differences, which compress well."""
    d = np.diff(keys, prepend=np.uint64(0))
    return d.view(np.uint8).reshape(-1, 8)[:, :KEY_BITS // 8].T.tobytes()


def _unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(KEY_BITS // 8, -1)
    full = np.zeros((planes.shape[1], 8), np.uint8)
    full[:, :KEY_BITS // 8] = planes.T
    return np.cumsum(full.view(np.uint64).ravel(), dtype=np.uint64)


@dataclass(frozen=True)
class TokenOrder:
    """What tasks know of token counts: marking bits, their bar, frequent tokens."""

    bits: int
    marks: np.ndarray  # 2 ** bits bits
    bar: int
    keys: np.ndarray  # frequent token keys, ascending
    rank: np.ndarray  # their place by count, from 2

    def ranks(self, s: np.ndarray) -> np.ndarray:
        """0 for an unmarked token, 1 for a marked one, more for a frequent one."""
        k = s >> np.uint64(64 - KEY_BITS)
        bit = k >> np.uint64(KEY_BITS - self.bits)
        out = ((self.marks[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1).astype(np.int64)
        if len(self.keys) and out.any():
            at = np.minimum(np.searchsorted(self.keys, k), len(self.keys) - 1)
            out = np.where(self.keys[at] == k, self.rank[at], out)
        return out


def token_order(texts: DataFrame, n: int, tokens: int, kept: Broadcast | None = None) -> TokenOrder:
    """Count all tokens and keep what fits.

    Every token of every text is counted, with ``kept`` of one text of each class.  Tasks sort and pre-aggregate millions
    of tokens at a time and send them, packed, by key range; ranges are cut so
    that one range holds about ``GROUP_TOKENS`` tokens.
    """
    groups = max(1, tokens // GROUP_TOKENS)
    edges = np.array([g * (1 << KEY_BITS) // groups for g in range(groups + 1)], np.uint64)

    def count(batches):
        def flush(held):
            keys, counts = np.unique(np.concatenate(held) >> np.uint64(64 - KEY_BITS), return_counts=True)
            at = np.searchsorted(keys, edges)
            rows = [g for g in range(groups) if at[g] < at[g + 1]]
            return pa.RecordBatch.from_pydict({
                "g": pa.array(rows, pa.int32()),
                "keys": pa.array([_pack(keys[at[g]:at[g + 1]]) for g in rows], pa.binary()),
                "counts": pa.array([counts[at[g]:at[g + 1]].astype("<u4").tobytes() for g in rows], pa.binary())})

        held, size = [], 0
        for _, s in _new_sets(batches, n, kept.value if kept else None):
            held.append(s)
            size += len(s)
            if size >= FLUSH_TOKENS:
                yield flush(held)
                held, size = [], 0
        if held:
            yield flush(held)

    def total(batches):
        def close(held):
            keys, counts = np.concatenate([k for k, _ in held]), np.concatenate([c for _, c in held])
            order = np.argsort(keys, kind="stable")
            keys = keys[order]
            starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            sums = np.add.reduceat(counts[order].astype(np.int64), starts)
            keys = keys[starts]
            often, shared = sums >= MIN_FREQUENT, sums >= BARS[0]
            rows = [(0, int(k), int(c), None, None) for k, c in zip(keys[often], sums[often])]
            rows += [(bar, 0, int((sums >= bar).sum()), None, None) for bar in BARS]
            if shared.any():
                rows.append((-1, 0, int(shared.sum()), _pack(keys[shared]), np.minimum(sums[shared], BARS[-1]).astype("<u2").tobytes()))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["bar", "key", "n", "keys", "counts"])

        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary())

        now, held = None, []
        for batch in batches:
            for g, k, c in zip(*(batch.column(i) for i in range(3))):
                if g.as_py() != now:
                    if held:
                        yield close(held)
                    now, held = g.as_py(), []
                held.append((_unpack(k.as_py()), np.frombuffer(c.as_py(), "<u4")))
        if held:
            yield close(held)

    parts = max(groups, int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    found = table(texts.mapInArrow(count, "g int, keys binary, counts binary")
                  .repartition(parts, "g").sortWithinPartitions("g")
                  .mapInArrow(total, "bar int, key long, n long, keys binary, counts binary"), "frequent")
    sizes = dict(found.where("bar > 0").groupBy("bar").agg(F.sum("n")).collect())  # at most len(BARS) rows
    # a token without its bit is known to be in one set while ``bar`` is 2, so bits half full tell much; higher bars only order tokens
    bar = next((b for b in BARS if sizes.get(b, 0) <= (FULL if b == 2 else 2) << (MOST_BITS - 4)), BARS[-1])
    width = min(MARK_BITS, max(RUN_BITS, (BITS_EACH * sizes.get(bar, 0) - 1).bit_length()))  # log2 of the bits: few marks need no more
    while width < MOST_BITS and sizes.get(bar, 0) << 4 > FULL << width:
        width += 1

    def mark(batches):  # repeated keys -> runs of marking bits
        for batch in batches:
            for k, c in zip(*(batch.column(i) for i in range(2))):
                keys, counts = _unpack(k.as_py()), np.frombuffer(c.as_py(), "<u2")
                bits = np.unique(keys[counts >= bar] >> np.uint64(KEY_BITS - width)).astype(np.int64)
                for chunk in np.unique(bits >> RUN_BITS).tolist():
                    own = bits[np.searchsorted(bits, chunk << RUN_BITS):np.searchsorted(bits, chunk + 1 << RUN_BITS)]
                    run = np.zeros(1 << RUN_BITS, np.uint8)
                    run[own & (1 << RUN_BITS) - 1] = 1
                    yield pa.RecordBatch.from_pydict({"chunk": pa.array([chunk], pa.int32()), "bits": pa.array([np.packbits(run, bitorder="little").tobytes()], pa.binary())})

    marks = np.zeros(1 << (width - 3), np.uint8)
    # one row per chunk of a fixed bit array, and one more where two key ranges meet
    for r in found.where("bar = -1").select("keys", "counts").mapInArrow(mark, "chunk int, bits binary").toLocalIterator():
        at = r["chunk"] << (RUN_BITS - 3)
        marks[at:at + (1 << (RUN_BITS - 3))] |= np.frombuffer(r["bits"], np.uint8)
    listed = found.where("bar = 0")
    steps = listed.groupBy(F.floor(F.log2("n")).alias("b")).count().collect()  # at most 63 rows
    least, left = 0, 0
    for r in sorted(steps, reverse=True):
        left += r["count"]
        if left > MAX_FREQUENT:
            least = 2 << r["b"]
            break
    rows = listed.where(F.col("n") >= least).select("key", "n").toArrow()  # at most MAX_FREQUENT rows
    keys, counts = rows.column("key").to_numpy().astype(np.uint64), rows.column("n").to_numpy()
    rank = np.empty(len(keys), np.int64)
    rank[np.lexsort((keys, counts))] = np.arange(2, len(keys) + 2)
    order = np.argsort(keys)
    return TokenOrder(width, marks, bar, keys[order], rank[order])


def postings(texts: DataFrame, n: int, percent: int, shared: Broadcast, kept: Broadcast) -> DataFrame:
    """(t, u, s, size, most): each class key under each token of its prefix, order 0.

    ``u`` is its number of unmarked tokens, least for the most central of near
    copies; ``most`` is the greatest overlap it can have, its size less the tokens
    that are in no other text."""
    def run(batches):
        known = shared.value

        def prefix(s):
            size, ranks = _prefix_length(len(s), percent), known.ranks(s)
            own = len(s) - np.count_nonzero(ranks)
            if known.bar == 2 and own >= size:
                return own, s[:0]
            first = np.lexsort((s, ranks))[:size]
            return own, s[first[ranks[first] > 0]] if known.bar == 2 else s[first]

        ids, lists, alone, sizes = [], [], [], []

        def rows():
            most = [z - a if known.bar == 2 else z for z, a in zip(sizes, alone)]
            return pa.RecordBatch.from_pydict({
                "u": pa.array(alone, pa.int32()), "s": pa.array(ids, pa.int64()), "size": pa.array(sizes, pa.int32()),
                "most": pa.array(most, pa.int32()), "t": pa.array(lists, pa.list_(pa.int64()))})

        for k, s in _new_sets(batches, n, kept.value):
            own, p = prefix(s)
            if not len(p):
                continue
            ids.append(k)
            alone.append(own)
            sizes.append(len(s))
            lists.append(p.astype(np.int64))
            if len(ids) == 512:
                yield rows()
                ids, lists, alone, sizes = [], [], [], []
        if ids:
            yield rows()

    return (texts.mapInArrow(run, "u int, s long, size int, most int, t array<long>")
            .select(F.explode("t").alias("t"), "u", "s", "size", "most"))


def _possible(a: str, b: str, percent: int) -> Column:
    """Whether the overlap two sets can have at most is enough for their sizes."""
    sizes = F.col(f"{a}size").cast("long") + F.col(f"{b}size")
    return (100 + percent) * F.least(F.col(f"{a}most"), F.col(f"{b}most")).cast("long") >= percent * sizes


def _marked_classes(keys: DataFrame, rows: int) -> np.ndarray:
    """Bits, by the leading bits of the key, of the keys in column ``s``: at most
    2 ** CLASS_BITS bits, put together by Spark's bitmap aggregate."""
    width = min(CLASS_BITS, max(15, (CLASS_BITS_EACH * rows).bit_length()))  # Spark's runs have 2 ** 15 bits
    place = F.shiftrightunsigned("s", 64 - width) + 1
    runs = (keys.groupBy(F.bitmap_bucket_number(place).alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")))
    out = np.zeros(1 << (width - 3), np.uint8)
    found = runs.toArrow()  # the bits themselves, at most 8 MB
    for k, bits in zip(found["k"].to_pylist(), found["bits"].to_pylist()):
        at = (k - 1) * len(bits)
        out[at:at + len(bits)] = np.frombuffer(bits, np.uint8)
    return out


def set_table(texts: DataFrame, marked: Broadcast, n: int, percent: int, kept: Broadcast) -> DataFrame:
    """s, size, p1, p2, tokens: whole sets with their prefixes under orders 1 and 2.

    Sets whose class key has no bit in ``marked`` are left where they are: the
    texts are read again, not shuffled.  The prefixes are kept as 32-bit values;
    equal low bits of different tokens only let a pair through to the exact check.
    """
    def run(batches):
        bits = marked.value
        for k1, s in _new_sets(batches, n, kept.value):
            if not _marked(bits, k1):
                continue
            size = _prefix_length(len(s), percent)
            with np.errstate(over="ignore"):
                p1, p2 = (np.sort(_mix(s, k))[:size].astype(np.uint32).view(np.int32) for k in (50, 54))
            yield pa.RecordBatch.from_pydict({
                "s": pa.array([k1], pa.int64()), "size": pa.array([len(s)], pa.int64()),
                "p1": pa.array([p1], pa.list_(pa.int32())), "p2": pa.array([p2], pa.list_(pa.int32())),
                "tokens": pa.array([s.astype(np.int64)], pa.list_(pa.int64()))})

    def joined(batches):  # one batch of rows for many sets
        held = []
        for b in run(batches):
            held.append(b)
            if len(held) == 256:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held = []
        if held:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    kind = "s long, size long, p1 array<int>, p2 array<int>, tokens array<long>"
    return texts.mapInArrow(joined, kind).groupBy("s").agg(*(F.first(c).alias(c) for c in ("size", "p1", "p2", "tokens")))


def verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of class keys whose sets are similar: sizes, then prefixes
    under orders 1 and 2, then the whole sets."""

    def side(name: str, *cols: str) -> DataFrame:
        return sets.select(F.col("s").alias(name), *(F.col(c).alias(f"{name}_{c}") for c in cols))

    near = (pairs.join(side("a", "size", "p1", "p2"), "a").join(side("b", "size", "p1", "p2"), "b")
            .where((100 * F.least("a_size", "b_size") >= percent * F.greatest("a_size", "b_size"))
                   & F.arrays_overlap("a_p1", "b_p1") & F.arrays_overlap("a_p2", "b_p2"))
            .select("a", "b"))
    both = F.size(F.array_intersect("a_tokens", "b_tokens"))
    return (near.join(side("a", "size", "tokens"), "a").join(side("b", "size", "tokens"), "b")
            .where((100 + percent) * both >= percent * (F.col("a_size") + F.col("b_size"))).select("a", "b"))


def ngram_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5,
                     percent: int = 80, with_keys: bool = False) -> DataFrame:
    """doc_id, n_shingles, component_id [, s1, s2, component] for every row of ``docs``.

    Two documents link when 100 * |x & y| >= percent * |x | y| over their sets of
    ``n``-word shingles; component_id is the smallest doc_id reachable by links,
    the document itself included.

    Null, empty or blank texts have an empty set and link with nothing: their
    component is their own doc_id.  Texts of any length are read whole.  Repeated
    rows each give a row with the same values.  A row with a null doc_id gives a
    row with a null component and links with nothing.  An empty table gives no
    rows.  Other columns are ignored.  ``with_keys`` adds the set's two hashes and
    the component's own key, null for an empty set; ids that name several texts
    can be told apart by them.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    texts = rows.where("doc_id is not null").select("text", "doc_id")
    everything = table(signatures(rows, n), "signatures")
    signed, alone = everything.where("doc_id is not null and s1 is not null"), everything.where("doc_id is null or s1 is null")
    count, tokens = signed.agg(F.count("*"), F.coalesce(F.sum("n_shingles"), F.lit(0))).first()

    send = docs.sparkSession.sparkContext.broadcast
    kept = send(_class_texts(signed, count))
    shared = send(token_order(texts, n, tokens, kept))
    tidy(docs.sparkSession)
    posted = postings(texts, n, percent, shared, kept)
    group = Window.partitionBy("t").orderBy("u", "s")
    star = (posted.withColumns({"head": F.first(F.struct("u", "s", "size", "most")).over(group), "before": F.lag("s").over(group)})
            .where("s != before"))
    star = star.select("t", F.col("head.s").alias("first"), *(F.col(f"head.{c}").alias(f"first_{c}") for c in ("u", "size", "most")), "s", "size", "most")
    star = (star.withColumns({"possible": _possible("first_", "", percent), "paired": _in_reach("s", percent),
                              "crowd": F.count("*").over(Window.partitionBy("t")) > SMALL_GROUP}))
    star = table(star.where("possible or paired"), "postings")
    pairs = table(star.where("possible").groupBy(F.col("first").alias("a"), F.col("s").alias("b"))
                  .agg(F.min("first_u").alias("u")), "pairs")
    wanted = star.select("s").union(star.where("possible or crowd").select(F.col("first").alias("s")))
    shared.destroy()  # written tables stand for what it was needed for
    del shared, posted
    tidy(docs.sparkSession)
    marked = send(_marked_classes(wanted, count))
    sets = table(set_table(texts, marked, n, percent, kept), "sets")
    marked.destroy()
    kept.destroy()
    del marked, kept
    tidy(docs.sparkSession)

    # round 1: every set with the least head of its groups; round 2: the other heads
    # that the verified stars leave apart; round 3: other pairs across components, by their differences
    near = table(pairs.groupBy("b").agg(F.min(F.struct("u", "a")).alias("m")).select("m.a", "b"), "pairs")
    links = table(verify(near, sets, percent), "links")
    stars = links.select(F.col("b").alias("node"), F.col("a").alias("component"))
    heads = table(_heads_across(pairs, stars).join(near, ["a", "b"], "left_anti"), "pairs")
    tidy(docs.sparkSession)
    links = table(links.union(verify(heads, sets, percent)), "links")
    tidy(docs.sparkSession)
    parts = table(connected_components(links, "a", "b"), "parts")
    found = table(verify(table(_across(star, parts, sets, percent), "pairs"), sets, percent), "links")
    if not found.isEmpty():
        parts = table(connected_components(links.union(found), "a", "b"), "parts")

    classes = (signed.groupBy("s1", "s2", "n_shingles").agg(F.min("doc_id").alias("least"))
               .join(parts.withColumnRenamed("node", "s1"), "s1", "left")
               .withColumn("component", F.coalesce("component", "s1")))
    least = classes.groupBy("component").agg(F.min("least").alias("component_id"))
    keys = ["s1", "s2", "component"] if with_keys else []
    named = classes.join(least, "component").select("s1", "s2", "n_shingles", "component_id", *keys[2:])
    return (signed.join(named, ["s1", "s2", "n_shingles"])
            .select("doc_id", "n_shingles", "component_id", *keys)
            .unionByName(alone.select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"),
                                      *(F.lit(None).cast("long").alias(k) for k in keys))))


def _heads_across(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """Pairs (a, b) of a group's head and a member in another component."""
    ca = parts.select(F.col("node").alias("a"), F.col("component").alias("ca"))
    cb = parts.select(F.col("node").alias("b"), F.col("component").alias("cb"))
    return (pairs.join(ca, "a", "left").join(cb, "b", "left")
            .where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b"))


def _in_reach(key: str, percent: int) -> Column:
    """Whether members of the row's posting group whose sizes may be near enough differ
    in ``key``.  Sizes of similar sets differ by one step of their logarithm at most, so
    they share a cell of two steps, counted from an even step or from an odd one."""
    step = F.log(F.col("size").cast("double")) / F.lit(1.000001 * math.log(100 / min(max(percent, 1), 99)))
    even, odd = (Window.partitionBy("t", F.floor((step + k) / 2)) for k in (0, 1))
    return (F.min(key).over(even) < F.max(key).over(even)) | (F.min(key).over(odd) < F.max(key).over(odd))


def _across(star: DataFrame, parts: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) in different components that share a posting and can be similar.

    Pairs with the head are verified before, so only members of a group that are in
    different components and near enough in size count.  Of a small group
    all such pairs are taken.  In a larger one
    every member x is known by its difference dx from the group's head:
    the tokens that one of the two has and the other not.  Two sets x, y differ by
    |dx| + |dy| - 2 |dx & dy| tokens and are similar if that is at most
    (100 - percent) / (100 + percent) of |x| + |y|.  So what their differences must share is a
    given number, positive unless both are similar to the head.  Only tokens in
    several members' differences can be shared, and edits that a member has to itself cannot: a
    member whose shareable tokens are too few for the best partner in another
    component is out.  The others post, rarest first, a prefix of their shareable tokens.
    """
    own = parts.select(F.col("node").alias("s"), "component")
    placed = (star.where("paired").join(own, "s", "left")
              .select("t", F.col("first").alias("h"), "s", "size", "most", "crowd", F.coalesce("component", "s").alias("c")))
    placed = table(placed.withColumn("paired", _in_reach("c", percent)).where("paired").drop("paired"), "members")
    x, y = (placed.where("not crowd").select("t", *(F.col(c).alias(side + c) for c in ("s", "c", "size", "most"))) for side in ("x", "y"))
    few = (x.join(y, "t").where((F.col("xs") < F.col("ys")) & (F.col("xc") != F.col("yc")) & _possible("x", "y", percent))
           .select(F.col("xs").alias("a"), F.col("ys").alias("b")))
    members = placed.where("crowd").select("h", "s", "c").distinct()
    of_head = sets.select(F.col("s").alias("h"), F.col("tokens").alias("h_tokens"))
    more, less = 100 + percent, 100 - percent
    delta = table(members.join(of_head, "h").join(sets.select("s", "size", "tokens"), "s")
                  .select("h", "s", "c", "size", F.concat(F.array_except("tokens", "h_tokens"), F.array_except("h_tokens", "tokens")).alias("delta"))
                  .withColumn("g", (more * F.size("delta") - less * F.col("size")).cast("long")), "differences")
    # 2 * more * |dx & dy| >= gx + gy for similar sets
    tokens = delta.select("h", "s", F.explode("delta").alias("t"))
    often = tokens.groupBy("h", "t").agg(F.count("*").alias("n")).where("n > 1")
    shared = (tokens.join(often, ["h", "t"]).groupBy("h", "s").agg(F.sort_array(F.collect_list(F.struct("n", "t"))).alias("shared")))
    known = table(delta.select("h", "s", "c", "g").join(shared, ["h", "s"]).withColumn("w", F.size("shared").cast("long")), "differences")
    left = known.select("h", "s", "c", "g", "w")
    for _ in range(PRUNED):
        least = left.groupBy("h").agg(F.min(F.struct("g", "c")).alias("m"))
        near = left.join(least, "h")
        second = near.where(F.col("c") != F.col("m.c")).groupBy("h").agg(F.min("g").alias("g2"))
        other = F.when(F.col("c") != F.col("m.c"), F.col("m.g")).otherwise(F.col("g2"))
        tidy(star.sparkSession)
        left = table(near.join(second, "h", "left").withColumn("other", other).where(F.col("g") + F.col("other") <= 2 * more * F.col("w"))
                     .select("h", "s", "c", "g", "w", "other"), "differences")
    need = F.greatest(F.ceil((F.col("g") + F.col("other")) / F.lit(2 * more)), F.lit(1)).cast("int")
    posted = (left.join(known.select("h", "s", "shared"), ["h", "s"])
              .select("h", "s", "c", "g", "w", F.explode(F.slice("shared", 1, F.col("w").cast("int") - need + 1)).alias("x")).withColumn("t", F.col("x.t")).drop("x"))
    x, y = (posted.select("h", "t", *(F.col(c).alias(side + c) for c in ("s", "c", "g", "w"))) for side in ("x", "y"))
    many = (x.join(y, ["h", "t"])
            .where((F.col("xs") < F.col("ys")) & (F.col("xc") != F.col("yc")) & (F.col("xg") + F.col("yg") <= 2 * more * F.least("xw", "yw")))
            .select(F.col("xs").alias("a"), F.col("ys").alias("b")))
    return few.union(many).distinct()
