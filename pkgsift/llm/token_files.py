"""Token files with Elias-Fano document boundaries (operator 9).

Documents in ascending id order are cut into shards; each shard is one file:

    magic "EFTK0001" | header (JSON, its length first) | ids, uint16 or uint32
    | boundaries (Elias-Fano) | document ids (Elias-Fano over id - base)

A monotone sequence of n values below u takes n * (2 + log2(u / n)) bits: the
low bits are packed, the high bits are a unary bit vector.  ``select`` finds the
k-th set bit from one 32-bit sample per 256 values and popcounts; there is no
64-bit offset table.  A shard is written under a temporary name and renamed, and
its row goes to the manifest, so a retried task writes the same file again.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pkgsift.llm.common import bounded_batches, commit, filesystem, shard_column, table
from pkgsift.llm.pieces import pieces

MAGIC = b"EFTK0001"
SAMPLE = 256
#: Text bytes a shard aims at.
SHARD_BYTES = 32 << 20
#: Entries a worker keeps; a full cache is emptied, results don't change.
CACHE_WORDS = 500_000
#: Longer words are encoded each time.
CACHED_LENGTH = 64


class EliasFano:
    """A non-decreasing sequence of unsigned integers, with ``select`` access."""

    def __init__(self, n: int, bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.bits, self.low, self.high, self.samples = n, bits, low, high, samples

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        v = np.asarray(values, np.uint64)
        n, top = len(v), int(v[-1]) + 1 if len(v) else 1
        bits = max(0, (top // max(n, 1)).bit_length() - 1)
        spread = (v[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1) if bits else np.zeros((n, 0), np.uint64)
        low = np.packbits(spread.astype(np.uint8).ravel(), bitorder="little")
        at = (v >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        unary = np.zeros((int(at[-1]) if n else 0) + 1, np.uint8)
        unary[at] = 1
        return cls(n, bits, low, np.packbits(unary, bitorder="little"), at[::SAMPLE].astype("<u4"))

    def select(self, k: int) -> int:
        """The k-th value: nearest sample, then popcounts byte by byte."""
        at = int(self.samples[k // SAMPLE])
        left, byte = k % SAMPLE, at >> 3
        word = int(self.high[byte]) >> (at & 7) << (at & 7)
        while (ones := word.bit_count()) <= left:
            left, byte = left - ones, byte + 1
            word = int(self.high[byte])
        for _ in range(left):
            word &= word - 1
        position = byte * 8 + (word & -word).bit_length() - 1
        first, value = k * self.bits, 0
        for j in range(self.bits):
            value |= (int(self.low[(first + j) >> 3]) >> ((first + j) & 7) & 1) << j
        return (position - k) << self.bits | value

    def select_many(self, k: np.ndarray) -> np.ndarray:
        """The values at ascending places ``k``: the sampled stretches that hold them, one at a time."""
        k = np.asarray(k, np.int64)
        position = np.empty(len(k), np.int64)
        cuts = np.flatnonzero(np.diff(k // SAMPLE, prepend=-1, append=-1)).tolist() if len(k) else []
        for a, b in zip(cuts, cuts[1:]):
            block = int(k[a]) // SAMPLE
            at = int(self.samples[block])
            # the next sample's byte may hold this stretch's last bits
            end = (int(self.samples[block + 1]) >> 3) + 1 if block + 1 < len(self.samples) else len(self.high)
            ones = np.flatnonzero(np.unpackbits(self.high[at >> 3:end], bitorder="little")) + (at >> 3 << 3)
            position[a:b] = ones[np.searchsorted(ones, at) + k[a:b] % SAMPLE]
        value = (position - k).astype(np.uint64) << np.uint64(self.bits)
        for j in range(self.bits):
            bit = k * self.bits + j
            value |= (self.low[bit >> 3] >> (bit & 7).astype(np.uint8) & 1).astype(np.uint64) << np.uint64(j)
        return value

    def all(self) -> np.ndarray:
        at = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[:self.n]
        value = (at - np.arange(self.n)).astype(np.uint64) << np.uint64(self.bits)
        if self.bits:
            spread = np.unpackbits(self.low, bitorder="little")[:self.n * self.bits].reshape(self.n, self.bits)
            value |= (spread.astype(np.uint64) << np.arange(self.bits, dtype=np.uint64)).sum(1, dtype=np.uint64)
        return value

    def parts(self) -> list[bytes]:
        return [self.low.tobytes(), self.high.tobytes(), self.samples.tobytes()]

    @classmethod
    def load(cls, n: int, bits: int, parts: list[bytes]) -> EliasFano:
        return cls(n, bits, np.frombuffer(parts[0], np.uint8), np.frombuffer(parts[1], np.uint8), np.frombuffer(parts[2], "<u4"))


class CachedEncoder:
    """The tokenizers library, asked once per distinct word of a worker.

    The file's normalizer and splitter never join text over a piece's ends, so a
    text's ids are its pieces' ids in order.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.kind = "<u2" if self.library.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4"
        added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self._special = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True))) or r"(?!)")
        self.known: dict[str, bytes] = {}

        # pieces that the file's pattern never joins are encoded many at a time; a
        # token with the end-of-word mark ends its piece
        mark = json.loads(self.library.to_str())["model"].get("end_of_word_suffix") or None
        self.ends = mark and np.array([t.endswith(mark) for t, _ in sorted(self.library.get_vocab().items(), key=lambda x: x[1])])

    def _each(self, words: list[str]) -> dict[str, bytes]:
        got = self.library.encode_batch_fast(words, add_special_tokens=False)
        return {w: np.array(e.ids, self.kind).tobytes() for w, e in zip(words, got, strict=True)}

    def _learn(self, words: list[str], plain: bool) -> dict[str, bytes]:
        if not plain or self.ends is None:
            return self._each(words)
        out, size = {}, np.dtype(self.kind).itemsize
        for a in range(0, len(words), 256):
            some = words[a:a + 256]
            ids = np.array(self.library.encode(" ".join(some), add_special_tokens=False).ids, self.kind)
            at = np.flatnonzero(self.ends[ids])
            if len(at) != len(some):
                out |= self._each(some)
                continue
            data, begin = ids.tobytes(), 0
            for w, end in zip(some, ((at + 1) * size).tolist()):
                out[w] = data[begin:end]
                begin = end
        return out

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > CACHE_WORDS:
            self.known = {}
        get = self.known.get
        split = [pieces(t, self._special) for t in texts]
        found = [list(map(get, words)) for words, _ in split]
        open_ = [k for k, f in enumerate(found) if None in f]
        own: dict[str, bytes] = {}
        for kind in (True, False):
            new = {w for k in open_ if split[k][1] is kind for w, i in zip(split[k][0], found[k]) if i is None and w not in own}
            own |= self._learn(list(new), kind)
        for k in open_:
            found[k] = [own[w] if i is None else i for w, i in zip(split[k][0], found[k])]
        self.known.update((w, i) for w, i in own.items() if len(w) <= CACHED_LENGTH)
        return [b"".join(f) for f in found]


@lru_cache(maxsize=2)
def _encoder(path: str) -> CachedEncoder:
    return CachedEncoder(path)


def write_shard(root: str, shard: int, ids: list[bytes], docs: list[int | None], kind: str, end: int) -> dict:
    """Write one shard file; ``ids`` hold each document's ids with its end id."""
    size = np.dtype(kind).itemsize
    ends = np.cumsum([len(i) // size for i in ids], dtype=np.uint64)
    bounds = EliasFano.build(np.concatenate([np.zeros(1, np.uint64), ends]))
    named = [d for d in docs if d is not None]
    base = named[0] if named else 0
    keys = EliasFano.build(np.array([d - base for d in named], np.uint64))
    parts = [*bounds.parts(), *keys.parts()]
    head = {"kind": kind, "end": end, "n_docs": len(docs), "n_null": len(docs) - len(named), "n_ids": int(ends[-1]), "base": base,
            "bits": [bounds.bits, keys.bits], "parts": [len(p) for p in parts]}
    head_bytes = json.dumps(head, sort_keys=True).encode()
    fs, at = filesystem(root)
    name, made = f"{at}/ids-{shard:06d}.eftk", f"{at}/_temporary/ids-{shard:06d}-{uuid.uuid4().hex}"
    with fs.open_output_stream(made) as f:
        f.write(MAGIC + len(head_bytes).to_bytes(4, "little") + head_bytes)
        for i in ids:
            f.write(i)
        for p in parts:
            f.write(p)
    commit(fs, made, name)
    return {"shard": shard, "n_docs": len(docs), "n_ids": int(ends[-1]), "index_bytes": sum(map(len, parts))}


def read_shard(root: str, shard: int) -> tuple[dict, np.ndarray, EliasFano, EliasFano]:
    """(header, ids, boundaries, document ids) of one shard file."""
    fs, at = filesystem(root)
    with fs.open_input_file(f"{at}/ids-{shard:06d}.eftk") as f:
        if f.read(8) != MAGIC:
            raise ValueError(f"not a token file: shard {shard}")
        head = json.loads(f.read(int.from_bytes(f.read(4), "little")))
        ids = np.frombuffer(f.read(head["n_ids"] * np.dtype(head["kind"]).itemsize), head["kind"])
        parts = [f.read(n) for n in head["parts"]]
    return (head, ids, EliasFano.load(head["n_docs"] + 1, head["bits"][0], parts[:3]),
            EliasFano.load(head["n_docs"] - head["n_null"], head["bits"][1], parts[3:]))


def write_token_files(docs: DataFrame, root: str, path: str, end_id: int = 2, id_col: str = "doc_id",
                      text_col: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Encode all texts and write shard files; returns the manifest
    (shard, n_docs, n_ids, index_bytes, first_id), also kept under ``root``.

    Null and empty texts hold the end id only.  Null ids come first; repeated
    rows are written each.  Rows of one id stand in text order.  An empty table
    writes no file.  Other columns are ignored.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"))
    shard, count = shard_column(rows.select("doc_id", F.octet_length("text").alias("b")), "doc_id", F.col("b") + 16, shard_bytes)
    fs, at = filesystem(root)
    fs.create_dir(f"{at}/_temporary", recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = _encoder(path)
        tail = np.array([end_id], codes.kind).tobytes()
        now, ids, own = None, [], []
        made = []
        for batch in batches:
            shards = batch.column(0).to_numpy()
            got = codes.encode_batch([x.as_py().decode("utf-8", "replace") for x in batch.column(2)])
            keys = batch.column(1).to_pylist()
            for k, s in enumerate(shards):
                if s != now:
                    if own:
                        made.append(write_shard(root, now, ids, own, codes.kind, end_id))
                    now, ids, own = int(s), [], []
                ids.append(got[k] + tail)
                own.append(keys[k])
        if own:
            made.append(write_shard(root, now, ids, own, codes.kind, end_id))
        if made:
            yield pa.RecordBatch.from_pylist(made, pa.schema([("shard", pa.int32()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("index_bytes", pa.int64())]))

    dealt = rows.select(shard.alias("shard"), "doc_id", "text")
    # a shard is a partition of its own
    manifest = (dealt.repartitionById(count, F.col("shard")).sortWithinPartitions("shard", "doc_id", "text")
                .mapInArrow(run, "shard int, n_docs long, n_ids long, index_bytes long"))
    manifest = table(manifest, "manifest")
    # one row per shard (at most MAX_SHARDS): the running count fits any task
    starts, rows_out = 0, []
    for r in sorted(manifest.collect()):
        rows_out.append((*r, starts))
        starts += r["n_ids"]
    fs.create_dir(at, recursive=True)
    with fs.open_output_stream(f"{at}/manifest.json") as f:
        f.write(json.dumps([dict(zip(("shard", "n_docs", "n_ids", "index_bytes", "first_id"), r)) for r in rows_out]).encode())
    return spark.createDataFrame(rows_out, "shard int, n_docs long, n_ids long, index_bytes long, first_id long")


#: Documents whose boundaries are selected at a time.
SELECTED = 4096


def shard_rows(root: str, shard: int, first: int) -> Iterator[pa.RecordBatch]:
    """doc_id, start, n_tokens, ids_crc32 of one shard's documents; places and ids come through ``select``."""
    head, ids, bounds, keys = read_shard(root, shard)
    none = head["n_null"]
    for low in range(0, head["n_docs"], SELECTED):
        high = min(low + SELECTED, head["n_docs"])
        at = bounds.select_many(np.arange(low, high + 1)).astype(np.int64)
        named = keys.select_many(np.arange(max(low - none, 0), max(high - none, 0))).astype(np.int64) + head["base"]
        wide = ids[at[0]:at[-1]].astype("<u4").tobytes()
        own = (at - at[0]).tolist()
        yield pa.RecordBatch.from_pydict({
            "doc_id": pa.array([None] * (high - low - len(named)) + named.tolist(), pa.int64()),
            "start": pa.array(at[:-1] + first, pa.int64()),
            "n_tokens": pa.array(np.diff(at), pa.int64()),
            "ids_crc32": pa.array([zlib.crc32(wide[4 * a:4 * b]) for a, b in zip(own, own[1:])], pa.int64()),
        })


def read_token_files(manifest: DataFrame, root: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, first in zip(*(batch.column(k).to_pylist() for k in (0, 1))):
                yield from shard_rows(root, shard, first)

    count = max(1, manifest.count())
    spread = manifest.select("shard", "first_id").repartitionById(count, F.col("shard"))
    return spread.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
