"""BPE encoding and decoding with forced boundaries (operator 6).

Two neighbouring symbols that stand side by side in no vocabulary token can
never end up in one token, so the place between them is a certain cut.  Each
word is cut there, the fragments are merged one by one, and their ids are
concatenated.  Pieces repeat, so a worker keeps the ids of those it has met.

The vocabulary file is a parameter (a JSON file of the ``tokenizers`` library
with a BPE model, an NFC / white space / lower case normalizer and a split
pattern).  Its normalizer and splitter are taken from the file as they are;
merging and decoding are done here.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pkgsift.llm.common import bounded_batches
from pkgsift.llm.pieces import pieces

#: Entries a worker keeps per cache; a full cache is emptied, results don't change.
CACHE_WORDS = 500_000
#: Longer pieces are encoded each time.
CACHED_LENGTH = 64


class BoundaryBPE:
    """Encoder and decoder for one vocabulary file."""

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        from tokenizers import Tokenizer

        self.cache_words = cache_words
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end: str = model.get("end_of_word_suffix") or ""
        self.ranks = {}
        for rank, m in enumerate(model["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            self.ranks[a, b] = rank
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: t for t, i in (self.vocab | self.special).items()}
        self._special = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        library = Tokenizer.from_file(path)
        self._normalize = library.normalizer.normalize_str
        self._split = library.pre_tokenizer.pre_tokenize_str
        self.joined = {pair for t in self.vocab for u in [self._symbols(t)] for pair in zip(u, u[1:])}
        # byte value -> printable symbol: visible Latin-1 stands for itself, the rest is numbered from 256
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
        rest = [b for b in range(256) if b not in set(shown)]
        self._byte = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(rest)}
        self._known: dict[str, bytes] = {}

    def _symbols(self, token: str) -> list[str]:
        """Byte symbols of a token; the last one carries the end-of-word mark."""
        if self.end and token.endswith(self.end) and token != self.end:
            body = token[:-len(self.end)]
            return [*body[:-1], body[-1] + self.end]
        return list(token)

    def fragments(self, piece: str) -> list[tuple[str, ...]]:
        """The byte symbols of one word, cut at every certain boundary."""
        symbols = [*piece[:-1], piece[-1] + self.end]
        cuts = [0, *(k for k in range(1, len(symbols)) if (symbols[k - 1], symbols[k]) not in self.joined), len(symbols)]
        return [tuple(symbols[a:b]) for a, b in zip(cuts, cuts[1:])]

    def _merge(self, symbols: tuple[str, ...]) -> list[int]:
        parts, ranks = list(symbols), self.ranks
        while len(parts) > 1:
            best = min(((ranks[p], k) for k, p in enumerate(zip(parts, parts[1:])) if p in ranks), default=None)
            if best is None:
                break
            k = best[1]
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
        return [self.vocab[p] for p in parts if p in self.vocab]

    def encode_piece(self, symbols: str) -> list[int]:
        """Ids of one piece, given as byte symbols: cut, merge, concatenate."""
        ids: list[int] = []
        for fragment in self.fragments(symbols):
            ids += self._merge(fragment) if len(fragment) <= 64 else self._merge_long(fragment)
        return ids

    def _plain(self, text: str) -> list[int]:
        return [i for piece, _ in self._split(self._normalize(text)) for i in self.encode_piece(piece)]

    def _merge_long(self, symbols: tuple[str, ...]) -> list[int]:
        """The same merges with a heap over a linked list, for very long fragments."""
        import heapq

        n = len(symbols)
        parts: list[str | None] = list(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(self.ranks[p], k, *p) for k, p in enumerate(zip(symbols, symbols[1:])) if p in self.ranks]
        heapq.heapify(heap)
        while heap:
            _, k, a, b = heapq.heappop(heap)
            if parts[k] != a or after[k] >= n or parts[after[k]] != b:
                continue
            gone = after[k]
            parts[k], parts[gone], after[k] = a + b, None, after[gone]
            if after[k] < n:
                before[after[k]] = k
            for left, right in ((before[k], k), (k, after[k])):
                if 0 <= left and right < n and (parts[left], parts[right]) in self.ranks:
                    heapq.heappush(heap, (self.ranks[parts[left], parts[right]], left, parts[left], parts[right]))
        return [self.vocab[p] for p in parts if p is not None and p in self.vocab]

    def encode_word(self, word: str) -> list[int]:
        """Ids of text without ASCII white space; special strings become their ids."""
        ids, at = [], 0
        for m in self._special.finditer(word):
            ids += self._plain(word[at:m.start()])
            ids.append(self.special[m.group()])
            at = m.end()
        return ids + self._plain(word[at:])

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text, as little-endian unsigned 32-bit integers.

        White space separates: no token, special string or normalization step of
        the file reaches over it, so each word is encoded on its own.
        """
        words, plain = pieces(text, self._special)
        known, get = self._known, self._known.get
        out = list(map(get, words))
        if None in out:
            for k, w in enumerate(words):
                if out[k] is None:
                    ids = self.encode_piece("".join(self._byte[b] for b in w.encode())) if plain else self.encode_word(w)
                    out[k] = np.array(ids, "<u4").tobytes()
                    if len(w) <= CACHED_LENGTH:
                        if len(known) >= self.cache_words:
                            known.clear()
                        known[w] = out[k]
        return np.frombuffer(b"".join(out), "<u4")

    def decode(self, ids: Iterable[int]) -> str:
        """The tokens' strings with a space between (the file names no decoder)."""
        return " ".join(map(self.names.__getitem__, ids))


@lru_cache(maxsize=2)
def encoder(path: str, cache_words: int = CACHE_WORDS) -> BoundaryBPE:
    return BoundaryBPE(path, cache_words)


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                     keep_ids: bool = True, cache_words: int = CACHE_WORDS) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 [, ids array<int>, decoded string].

    One row per input row, repeated rows included; a null or empty text, or one
    of white space only, has no ids and an empty decoded text.  Texts of any
    length are encoded whole.  Other columns are ignored.  An empty table gives
    no rows.  ``path`` must be readable on every executor.  A worker keeps the ids of
    ``cache_words`` words; fewer take less memory and more time.
    """
    bounded_batches(docs.sparkSession)
    kind = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if keep_ids:
        kind += ", ids array<int>, decoded string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path, cache_words)
        for batch in batches:
            ids = [bpe.encode((x.as_py() or b"").decode("utf-8", "replace")) for x in batch.column(1)]
            decoded = [bpe.decode(i.tolist()) for i in ids]
            out = {
                "doc_id": batch.column(0),
                "n_tokens": pa.array(map(len, ids), pa.int64()),
                "ids_sha256": pa.array([hashlib.sha256(i.tobytes()).hexdigest() for i in ids], pa.string()),
                "decoded_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() for t in decoded], pa.string()),
            }
            if keep_ids:
                out["ids"] = pa.array([i.astype(np.int32) for i in ids], pa.list_(pa.int32()))
                out["decoded"] = pa.array(decoded, pa.string())
            yield pa.RecordBatch.from_pydict(out)

    text: Column = F.col(text_col).cast("binary")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text")).mapInArrow(run, kind)
