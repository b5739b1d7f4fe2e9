"""Cross-tokenizer alignment by inverted pair bitmaps (operator 12).

Two tokenizers cut the same bytes.  Offsets where a token of both ends cut a
text into groups, and every pair of an A and a B token in one group is a link.
For each id pair a segment of documents holds compressed document bitmaps, one
per binary digit of the pair's multiplicity (its planes): the bits of their OR
are the documents that hold the pair linked, and the planes' weighted bits its
links.  Segments hold different documents, so a pair's counts over the corpus
are sums of popcounts; they go back along the postings, and each plane adds its
weight times the pair's score to its documents.

A text is cut before each run of blanks that follows another character (and
does not begin with a carriage return): no token of either vocabulary reaches over that place, so both tokenizers end a
token there.  What lies between two cuts is aligned once per worker and kept.
A text with any other white space, or with a word mark of the B vocabulary, is
aligned whole.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pkgsift.llm.common import bounded_batches, table

#: Documents of a segment (ordinals take 13 bits) and (pair, document) entries after which it is closed.
SEGMENT_BITS = 13
SEGMENT_ENTRIES = 2_000_000
#: Aligned pieces, and their characters and links, that a worker keeps; then all are dropped.  Results don't change.
KEPT_PIECES, KEPT_SIZE = 250_000, 6_000_000
#: Pieces of a long text that are handled at a time, pieces looked up together, and
#: new ones that are encoded as one text.
SLAB, TOGETHER, JOINED = 100_000, 200_000, 4_000
#: Links of a group up to which all its pairs are listed one by one.
LISTED = 4_096
#: Fixed: how byte-level vocabularies print the 256 byte values.
_SHOWN = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
_SYMBOL = {chr(b): b for b in _SHOWN} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(_SHOWN))}
#: Fixed: the mark that stands for a space in B's pieces.
_MARK = "\u2581"
_BLANKS = _ENDS = " \n\t\r"
#: White space of other kinds, and B's mark.
_ODD = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\u2581]")
# a carriage return may be joined to the character before it, so no cut stands before one
_PIECE = re.compile(rf"[{_BLANKS}]*+[^{_BLANKS}]++(?:\r[{_BLANKS}]*+[^{_BLANKS}]*+)*+|[{_BLANKS}]++")


class Aligner:
    """Both vocabularies, and the alignment of single pieces of text."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_a = {i: bytes(_SYMBOL[c] for c in t) if all(c in _SYMBOL for c in t) else t.encode() for t, i in self.a.get_vocab().items()}
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_MARK, " ").encode() for i, p in enumerate(names)]
        self.mark = self.b.piece_to_id(_MARK)
        # of every id: its bytes' number, and what it shows inside a group and at the end of its side
        sizes_a = [len(self.bytes_a.get(i, b"")) for i in range(max(self.bytes_a) + 1)]
        self.sizes = np.array(sizes_a), np.array([len(x) for x in self.bytes_b])
        self.inner = tuple(np.array([f"{i}," for i in range(len(n))], object) for n in self.sizes)
        self.last = tuple(np.array([f"{i}{end}" for i in range(len(n))], object) for n, end in zip(self.sizes, "|;"))
        self.widths = tuple(np.array([len(x) for x in shown]) for shown in self.inner)
        # pieces that join a character to a mark behind it, or that hold a line end or tab, would forbid the cuts
        self.cuts = not any(re.search(f"[^{_MARK}]{_MARK}|[\n\t]", p) for i, p in enumerate(names) if not self.b.is_byte(i))

    def slabs(self, text: str) -> Iterator[list[str]]:
        """``text`` (which starts with a space) between its certain cuts, some pieces at a time."""
        if not self.cuts or _ODD.search(text):
            yield [text]
        elif len(text) <= SLAB:
            yield _PIECE.findall(text)
        else:
            found = (m.group() for m in _PIECE.finditer(text))
            while some := list(islice(found, SLAB)):
                yield some

    def encode(self, pieces: list[str]) -> list[tuple[list[int], list[int]]]:
        """Ids of A and of B for each piece, as they are inside a text."""
        own = [p[1:] if p[0] == " " else p for p in pieces]  # B puts the first space itself
        found = []
        for p, a, b in zip(pieces, self.a.encode_batch(pieces, add_special_tokens=False), self.b.encode(own, num_threads=1)):
            if p == " ":
                b = [self.mark]
            elif p[0] != " ":
                b = b[1:]
            found.append((a.ids, b))
        return found

    def align(self, piece: str, a: list[int], b: list[int]) -> tuple[int, str, dict[int, int]] | None:
        """(groups, their text, links per pair key) of a piece, or None if the tokens' bytes are not the piece's."""
        raw, of_a, of_b = piece.encode("utf-8", "replace"), self.bytes_a, self.bytes_b
        parts_a, parts_b = [of_a[i] for i in a], [of_b[i] for i in b]
        if b"".join(parts_a) != raw or b"".join(parts_b) != raw:
            return None
        shown, links = [], {}
        i = j = 0
        while i < len(a):
            low_i, low_j = i, j
            ahead = len(parts_a[i]) - len(parts_b[j])  # bytes that A's tokens of the group reach beyond B's
            i, j = i + 1, j + 1
            if not ahead:
                s, t = a[low_i], b[low_j]
                shown.append(f"{s}|{t}")
                links[s << 32 | t] = links.get(s << 32 | t, 0) + 1
                continue
            while ahead:
                if ahead < 0:
                    ahead += len(parts_a[i])
                    i += 1
                else:
                    ahead -= len(parts_b[j])
                    j += 1
            own_a, own_b = a[low_i:i], b[low_j:j]
            shown.append(f"{','.join(map(str, own_a))}|{','.join(map(str, own_b))}")
            if len(own_a) + len(own_b) > 8:
                pairs = [(s, t, n * m) for s, n in Counter(own_a).items() for t, m in Counter(own_b).items()]
            else:
                pairs = [(s, t, 1) for s in own_a for t in own_b]
            for s, t, n in pairs:
                links[s << 32 | t] = links.get(s << 32 | t, 0) + n
        return len(shown), ";".join(shown), links


class Known:
    """Aligned pieces of a worker by number: what they show, counts, and links in flat arrays."""

    def __init__(self, aligner: Aligner):
        self.aligner = aligner
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.shown: list[str | None] = []
        self.counts = array("q")  # A tokens, B tokens, groups, links, pairs, and where the pairs start
        self.keys, self.many = array("q"), array("q")
        self.size = 0

    def add(self, pieces: list[str]) -> None:
        """Align new pieces: most of them as one text, as no token reaches from one
        to the next; odd ones, and ones that end in a blank, each by itself."""
        odd, joined = [], []
        for p in pieces:
            (odd if p[-1] in _ENDS or _ODD.search(p) else joined).append(p)
        for k in range(0, len(joined), JOINED):
            some = joined[k:k + JOINED]
            if not self._add_joined(some):
                odd += some
        if odd:
            self._add_each(odd)

    def _add_joined(self, pieces: list[str]) -> bool:
        """Align pieces that follow each other; False if their bytes or ends are not the tokens', or a group is very large."""
        own = self.aligner
        text = " ." + "".join(pieces)  # a piece in front, for the space that B adds
        a = np.array(own.a.encode(text, add_special_tokens=False).ids)
        b = np.array(own.b.encode(text[1:]))
        raw = text.encode("utf-8", "replace")
        if b"".join(map(own.bytes_a.__getitem__, a.tolist())) != raw or b"".join(map(own.bytes_b.__getitem__, b.tolist())) != raw:
            return False
        ends_a, ends_b = np.cumsum(own.sizes[0][a]), np.cumsum(own.sizes[1][b])
        ends = np.cumsum([2, *(map(len, pieces) if len(raw) == len(text) else (len(p.encode("utf-8", "replace")) for p in pieces))])
        both = np.intersect1d(ends_a, ends_b, assume_unique=True)
        group = np.searchsorted(both, ends)  # a piece's last group
        if group[-1] >= len(both) or (both[group] != ends).any():
            return False
        upto_a, upto_b = np.searchsorted(ends_a, both) + 1, np.searchsorted(ends_b, both) + 1
        n_a, n_b = np.diff(upto_a, prepend=0), np.diff(upto_b, prepend=0)
        links = n_a * n_b
        if links.max() > LISTED:
            return False
        # what groups show: A's ids, then B's, group after group
        at_a = np.arange(len(a)) + np.repeat(upto_b - n_b, n_a)
        at_b = np.arange(len(b)) + np.repeat(upto_a, n_b)
        shown = np.empty(len(a) + len(b), object)
        shown[at_a], shown[at_b] = own.inner[0][a], own.inner[1][b]
        shown[at_a[upto_a - 1]], shown[at_b[upto_b - 1]] = own.last[0][a[upto_a - 1]], own.last[1][b[upto_b - 1]]
        width = np.empty(len(shown), np.int64)
        width[at_a], width[at_b] = own.widths[0][a], own.widths[1][b]
        line = "".join(shown.tolist())
        stop = np.cumsum(width)[(upto_a + upto_b)[group] - 1].tolist()
        # every pair of a group
        which = np.repeat(np.arange(len(links)), links)
        k = np.arange(len(which)) - np.repeat(np.cumsum(links) - links, links)
        keys = a[(upto_a - n_a)[which] + k // n_b[which]] << 32 | b[(upto_b - n_b)[which] + k % n_b[which]]
        pairs = np.cumsum(links)[group]
        counts = np.stack([np.diff(x) for x in (upto_a[group], upto_b[group], group + 1, pairs, pairs)] + [pairs[:-1] - pairs[0] + len(self.keys)], axis=1)
        first = len(self.shown)
        self.number.update(zip(pieces, range(first, first + len(pieces))))
        self.shown += [line[x:y - 1] for x, y in zip(stop, stop[1:])]
        self.counts.frombytes(counts.astype(np.int64).tobytes())
        self.keys.frombytes(keys[pairs[0]:].astype(np.int64).tobytes())
        self.many.frombytes(np.ones(len(keys) - pairs[0], np.int64).tobytes())
        self.size += len(text) + len(keys)
        return True

    def _add_each(self, pieces: list[str]) -> None:
        at, counts, keys, many = len(self.keys), [], [], []
        for p, (a, b) in zip(pieces, self.aligner.encode(pieces)):
            found = self.aligner.align(p, a, b)
            self.number[p] = len(self.shown)
            self.size += len(p)
            if found is None:
                self.shown.append(None)
                counts += (0, 0, 0, 0, 0, at)
                continue
            groups, shown, links = found
            self.shown.append(shown)
            counts += (len(a), len(b), groups, sum(links.values()), len(links), at)
            keys += links.keys()
            many += links.values()
            at += len(links)
            self.size += len(links)
        self.counts.extend(counts)
        self.keys.extend(keys)
        self.many.extend(many)

    def documents(self, texts: list[str]) -> Iterator[Document]:
        """Every text's document, in order."""
        docs, group, held = [], [], 0
        for text in texts:
            doc = Document()
            docs.append(doc)
            for slab in self.aligner.slabs(" " + text) if text else ():
                group.append((doc, slab))
                held += len(slab)
                if held >= TOGETHER:
                    self._align(group)
                    yield from docs[:-1]
                    docs, group, held = docs[-1:], [], 0
        self._align(group)
        yield from docs

    def _align(self, group: list[tuple[Document, list[str]]]) -> None:
        if len(self.shown) > KEPT_PIECES or self.size > KEPT_SIZE:
            self.clear()
        if not group:
            return
        number = self.number
        missed = {p for _, slab in group for p in slab if p not in number}
        if missed:
            self.add(list(missed))
        counts = np.frombuffer(self.counts, np.int64).reshape(-1, 6)
        keys, many = (np.frombuffer(x, np.int64) if x else np.zeros(0, np.int64) for x in (self.keys, self.many))
        for doc, slab in group:
            own = list(map(number.__getitem__, slab))
            shown = list(map(self.shown.__getitem__, own))
            if None in shown:
                doc.whole = False
            if not doc.whole:
                continue
            found = counts[own]
            at = _gather(found[:, 5], found[:, 4])
            doc.add(found[:, :4].sum(axis=0), ";".join(shown), *_merged(keys[at], many[at]))


class Document:
    """Counts, groups and links of one text; nothing if the tokens' bytes are not the text's."""

    def __init__(self):
        self.whole = True
        self.counts = np.zeros(4, np.int64)
        self.groups = hashlib.sha256()
        self.links: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, counts: np.ndarray, shown: str, keys: np.ndarray, many: np.ndarray) -> None:
        self.groups.update((";" if self.links else "").encode() + shown.encode())
        self.counts += counts
        self.links.append((keys, many))

    def result(self) -> tuple[list[int], str, np.ndarray, np.ndarray]:
        """Tokens of A and B, groups and links; the groups' digest; pair keys and their links."""
        none = np.zeros(0, np.int64)
        if not self.whole or not self.links:
            return [0, 0, 0, 0], "", none, none
        keys, many = self.links[0] if len(self.links) == 1 else _merged(*map(np.concatenate, zip(*self.links)))
        return self.counts.tolist(), self.groups.hexdigest(), keys, many


@lru_cache(maxsize=1)
def known(path_a: str, path_b: str) -> Known:
    return Known(Aligner(path_a, path_b))


def _gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions starts[0], starts[0]+1, …, then those from starts[1], and so on."""
    total = int(lengths.sum())
    return np.arange(total) + np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)


def _merged(key: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal keys once, in order, with their sums."""
    if not len(key):
        return key, many
    order = np.argsort(key, kind="stable")
    key, many = key[order], many[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    return key[first], np.add.reduceat(many, first)


def pack(ordinals: np.ndarray, starts: np.ndarray, bits: int) -> list[bytes]:
    """Compressed bitmaps: ``ordinals`` ascend from each of ``starts`` to the next.

    A sparse bitmap is the gaps, seven bits a byte with 128 for "more follows"
    (at most two bytes, as ordinals have ``bits`` bits, 14 at most); one that would take no
    less than the plain bitmap is that bitmap.  The length tells which.
    """
    if not len(starts):
        return []
    gap = np.diff(ordinals, prepend=0)
    gap[starts] = ordinals[starts]
    two = gap >= 128
    at = np.cumsum(1 + two) - (1 + two)
    data = np.empty(len(gap) + int(two.sum()), np.uint8)
    data[at] = np.where(two, gap & 127 | 128, gap)
    data[at[two] + 1] = gap[two] >> 7
    plain, raw = (1 << bits) // 8, data.tobytes()
    ends = np.r_[at[starts[1:]], len(data)].tolist()
    cuts = np.r_[starts, len(ordinals)].tolist()
    out = []
    for k, (x, y) in enumerate(zip(at[starts].tolist(), ends)):
        if y - x < plain:
            out.append(raw[x:y])
        else:
            full = np.zeros(1 << bits, np.uint8)
            full[ordinals[cuts[k]:cuts[k + 1]]] = 1
            out.append(np.packbits(full).tobytes())
    return out


def unpack(data: np.ndarray, ends: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(ordinals, their bitmap's number) of packed bitmaps that lie one after the other up to ``ends``."""
    lengths = np.diff(ends, prepend=0)
    full = np.flatnonzero(lengths == (1 << bits) // 8)
    ordinals, owner = [], []
    for k in full.tolist():
        found = np.flatnonzero(np.unpackbits(data[ends[k] - lengths[k]:ends[k]]))
        ordinals.append(found)
        owner.append(np.full(len(found), k))
    sparse = lengths.copy()
    sparse[full] = 0
    part = data[_gather(ends - lengths, sparse)].astype(np.int64)
    whose = np.repeat(np.arange(len(ends)), sparse)
    if len(part):
        starts = np.flatnonzero(np.r_[True, part[:-1] < 128])
        low = part[starts]
        high = part[np.minimum(starts + 1, len(part) - 1)]
        gap = np.where(low >= 128, (low & 127) | high << 7, low)
        whose = whose[starts]
        total = np.cumsum(gap)
        first = np.flatnonzero(np.r_[True, whose[1:] != whose[:-1]])
        before = total[first] - gap[first]
        ordinals.append(total - np.repeat(before, np.diff(np.r_[first, len(whose)])))
        owner.append(whose)
    if not ordinals:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(ordinals), np.concatenate(owner)


def planes(ordinals: np.ndarray, many: np.ndarray, starts: np.ndarray, bits: int = SEGMENT_BITS) -> list[list[bytes]]:
    """For each run from ``starts``: the bitmaps of its multiplicities' binary digits, lowest first."""
    run = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(ordinals)]))
    out: list[list[bytes]] = [[] for _ in range(len(starts))]
    for digit in range(int(many.max(initial=0)).bit_length()):
        here = np.flatnonzero(many >> digit & 1)
        own = run[here]
        first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(own) else np.zeros(0, np.int64)
        for k, packed in zip(own[first].tolist(), pack(ordinals[here], first, bits)):
            out[k] += [b""] * (digit - len(out[k]))  # a lower digit no document has
            out[k].append(packed)
    return out


class Segment:
    """Documents of one segment and their links, until it is closed."""

    def __init__(self, seg: int):
        self.seg, self.entries = seg, 0
        self.docs: list[tuple] = []
        self.links: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, doc_id: int | None, doc: Document) -> None:
        counts, groups, keys, many = doc.result()
        if len(keys):
            self.links.append((keys, many, np.full(len(keys), len(self.docs), np.int16)))
            self.entries += len(keys)
        self.docs.append((doc_id, *counts, groups))

    def close(self) -> Iterator[pa.RecordBatch]:
        """The documents' rows, then a row for each pair."""
        n = len(self.docs)
        columns = zip(("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"), zip(*self.docs))
        yield _rows(n, kind=[0] * n, seg=[self.seg] * n, ordinal=range(n), **dict(columns))
        if not self.links:
            return
        key, many, ordinal = map(np.concatenate, zip(*self.links))
        order = np.argsort(key, kind="stable")  # documents stay in order
        key, many, ordinal = key[order], many[order], ordinal[order].astype(np.int64)
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        ends = np.r_[starts[1:], len(key)]
        for k in range(0, len(starts), 16_384):
            some, upto = starts[k:k + 16_384], ends[k:k + 16_384]
            lo, hi = some[0], upto[-1]
            bitmaps = planes(ordinal[lo:hi], many[lo:hi], some - lo)
            yield _rows(len(some), kind=np.ones(len(some), np.int32), seg=np.full(len(some), self.seg), a=(key[some] >> 32).astype(np.int32),
                        b=(key[some] & 0xFFFFFFFF).astype(np.int32), n_docs=upto - some, n_links=np.add.reduceat(many[lo:hi], some - lo), planes=bitmaps)


_FIELDS = pa.schema([("kind", pa.int32()), ("seg", pa.int64()), ("doc_id", pa.int64()), ("ordinal", pa.int32()), ("n_a", pa.int64()), ("n_b", pa.int64()),
                     ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("a", pa.int32()), ("b", pa.int32()),
                     ("n_docs", pa.int64()), ("planes", pa.list_(pa.binary()))])
POSTINGS = ("kind int, seg long, doc_id long, ordinal int, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
            "a int, b int, n_docs long, planes array<binary>")


def _rows(n: int, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in _FIELDS], schema=_FIELDS)


def postings(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Segments of documents: a row of ``kind`` 0 for each document with its
    counts, then a row of ``kind`` 1 for each id pair with its bitmaps."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = known(path_a, path_b)
        number = TaskContext.get().partitionId() << 32
        now = Segment(number)
        for batch in batches:
            texts = ((x.as_py() or b"").decode("utf-8", "replace") for x in batch.column(1))
            for doc_id, doc in zip(batch.column(0).to_pylist(), pieces.documents(texts)):
                now.add(doc_id, doc)
                if len(now.docs) == 1 << SEGMENT_BITS or now.entries >= SEGMENT_ENTRIES:
                    yield from now.close()
                    number += 1
                    now = Segment(number)
        if now.docs:
            yield from now.close()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text")).mapInArrow(run, POSTINGS)


def pair_scores(posted: DataFrame) -> DataFrame:
    """(a, b, count, links, best): documents that hold the pair linked, links in
    all, and whether the count is its A id's highest (ties included)."""
    pairs = table(posted.where("kind = 1").groupBy("a", "b").agg(F.sum("n_docs").alias("count"), F.sum("n_links").alias("links")), "pairs")
    # one row per id of A's vocabulary
    highest = F.broadcast(pairs.groupBy("a").agg(F.max("count").alias("highest")))
    return pairs.join(highest, "a").select("a", "b", "count", "links", (F.col("count") == F.col("highest")).alias("best"))


def _returned(rows: DataFrame) -> DataFrame:
    """Document rows with the scores of the postings of their segment added up."""
    kind = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"

    def finish(docs: list[pa.RecordBatch], total: np.ndarray) -> Iterator[pa.RecordBatch]:
        for b in docs:
            at = b.column("ordinal").to_numpy()
            yield pa.RecordBatch.from_pydict({c: b.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
                                             | {"n_best": total[1][at], "count_sum": total[0][at], "groups_sha256": b.column("groups_sha256")})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seg, docs, total = None, [], None
        for whole in batches:
            segs = whole.column("seg").to_numpy()
            cuts = [0, *(np.flatnonzero(segs[1:] != segs[:-1]) + 1).tolist(), len(segs)]
            for x, y in zip(cuts, cuts[1:]):
                if x == y:
                    continue
                b = whole.slice(x, y - x)
                if segs[x] != seg:
                    if docs:
                        yield from finish(docs, total)
                    seg, docs, total = segs[x], [], np.zeros((2, 1 << SEGMENT_BITS), np.int64)
                first = int(np.searchsorted(b.column("kind").to_numpy(), 1))
                if first:
                    docs.append(b.slice(0, first).select(["ordinal", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]))
                if first < y - x:
                    give_back(b.slice(first), total)
        if docs:
            yield from finish(docs, total)

    return rows.mapInArrow(run, kind)


def give_back(b: pa.RecordBatch, total: np.ndarray) -> None:
    """Add each pair's count and best mark, times its links, to its documents."""
    lists = b.column("planes")
    depth = np.diff(lists.offsets.to_numpy())
    digit = _gather(np.zeros(len(depth), np.int64), depth.astype(np.int64))
    bitmaps = lists.flatten().to_pylist()
    ends = np.cumsum([len(x) for x in bitmaps], dtype=np.int64)
    ordinals, owner = unpack(np.frombuffer(b"".join(bitmaps), np.uint8), ends, SEGMENT_BITS)
    for k, score in enumerate((b.column("count").to_numpy(), b.column("best").to_numpy(zero_copy_only=False).astype(np.int64))):
        np.add.at(total[k], ordinals, (np.repeat(score, depth) << digit)[owner])


def align_documents(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A encodes a space and the text, B the text (it adds the space itself).
    One row per input row; every row is a document of its own in the counts,
    repeated rows and rows without an id included.  A null or empty text, and
    one whose tokens' bytes differ from space and text, has no tokens: zeros and
    an empty digest.  Texts of any length are aligned whole, a bounded number of
    pieces at a time; the distinct pairs of one document must fit a worker.  An
    empty table gives no rows; other columns are ignored.  Both files must be
    readable on every executor.
    """
    spark = docs.sparkSession
    posted = table(postings(docs, path_a, path_b, id_col, text_col), "postings")
    scored = posted.where("kind = 1").select("kind", "seg", "a", "b", "planes").join(pair_scores(posted), ["a", "b"])
    rows = (posted.where("kind = 0").select("kind", "seg", "ordinal", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
            .unionByName(scored.select("kind", "seg", "planes", "count", "best"), allowMissingColumns=True))
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return _returned(rows.repartition(width, "seg").sortWithinPartitions("seg", "kind"))
