"""Toxic span tagging with a linear-chain conditional random field (operator 10).

Learning (driver, on a bounded sample of labelled documents):

1. Features of a token are its word and its first 4 and 5 letters.  A feature
   whose documents are toxic far more often than the rest names offending
   tokens; tokens of toxic documents with such a feature get label 1, all others
   label 0.
2. A two-state chain with feature, bias and transition weights is fitted to the
   labelled tokens by gradient ascent on the regularized log-likelihood.
3. A logistic curve over two sums of forward-backward marginals (expected
   offending tokens, strongest token) turns them into a document score.

Scoring runs in tasks, a batch of whole documents at a time.  Labels, language,
source and ids are no inputs of a score.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pkgsift.llm.common import bounded_batches, tidy

#: Labelled documents that learning reads at most: toxic ones, and others.
MAX_TOXIC, MAX_CLEAN = 1000, 3000
#: Tokens of whole documents that a step of the fit holds at a time.
FIT_TOKENS = 200_000
#: Odds against the other documents that a feature must have to mark tokens.
MIN_ODDS = 20.0
#: Word sets of a Jaccard of at least so many fifths are near copies.
NEAR_FIFTHS = 4
CACHE_WORDS = 150_000
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text: bytes) -> list[bytes]:
    return _WORD.findall(text.lower())


def features(word: bytes) -> list[str]:
    w = word.decode("utf-8", "replace")
    return [f"w:{w}", *(f"p{n}:{w[:n]}" for n in (4, 5) if len(w) >= n)]


@dataclass
class SpanModel:
    """Weights of the chain and of the document curve."""

    weights: dict[str, float]
    bias: float
    trans: np.ndarray  # log weights [from, to]
    curve: tuple[float, float, float] = (-2.0, 1.0, 0.0)
    _known: dict[bytes, float] = field(default_factory=dict, repr=False)

    def emission(self, word: bytes) -> float:
        """Log weight of state 1 against state 0 for one token."""
        got = self._known.get(word)
        if got is None:
            if len(self._known) >= CACHE_WORDS:
                self._known.clear()
            got = self._known[word] = self.bias + sum(self.weights.get(f, 0.0) for f in features(word))
        return got

    def marginals(self, docs: list[list[bytes]]) -> list[np.ndarray]:
        """Log odds of state 1 at every token of every document."""
        return _marginals([np.fromiter(map(self.emission, d), float, len(d)) for d in docs], self.trans)

    def score(self, odds: np.ndarray) -> float:
        a, b, c = self.curve
        if not len(odds):
            return float(_sigmoid(np.float64(a + c * STRONGEST[0])))
        return float(_sigmoid(a + b * np.log1p(_sigmoid(odds).sum()) + c * np.clip(odds.max(), *STRONGEST)))


#: Range of the strongest token's log odds that the curve uses.
STRONGEST = (-8.0, 8.0)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def _step(x: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Log odds after one transition, from the log odds ``x`` before it."""
    return np.logaddexp(x + t[1, 1], t[0, 1]) - np.logaddexp(x + t[1, 0], t[0, 0])


#: Tokens of one segment of a chain; all segments of a batch step together.
SEGMENT = 128


def _ahead(flat: np.ndarray, sizes: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Forward log odds x_i = e_i + step(x_{i-1}) of chains laid end to end.

    Chains are cut into segments.  A segment maps the odds r before it to
    (a r + b) / (c r + d) behind it; these maps are multiplied up for all
    segments at once and chained, so the result is exact however long a chain is.
    """
    if not len(flat):
        return flat.copy()
    parts = -(-sizes // SEGMENT)
    chain = np.repeat(np.arange(len(sizes)), parts)
    number = np.arange(len(chain)) - np.repeat(np.cumsum(parts) - parts, parts)
    begin = np.repeat(np.cumsum(sizes) - sizes, parts) + number * SEGMENT
    length = np.minimum(SEGMENT, np.repeat(sizes, parts) - number * SEGMENT)
    rows = np.arange(min(SEGMENT, int(length.max())))[:, None]
    at = np.minimum(begin + rows, len(flat) - 1)
    e = flat[at]
    enter = np.zeros(len(chain))
    if number.any():
        inner = np.flatnonzero(length == SEGMENT)  # a segment with another behind it is full
        w, t = np.exp(np.clip(e[:, inner], -60, 60)), np.exp(trans)
        a, b, c, d = (np.full(len(inner), v) for v in (1.0, 0.0, 0.0, 1.0))
        for i in range(len(rows)):
            if i == 0:  # a chain's first token has no transition before it
                head = number[inner] == 0
                a1, b1, c1, d1 = np.where(head, w[0], w[0] * t[1, 1]), np.where(head, 0, w[0] * t[0, 1]), np.where(head, 0, t[1, 0]), np.where(head, 1, t[0, 0])
            else:
                a1, b1, c1, d1 = w[i] * t[1, 1], w[i] * t[0, 1], t[1, 0], t[0, 0]
            a, b, c, d = a1 * a + b1 * c, a1 * b + b1 * d, c1 * a + d1 * c, c1 * b + d1 * d
            top = np.maximum(np.maximum(a, b), np.maximum(c, d))
            a, b, c, d = a / top, b / top, c / top, d / top
        place = np.full(len(chain), -1)
        place[inner] = np.arange(len(inner))
        r = np.ones(len(sizes))  # before the first token: even odds, left as they are
        for k in range(1, int(number.max()) + 1):
            seg = np.flatnonzero(number == k)
            p, own = place[seg - 1], chain[seg]
            r[own] = np.clip((a[p] * r[own] + b[p]) / (c[p] * r[own] + d[p]), 1e-300, 1e300)
            enter[seg] = np.log(r[own])
    # odds behind each transition; one logarithm for all of them at the end
    r, t = np.exp(np.clip(e, -500, 500)), np.exp(trans)
    x = np.empty_like(e)
    x[0] = np.where(number == 0, 1.0, np.exp(_step(enter, trans)))
    for i in range(1, len(rows)):
        r[i - 1] *= x[i - 1]
        x[i] = (r[i - 1] * t[1, 1] + t[0, 1]) / (r[i - 1] * t[1, 0] + t[0, 0])
    x = e + np.log(x)
    out = np.empty_like(flat)
    live = rows < length
    out[at[live]] = x[live]
    return out


def _both_ways(flat: np.ndarray, sizes: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward log odds; their sum less the emission is the marginal's."""
    return _ahead(flat, sizes, trans), _ahead(flat[::-1], sizes[::-1], trans.T)[::-1]


def _marginals(emissions: list[np.ndarray], trans: np.ndarray) -> list[np.ndarray]:
    """Forward-backward over many chains at once, as log odds of state 1."""
    sizes = np.array([len(e) for e in emissions], int)
    if not sizes.sum():
        return list(emissions)
    flat = np.concatenate(emissions)
    kept = sizes[sizes > 0]
    ahead, back = _both_ways(flat, kept, trans)
    return np.split(ahead + back - flat, np.cumsum(sizes)[:-1])


def near_copies(sets: list[set[bytes]]) -> list[int]:
    """A group number per word set: sets of a Jaccard of at least 0.8 share one, directly or over others.

    Exact.  Two such sets have in common one of their rarest fifth of words (and one
    more), so only sets that meet there are compared, unless already in one group.
    """
    hashed = [np.sort(np.fromiter(map(xxhash.xxh64_intdigest, s), np.uint64, len(s))) for s in sets]
    values, counts = np.unique(np.concatenate([np.zeros(0, np.uint64), *hashed]), return_counts=True)
    rank = np.empty(len(values), np.int32)
    rank[np.argsort(counts, kind="stable")] = np.arange(len(values), dtype=np.int32)
    ranked = [np.sort(rank[np.searchsorted(values, h)]) for h in hashed]
    group = list(range(len(sets)))

    def top(k: int) -> int:
        while group[k] != k:
            group[k] = k = group[group[k]]
        return k

    first: dict[bytes, int] = {}
    posted: dict[int, list[int]] = {}
    for k in sorted(range(len(sets)), key=lambda k: len(ranked[k])):
        x = ranked[k]
        group[k] = first.setdefault(x.tobytes(), k)
        if group[k] != k:
            continue
        rare = x[:len(x) - -(-NEAR_FIFTHS * len(x) // 5) + 1].tolist()
        for j in {j for r in rare for j in posted.get(r, ())}:
            y = ranked[j]
            if 5 * len(y) >= NEAR_FIFTHS * len(x) and top(j) != top(k):
                both = len(np.intersect1d(x, y, assume_unique=True))
                if 5 * both >= NEAR_FIFTHS * (len(x) + len(y) - both):
                    group[top(j)] = top(k)
        for r in rare:
            posted.setdefault(r, []).append(k)
    return [top(k) for k in range(len(sets))]


def _offending(texts: list[bytes], toxic: np.ndarray) -> set[str]:
    """Features found in toxic documents far more often than chance allows.

    Near copies of one document count once: a feature's support is the number of
    groups of near copies among its toxic documents.  The bar for its log-likelihood ratio rises with the number
    of features found in as many toxic documents.
    """
    # features in a few toxic documents first, then those alone are counted elsewhere
    seen = [Counter(), Counter()]
    for x, t in zip(texts, toxic):
        if t:
            seen[1].update({f for w in set(words(x)) for f in features(w)})
    met = np.sort(np.fromiter(seen[1].values(), int, len(seen[1])))
    seen[1] = Counter({f: c for f, c in seen[1].items() if c >= 2})
    for x, t in zip(texts, toxic):
        if not t:
            seen[0].update({f for w in set(words(x)) for f in features(w) if f in seen[1]})
    n1, n0 = max(1, int(toxic.sum())), max(1, int((~toxic).sum()))
    share = n1 / (n0 + n1)
    some = {f for f, c in seen[1].items() if c / n1 >= MIN_ODDS * seen[0][f] / n0}
    held: dict[str, set[int]] = {f: set() for f in some}
    own = [set(words(texts[k])) for k in np.flatnonzero(toxic)]
    hits = [{f for w in o for f in features(w) if f in some} for o in own]
    for group, fs in zip(near_copies(own), hits):
        for f in fs:
            held[f].add(group)
    found = set()
    for f in some:
        c, d = len(held[f]), seen[0][f]
        gain = c * np.log(c / (c + d) / share) + (d * np.log(d / (c + d) / (1 - share)) if d else 0.0)
        # as many features as were met that often could have got there by chance
        if gain >= np.log(len(met) - np.searchsorted(met, c) + 1.0) + 2:
            found.add(f)
    return found


def _labelled_chains(texts: list[bytes], toxic: np.ndarray, index: dict[str, int]) -> Iterator[tuple[np.ndarray, ...]]:
    """All texts as chains, ``FIT_TOKENS`` tokens or one text at a time: chain
    sizes, (token, feature) pairs, and the tokens labelled 1.  Tokens without a
    marked feature, nearly all, take no memory."""
    known: dict[bytes, tuple[int, ...]] = {}
    at, sizes, i, c, offending = 0, [], [], [], []
    for k, text in enumerate(texts):
        d = words(text)
        if not d:
            continue
        for n, word in enumerate(d, at):
            if (own := known.get(word)) is None:
                own = known[word] = tuple(index[f] for f in features(word) if f in index)
            if own:
                i += [n] * len(own)
                c += own
                if toxic[k]:
                    offending.append(n)
        at += len(d)
        sizes.append(len(d))
        if at >= FIT_TOKENS:
            yield tuple(np.array(x, int) for x in (sizes, i, c, offending))
            known.clear()
            at, sizes, i, c, offending = 0, [], [], [], []
    if sizes:
        yield tuple(np.array(x, int) for x in (sizes, i, c, offending))


def _gradient(sizes: np.ndarray, i: np.ndarray, c: np.ndarray, offending: np.ndarray,
              w: np.ndarray, bias: float, trans: np.ndarray) -> tuple[np.ndarray, float, np.ndarray]:
    """Observed less expected counts of features, of state 1 and of state pairs."""
    tokens = int(sizes.sum())
    y = np.zeros(tokens)
    y[offending] = 1
    inside = np.ones(tokens, bool)
    inside[np.cumsum(sizes) - sizes] = False
    inside = np.flatnonzero(inside)  # tokens with one before them in their chain
    pairs = np.bincount((2 * y[inside - 1] + y[inside]).astype(int), minlength=4).reshape(2, 2).astype(float)
    e = bias + np.bincount(i, w[c], tokens)
    ahead, back = _both_ways(e, sizes, trans)
    miss = y - _sigmoid(ahead + back - e)
    # the pair (i - 1, i) in states (p, q) weighs exp(p ahead + trans[p, q] + q back)
    x, z = ahead[inside - 1], back[inside]
    cells = np.stack([np.full(len(x), trans[0, 0]), trans[0, 1] + z, x + trans[1, 0], x + trans[1, 1] + z])
    cells = np.exp(cells - cells.max(0))
    return np.bincount(c, miss[i], len(w)), miss.sum(), pairs - (cells / cells.sum(0)).sum(1).reshape(2, 2)


def fit(texts: list[bytes], labels: list[int], rounds: int = 50) -> SpanModel:
    """Fit the chain and the document curve to all of the labelled texts.

    Without a toxic or without a clean text there is nothing to tell apart: the
    model then scores every document by the share of toxic ones.
    """
    toxic = np.array(labels, bool)
    if toxic.all() or not toxic.any():
        share = (toxic.sum() + 0.5) / (len(toxic) + 1)
        return SpanModel({}, -4.0, np.zeros((2, 2)), (float(np.log(share / (1 - share))), 0.0, 0.0))
    marks = _offending(texts, toxic)
    index = {f: k for k, f in enumerate(sorted(marks))}
    chains = list(_labelled_chains(texts, toxic, index))
    tokens = sum(int(sizes.sum()) for sizes, *_ in chains)
    # the bias starts at the share of offending tokens, so that long texts do not add up to some
    rare = (sum(len(offending) for *_, offending in chains) + 0.5) / (tokens + 1)
    w, bias, trans = np.zeros(len(index)), float(np.log(rare / (1 - rare))), np.zeros((2, 2))
    first, second = ([np.zeros(len(index) + 1), np.zeros((2, 2))] for _ in range(2))
    for step in range(1, rounds + 1):
        by_feature, by_bias, pairs = np.zeros(len(index)), 0.0, np.zeros((2, 2))
        for sizes, i, c, offending in chains:
            part = _gradient(sizes, i, c, offending, w, bias, trans)
            by_feature, by_bias, pairs = by_feature + part[0], by_bias + part[1], pairs + part[2]
        grad = np.append(by_feature - 0.05 * w, by_bias / (tokens / 1000))
        grad_t = (pairs - 0.05 * trans) / (tokens / 1000)
        moved = []
        for k, g in enumerate((grad, grad_t)):  # Adam ascent
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            moved.append(0.25 * first[k] / (1 - 0.9 ** step) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-8))
        w, bias, trans = w + moved[0][:-1], float(bias + moved[0][-1]), trans + moved[1]
    model = SpanModel({f: float(w[k]) for f, k in index.items() if w[k]}, bias, trans)
    model.curve = _fit_curve(model, texts, toxic)
    return model


def _fit_curve(model: SpanModel, texts: list[bytes], toxic: np.ndarray) -> tuple[float, float, float]:
    rows = []
    for a in range(0, len(texts), 256):
        for o in model.marginals([words(t) for t in texts[a:a + 256]]):
            rows.append((1.0, np.log1p(_sigmoid(o).sum()) if len(o) else 0.0, np.clip(o.max() if len(o) else -99, *STRONGEST)))
        model._known.clear()  # the driver keeps no words; the tasks fill their own
    x = np.array(rows)
    y, c = toxic.astype(float), np.zeros(3)
    for _ in range(60):  # Newton steps with a ridge
        p = _sigmoid(x @ c)
        h = (x * (p * (1 - p))[:, None]).T @ x + 0.02 * np.eye(3)
        c = c + np.clip(np.linalg.solve(h, x.T @ (y - p) - 0.02 * c), -2, 2)
    return tuple(map(float, c))


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from learning: crc32 of the id as text, mod 5, is 0."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", max_toxic: int = MAX_TOXIC, max_clean: int = MAX_CLEAN) -> SpanModel:
    """Fit a model to at most ``max_toxic`` and ``max_clean`` labelled rows of each label.

    The rows are those of least id hash outside the held-out fold.  Labels other
    than 0 and 1, and ids without a text, are not learned from; of a repeated id
    any one row is as good.
    """
    known = (labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y"))
             .where("doc_id is not null and y in (0, 1)").groupBy("doc_id").agg(F.max("y").alias("y"))
             .where(~held_out(F.col("doc_id"))))
    order = F.xxhash64("doc_id")
    picked = known.where("y = 1").orderBy(order, "doc_id").limit(max_toxic).unionByName(
        known.where("y = 0").orderBy(order, "doc_id").limit(max_clean))
    # at most max_toxic + max_clean narrow rows are broadcast; the texts of those rows come to the driver
    rows = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
            .join(F.broadcast(picked), "doc_id").toArrow().sort_by("doc_id"))
    seen, texts, ys = set(), [], []
    for d, t, y in zip(*(rows.column(c).to_pylist() for c in ("doc_id", "text", "y"))):
        if d not in seen:
            seen.add(d)
            texts.append(t or b"")
            ys.append(y)
    del rows
    model = fit(texts, ys)
    del texts
    tidy(docs.sparkSession)
    return model


def spans(model: SpanModel, text: bytes, odds: np.ndarray) -> list[tuple[int, int]]:
    """Byte offsets (start, end) of runs of tokens more likely toxic than not."""
    out: list[tuple[int, int]] = []
    last = -2
    for k, m in enumerate(_WORD.finditer(text.lower())):
        if odds[k] > 0:
            if last == k - 1:
                out[-1] = (out[-1][0], m.end())
            else:
                out.append(m.span())
            last = k
    return out


def tag_documents(docs: DataFrame, model: SpanModel, id_col: str = "doc_id", text_col: str = "text",
                  with_spans: bool = True) -> DataFrame:
    """doc_id, score, predicted [, spans array<struct<start, end>> in bytes].

    One row per input row, repeated rows included.  A null or empty text has no
    spans and the curve's score for no token.  Texts of any length are tagged
    whole.  Other columns are ignored; an empty table gives no rows.
    """
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = "doc_id long, score double, predicted int" + (", spans array<struct<start: int, end: int>>" if with_spans else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            texts = [x.as_py() or b"" for x in batch.column(1)]
            odds = m.marginals([words(t) for t in texts])
            scores = [m.score(o) for o in odds]
            out = {"doc_id": batch.column(0), "score": pa.array(scores, pa.float64()),
                   "predicted": pa.array([int(s >= 0.5) for s in scores], pa.int32())}
            if with_spans:
                found = [[{"start": a, "end": b} for a, b in spans(m, t, o)] for t, o in zip(texts, odds)]
                out["spans"] = pa.array(found, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))
            yield pa.RecordBatch.from_pydict(out)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, kind)


def keep_clean(docs: DataFrame, model: SpanModel, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores below 0.5."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            odds = m.marginals([words((x.as_py() or "").encode()) for x in batch.column(at)])
            yield batch.filter(pa.array([m.score(o) < 0.5 for o in odds], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
