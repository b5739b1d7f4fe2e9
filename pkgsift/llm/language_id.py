"""Language identification by string kernels (operator 13).

The blended-spectrum presence kernel of two texts counts the byte n-grams, of
one to ``order`` bytes, that stand in both, over the root of their own counts.
Nyström landmarks are whole training texts; a text's kernel values against them,
whitened by the landmarks' own kernel, are its features, and one-versus-rest
ridge regression on these features is kernel ridge regression on the landmarks'
span.  Presence marks, kernel values and class values of a batch of texts are
three matrix products.

Texts are read as runs of letters and marks in lower case, in UTF-8, with one
space before, between and after them.  The gram vocabulary is a tree whose
tables lead from a gram and the next byte to the longer gram, so a batch of
whole texts is scanned once per gram length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pkgsift.llm.common import bounded_batches, table

#: Longest grams, in bytes.
ORDER = 4
#: Training texts that serve as landmarks, shared evenly among the languages.
LANDMARKS = 256
#: Labelled texts that the regression is fitted to, shared evenly among the languages.
SAMPLE = 6_000
#: Most grams of the kernel, those in most landmarks first.
GRAMS = 1 << 14
#: Most languages learned, those with most labelled texts first.
LANGUAGES = 200
#: Strengths of the ridge that cross-validation inside the sample chooses from.
RIDGES = (1e-4, 1e-3, 1e-2, 1e-1, 1.0)
#: Texts whose marks are one matrix, and bytes scanned at a time.
ROWS, SLICE = 256, 1 << 21

UNDETERMINED = "und"


@dataclass
class Model:
    """``steps[n]`` leads from gram and byte to the longer gram, numbered from 1;
    ``columns[n]`` has the gram's column among the marks (0: none).
    ``landmarks`` are the marks of the landmarks, ``weights`` what a text's kernel
    values are multiplied with; ``ridge`` and ``accuracy`` come from the folds."""

    languages: list[str]
    steps: list[np.ndarray]
    columns: list[np.ndarray]
    landmarks: np.ndarray
    weights: np.ndarray
    ridge: float = 0.0
    accuracy: float = 0.0


def held_out(doc_id: Column) -> Column:
    """True for rows that are kept from learning; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def letters(text: Column) -> Column:
    """Lower-case runs of letters and marks, with single spaces around them."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{M}]++", " ")), F.lit(" "))


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def gram_tree(texts: list[bytes], order: int, most: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Tables of the grams in ``texts``: a gram stays if it is among the ``most`` that
    stand in most texts (ties: shorter, then lower bytes), or begins one that does."""
    found: dict[bytes, int] = {}
    for t in texts:
        for n in range(1, order + 1):
            for g in {t[k:k + n] for k in range(len(t) - n + 1)}:
                found[g] = found.get(g, 0) + 1
    chosen = sorted(found, key=lambda g: (-found[g], len(g), g))[:most]
    column = {g: k for k, g in enumerate(chosen, 1)}
    steps, columns, numbers = [], [], {b"": 0}
    for n in range(1, order + 1):
        wanted = sorted({g[:n] for g in chosen if len(g) >= n})
        step = np.zeros((len(numbers) if n > 1 else 1, 256), np.int32)
        now = {g: k for k, g in enumerate(wanted, 1)}
        for g, k in now.items():
            step[numbers[g[:-1]], g[-1]] = k
        steps.append(step)
        columns.append(np.array([0, *(column.get(g, 0) for g in wanted)], np.int32))
        numbers = {b"": 0} | now
    return steps, columns


def presence(data: np.ndarray, ends: np.ndarray, steps: list[np.ndarray], columns: list[np.ndarray], width: int) -> np.ndarray:
    """0/1 marks, one row per text: ``data`` holds the texts one after the other
    up to ``ends``.  No gram reaches over two texts, as two spaces stand there."""
    marks = np.zeros((len(ends), width + 1), np.float32)
    order = len(steps)
    for at in range(0, len(data), SLICE):
        part = data[at:at + SLICE + order - 1]
        own = min(SLICE, len(data) - at)
        row = np.repeat(np.arange(len(ends), dtype=np.int32), np.diff(np.clip(ends, at, at + own), prepend=at))
        gram = np.zeros(len(part), np.int32)
        for n, (step, column) in enumerate(zip(steps, columns)):
            gram = step[gram[:len(part) - n], part[n:]]
            marks[row[:len(gram[:own])], column[gram[:own]]] = 1
    return marks[:, 1:]


def kernel(marks: np.ndarray, landmarks: np.ndarray) -> np.ndarray:
    """Shared grams over the root of both texts' own counts; 0 for a text without grams."""
    size = marks.sum(axis=1, dtype=np.float64), landmarks.sum(axis=1, dtype=np.float64)
    return (marks @ landmarks.astype(np.float32, copy=False).T).astype(np.float64) / np.sqrt(np.maximum(np.outer(*size), 1))


def _flat(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum([len(t) for t in texts])


def _batches(column: pa.Array, rows: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for k in range(0, len(column), rows):
        yield _flat(column.slice(k, rows).to_pylist())


def _share(texts: DataFrame, each: int) -> DataFrame:
    """At most ``each`` texts of every language, those of least hash (a partial limit runs before the shuffle)."""
    own = Window.partitionBy("lang").orderBy("h", "text")
    return (texts.withColumn("h", F.xxhash64("text")).withColumn("k", F.row_number().over(own)).where(F.col("k") <= each))


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", order: int = ORDER,
          landmarks: int = LANDMARKS, sample: int = SAMPLE, grams: int = GRAMS, languages: int = LANGUAGES) -> Model:
    """Learn from rows outside ``held_out`` with a language and a letter.

    Landmarks and sample are bounded numbers of whole texts, shared evenly among the languages
    (the landmarks are the first of the sample, at least one each).  Without such
    rows the model knows no language and every text is undetermined.
    """
    spark = docs.sparkSession
    usable = (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("raw"), F.col(lang_col).cast("string").alias("lang"))
              .where(F.col("id").isNotNull() & ~held_out(F.col("id")) & F.col("lang").isNotNull() & has_letter(F.col("raw"))))
    counted = usable.groupBy("lang").agg(F.approx_count_distinct(F.xxhash64("raw")).alias("n")).orderBy(F.desc("n"), "lang").limit(languages).collect()
    names = sorted(r["lang"] for r in counted)
    if not names:
        return Model([], [], [], np.zeros((0, 0), np.float32), np.zeros((0, 0)))
    each = max(2, sample // len(names))
    # enough texts of every language by hash, so that only these are ever sorted or moved; copies count once
    share = F.create_map(*[F.lit(x) for r in counted for x in (r["lang"], min(1.0, 2 * each / r["n"] + 20 / r["n"]))])
    low = (F.pmod(F.xxhash64("raw", F.lit(13)), F.lit(1 << 30)) / F.lit(float(1 << 30))) < share[F.col("lang")]
    texts = usable.where(F.col("lang").isin(names) & low).select("lang", letters(F.col("raw")).cast("binary").alias("text")).distinct()
    taken = table(_share(texts, each), "languages")
    first = max(1, landmarks // len(names))
    base = [bytes(r["text"]) for r in taken.where(F.col("k") <= first).orderBy("lang", "k").collect()]
    steps, columns = gram_tree(base, order, grams)
    width = min(grams, max(int(c.max()) for c in columns))
    marks = presence(*_flat(base), steps, columns, width)
    model = Model(names, steps, columns, marks.astype(np.uint8), np.zeros((len(base), len(names))))
    rows = _values(taken.select("lang", "text"), model, "lang string").collect()
    x = np.array([r["values"] for r in rows])
    y = np.array([names.index(r["lang"]) for r in rows])
    own = kernel(marks, marks)
    value, vector = np.linalg.eigh(own)
    good = value > 1e-8 * value[-1]
    white = vector[:, good] / np.sqrt(value[good])
    model.weights, model.ridge, model.accuracy = _ridge(x @ white, y, white, len(names))
    return model


def _ridge(z: np.ndarray, y: np.ndarray, white: np.ndarray, classes: int) -> tuple[np.ndarray, float, float]:
    """One-versus-rest ridge regression; its strength has the best accuracy over four folds."""
    target = np.eye(classes)[y]

    def solve(a: np.ndarray, b: np.ndarray, ridge: float) -> np.ndarray:
        return np.linalg.solve(a.T @ a + ridge * len(a) / z.shape[1] * np.eye(z.shape[1]), a.T @ b)

    fold = np.arange(len(y)) % 4
    best = (-1.0, 0.0)
    for ridge in RIDGES if len(y) >= 8 else RIDGES[2:3]:
        hits = [np.mean((z[fold == f] @ solve(z[fold != f], target[fold != f], ridge)).argmax(1) == y[fold == f])
                for f in range(4) if (fold == f).any() and (fold != f).any()]
        best = max(best, (float(np.mean(hits)) if hits else 0.0, ridge))
    return white @ solve(z, target, best[1]), best[1], best[0]


def _values(rows: DataFrame, model: Model, kept: str) -> DataFrame:
    """The kernel values of each text against the landmarks, with one column kept."""
    name = kept.split()[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [kernel(presence(*part, model.steps, model.columns, model.landmarks.shape[1]), model.landmarks)
                     for part in _batches(batch.column(1), ROWS)]
            values = np.concatenate(found) if found else np.zeros((0, len(model.landmarks)))
            yield pa.RecordBatch.from_pydict({name: batch.column(0), "values": pa.array(list(values), pa.list_(pa.float64()))})

    return rows.mapInArrow(run, f"{kept}, values array<double>")


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score for every row, repeated rows included.

    The score is the best class value over the sum of all positive ones, 0 to 1.
    A null or empty text and one without a letter is ``und`` with score 0; so is
    every text if the model knows no language.  Equal values go to the first
    language by name; a text without known grams goes to the first one with
    score 0.  Whole texts of any length are read, a bounded slice at a time.  An empty table
    gives no rows; other columns are ignored.
    """
    bounded_batches(docs.sparkSession)
    raw = F.col(text_col).cast("string")
    text = F.when(has_letter(raw), letters(raw)).cast("binary")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        landmarks = m.landmarks.astype(np.float32)
        for batch in batches:
            names, scores = [], []
            for k in range(0, batch.num_rows, ROWS):
                texts = batch.column(1).slice(k, ROWS).to_pylist()
                if m.languages:
                    marks = presence(*_flat([t or b"" for t in texts]), m.steps, m.columns, m.landmarks.shape[1])
                    values = np.maximum(kernel(marks, landmarks) @ m.weights, 0)
                    best = values.argmax(axis=1)
                    score = values[np.arange(len(texts)), best] / np.maximum(values.sum(axis=1), 1e-12)
                for j, t in enumerate(texts):
                    known = t is not None and bool(m.languages)
                    names.append(m.languages[best[j]] if known else UNDETERMINED)
                    scores.append(min(1.0, float(score[j])) if known else 0.0)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "lang_pred": pa.array(names, pa.string()), "score": pa.array(scores, pa.float64())})

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text")).mapInArrow(run, "doc_id long, lang_pred string, score double")
