"""Operator 13: kernel values against a plain version, and held-out accuracy."""

import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pkgsift.llm import language_id as li

SF = "/root/testdata/sf0.01"


def grams(text: bytes, order: int) -> set[bytes]:
    return {text[k:k + n] for n in range(1, order + 1) for k in range(len(text) - n + 1)}


@pytest.mark.parametrize("order,slice_", [(1, 1 << 20), (3, 7), (4, 5)])
def test_kernel_is_shared_grams(order, slice_, monkeypatch):
    monkeypatch.setattr(li, "SLICE", slice_)
    base = [" der hund ".encode(), " the dog the ".encode(), " été ".encode(), " 日本 ".encode()]
    texts = [*base, b"", " the hund é ".encode(), " x ".encode(), " 日 the der ".encode()]
    steps, columns = li.gram_tree(base, order, 10_000)
    width = int(max(c.max() for c in columns))
    vocabulary = set().union(*(grams(t, order) for t in base))
    assert width == len(vocabulary)
    flat = li._flat(texts)
    marks = li.presence(*flat, steps, columns, width)
    own = li.presence(*li._flat(base), steps, columns, width)
    got = li.kernel(marks, own)
    for i, t in enumerate(texts):
        known = grams(t, order) & vocabulary
        assert marks[i].sum() == len(known)
        for j, b in enumerate(base):
            other = grams(b, order)
            assert got[i, j] == pytest.approx(len(known & other) / math.sqrt(max(1, len(known) * len(other))))


def test_gram_limit_keeps_the_most_common():
    base = [b" ab ", b" ac ", b" ad "]
    steps, columns = li.gram_tree(base, 2, 4)
    marks = li.presence(*li._flat([b" a ", b" d "]), steps, columns, 4)
    # in all three texts: space, a and space-a; then the first of the rest in length and bytes
    assert marks.sum(axis=1).tolist() == [3.0, 1.0]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = li.learn(docs)
    found = li.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in found if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert len(held) > 200
    assert np.mean([r["lang_pred"] == r["lang"] for r in held]) >= 0.98
    assert all(0 <= r["score"] <= 1 for r in found)
    assert len(found) == docs.count()


def test_learns_from_its_rows_only(spark):
    """Languages, texts and ids outside the learning rows change no prediction."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(400)
    fold = li.held_out(F.col("doc_id"))
    other = docs.withColumn("lang", F.when(fold, F.lit("xx")).otherwise(F.col("lang"))).withColumn("text", F.when(fold, F.lit("zzz qqq")).otherwise(F.col("text")))
    probe = docs.select(F.col("doc_id"), "text")
    a, b = (sorted(map(tuple, li.predict(probe, li.learn(d)).collect())) for d in (docs, other))
    assert a == b


def test_query_folds(spark):
    from pkgsift.llm.queries import op13_language_id

    rows = op13_language_id(spark, "/root/testdata/sf0.001").collect()
    assert {r["doc_id"]: r["held_out"] for r in rows} == {r["doc_id"]: zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in rows}


def test_awkward_rows(spark):
    learn = [(i, t, c, "src") for i, (t, c) in enumerate([("der hund und die katze", "de"), ("the dog and the cat", "en"), ("", "en"), (None, "de"), ("12 !!", "xx"), ("le chat", None)] * 6)]
    schema = "doc_id long, text string, lang string, source string"
    docs = spark.createDataFrame(learn + [(None, "nur ohne nummer", "zz", "s")], schema)
    model = li.learn(docs)
    assert sorted(model.languages) == ["de", "en"]  # texts without a letter and rows without an id teach nothing
    long = "the cat " * 200_000
    rows = [(1, None), (2, ""), (3, "123 — !"), (4, "die hunde"), (4, "die hunde"), (5, "the cat"), (None, "the dog"), (6, long), (7, "日本")]
    got = [tuple(r) for r in li.predict(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()]
    assert [r[1] for r in got][:9] == ["und", "und", "und", "de", "de", "en", "en", "en", got[8][1]]
    assert [r[2] for r in got][:3] == [0.0, 0.0, 0.0] and got[8][1] in ("de", "en")
    empty = spark.createDataFrame([], schema)
    nothing = li.learn(empty)
    assert nothing.languages == [] and li.predict(empty, model).collect() == []
    assert [tuple(r)[1:] for r in li.predict(docs.limit(3), nothing).collect()] == [("und", 0.0)] * 3


def test_copies_do_not_fill_the_sample(spark):
    """One text repeated counts once, so the other texts of its language are learned."""
    rows = [(i, "la la la la", "fr", "s") for i in range(3000)] + [(3000 + i, f"le chat numéro {chr(97 + i % 26)}{chr(97 + i // 26)} est ici", "fr", "s") for i in range(60)]
    rows += [(4000 + i, f"the cat number {chr(97 + i % 26)} is here", "en", "s") for i in range(26)]
    model = li.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), sample=40, landmarks=10)
    probe = spark.createDataFrame([(1, "le chat est ici"), (2, "the cat is here")], "doc_id long, text string")
    assert [r["lang_pred"] for r in li.predict(probe, model).orderBy("doc_id").collect()] == ["fr", "en"]
