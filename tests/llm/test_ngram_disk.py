"""Operator 1: what it writes between its steps follows from near copies, not from chance or exact copies."""

import importlib.util
from pathlib import Path

import pytest

import corpus_pipeline
from pkgsift.llm import ngram_join as nj

_spec = importlib.util.spec_from_file_location("_ngram_dense", Path(__file__).with_name("test_ngram_dense.py"))
dense = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(dense)


@pytest.fixture
def written(monkeypatch):
    """Rows of the tables written, by tag."""
    rows, real = {}, nj.table

    def counted(df, tag):
        found = real(df, tag)
        rows[tag] = rows.get(tag, 0) + found.count()
        return found

    monkeypatch.setattr(nj, "table", counted)
    return rows


def test_bar_stays_while_more_bits_hold_the_marks(spark, monkeypatch):
    for name, value in (("RUN_BITS", 6), ("MARK_BITS", 12), ("MOST_BITS", 14)):
        monkeypatch.setattr(nj, name, value, raising=False)
    words = [f"w{k}" for k in range(3000)]
    docs = spark.createDataFrame([(" ".join(words[k:k + 1500]).encode(),) for k in (0, 0, 1500, 1500)], "text binary")
    order = nj.token_order(docs, 5, 6000)
    assert order.bar == 2 and order.bits == 13  # 2992 marked tokens are too many for 2 ** 12 bits


def couples():
    """Couples of near copies that share a passage with another couple."""
    texts = []
    for k in range(30):
        words = [f"c{k}w{j}" for j in range(100)]
        words[50:56] = [f"p{k // 2}x{j}" for j in range(6)]
        texts += [" ".join(words), " ".join(words[:-1] + ["end"])]
    return texts


def test_chance_meetings_write_no_differences(spark, written):
    got, (want, links) = dense.joined(spark, couples())
    assert got == want and links == 30
    assert written["differences"] == 0


def test_chance_meetings_in_the_pipeline(spark, written):
    docs = spark.createDataFrame([(k, t, "en") for k, t in enumerate(couples())], "doc_id long, text string, lang string")
    left = corpus_pipeline.near_duplicates(spark, docs, "")
    assert sorted(r["doc_id"] for r in left.collect()) == list(range(0, 60, 2))
    assert written["differences"] == 0


def test_exact_copies_post_nothing(spark, monkeypatch):
    posted, real = [], nj.postings

    def counted(*a):
        found = real(*a)
        posted.append(found.count())
        return found

    monkeypatch.setattr(nj, "postings", counted)
    texts = [" ".join(f"d{k}w{j}" for j in range(40 + k)) for k in range(40)] * 5
    got, (want, _) = dense.joined(spark, texts)
    assert got == want
    assert posted == [0]


def test_small_families(spark):
    """Groups small enough that all pairs are looked at."""
    texts = []
    for k in range(20):
        texts += dense.family(100 + k, 10, size=80, edits=(0, 4), lineages=2)
    got, (want, links) = dense.joined(spark, texts)
    assert got == want
    assert links > 20


def test_size_of_a_small_group_changes_no_result(spark, monkeypatch):
    monkeypatch.setattr(nj, "SMALL_GROUP", 4)
    texts = dense.family(31, 60, size=150, edits=(1, 6)) + dense.family(32, 12, size=60, edits=(0, 3))
    got, (want, links) = dense.joined(spark, texts)
    assert got == want and links > 20


def test_rows_of_one_id_and_negative_ids(spark):
    """The text that stands for a class is told by id and set."""
    base = [f"w{j}" for j in range(60)]
    near, far = " ".join(base[:-1] + ["end"]), " ".join(f"z{j}" for j in range(60))
    rows = [(-5, " ".join(base)), (-5, far), (-5, " ".join(base)), (3, near), (9, near), (9, far), (2 ** 62, far)]
    got = sorted(tuple(r) for r in nj.ngram_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect())
    assert got == [(-5, 56, -5)] * 3 + [(3, 56, -5)] + [(9, 56, -5)] * 2 + [(2 ** 62, 56, -5)]
