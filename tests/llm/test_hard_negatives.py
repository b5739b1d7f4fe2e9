"""Operator 11 against a plain version that scores every pair."""

import itertools
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pkgsift.llm import hard_negatives as hn

SCHEMA = "id long, label long, v array<long>, block string"


def plain(rows, is_anchor, positives=5, negatives=10):
    rows = sorted({(i, c, tuple(v)) for i, c, v in rows if i is not None and c is not None and v is not None and None not in v})
    out = []
    for i, c, v in rows:
        if not is_anchor(i):
            continue
        near = sorted((-sum(map(int.__mul__, v, x)), j) for j, d, x in rows if d == c and j != i and len(x) == len(v))[:positives]
        far = sorted((-sum(map(int.__mul__, v, x)), j) for j, d, x in rows if d != c and len(x) == len(v))
        for p, j in near:
            own = [(s, k) for s, k in far if 30 * -p <= 100 * -s <= 90 * -p][:negatives]
            out += [(i, j, r, k, -p, -s) for r, (s, k) in enumerate(own, 1)]
    return sorted(out)


def mined(spark, rows, mod=10, parts=4, **sizes):
    df = spark.createDataFrame([(i, c, list(v) if v is not None else None, "x") for i, c, v in rows], SCHEMA).repartition(parts)
    return sorted(tuple(r) for r in hn.mine(df, F.col("id") % mod == 0, **sizes).collect())


def clustered(n, dim, seed, labels=3, spread=40):
    rng = np.random.default_rng(seed)
    centres = rng.integers(-200, 200, (8, dim))
    return [(i, int(rng.integers(labels)), (centres[i % 8] + rng.integers(-spread, spread, dim)).tolist()) for i in range(n)]


@pytest.mark.parametrize("dim", [2, 16])
def test_against_every_pair(spark, dim, monkeypatch):
    monkeypatch.setattr(hn, "ZONES", 4)  # several groups of zones
    rows = clustered(600, dim, dim)
    assert mined(spark, rows, block=16, anchor_block=7) == plain(rows, lambda i: i % 10 == 0)


def test_hot_vector_ties_and_hot_label(spark):
    rows = [(i, 0 if i % 3 else i % 5, [3, 4]) for i in range(400)] + [(i, i % 4, [i % 7, 9 - i % 5]) for i in range(400, 600)]
    assert mined(spark, rows, block=32, anchor_block=8) == plain(rows, lambda i: i % 10 == 0)


def test_awkward_rows(spark):
    rows = [(0, 1, [5, 5]), (0, 1, [5, 5]), (0, 2, [5, 5]), (0, 1, [6, 1]), (1, 1, [4, 4]), (2, 2, [3, 3]), (3, 2, [-9, 1]), (4, None, [5, 5]),
            (None, 2, [2, 2]), (5, 2, None), (6, 2, [1, None]), (7, 2, [1, 2, 3]), (8, 1, []), (10, 1, []), (11, 2, []), (12, 1, [0, 0]), (20, 3, [2, 2]),
            (30, 1, [1 << 40, 7]), (31, 2, [1 << 20, -1]), (40, 4, [-1, -1])]
    assert mined(spark, rows, block=3, anchor_block=2) == plain(rows, lambda i: i % 10 == 0)
    assert mined(spark, [], block=3) == []
    assert mined(spark, [(1, 1, [2, 3]), (2, 2, [2, 3])]) == []  # no anchor


def test_few_blocks_are_read_for_clustered_data(spark, monkeypatch):
    """Zones rule out most blocks where the data are clustered, in both passes."""
    rng = random.Random(3)
    rows = [(i, i % 2, [rng.randint(0, 9) + 1000 * (i % 16 == 2 * k or i % 16 == 2 * k + 1) for k in range(8)]) for i in range(1600)]
    chosen = []
    real = hn._choose
    monkeypatch.setattr(hn, "_choose", lambda *a: chosen.append(real(*a)) or chosen[-1])
    assert mined(spark, rows, mod=100, block=20, anchor_block=1) == plain(rows, lambda i: i % 100 == 0)
    read = sum(df.count() for df in chosen)
    assert read < 16 * 80 / 2, read  # 16 anchors, 80 blocks and more


def test_query_against_plain(spark):
    from pkgsift.llm.queries import op11_hard_negatives

    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()
    rows = [(r["vec_id"], (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"], [math.floor(256 * x) for x in r["embedding"]])
            for r in table if r["embedding"] is not None and r["label"] is not None and all(x is not None and math.isfinite(x) for x in r["embedding"])]
    got = op11_hard_negatives(spark, "/root/testdata/sf0.001").select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    assert sorted(tuple(r) for r in got.collect()) == plain(rows, lambda i: i % 100 == 0)


def test_quantised_leaves_out_bad_rows(spark):
    rows = [(1, [0.5, -0.001], 3), (2, None, 3), (3, [1.0, None], 3), (4, [float("nan")], 3), (5, [float("inf")], 3), (6, [], 3), (7, [0.25], None)]
    got = hn.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()
    assert sorted(map(tuple, got)) == [(1, 3, [128, -1]), (6, 3, []), (7, None, [64])]


@pytest.mark.parametrize("dim,bits", [(2, 3), (3, 2), (4, 1)])
def test_curve_visits_neighbours(dim, bits):
    """Successive places differ by one step in one dimension, and none occurs twice."""
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dim)))
    keys = hn.hilbert_keys(cells, bits)
    assert len(set(keys)) == len(cells)
    along = cells[sorted(range(len(cells)), key=keys.__getitem__)]
    assert (np.abs(np.diff(along, axis=0)).sum(axis=1) == 1).all()


@settings(max_examples=50, deadline=None)
@given(st.integers(0, 10_000))
def test_bounds_hold(seed):
    rng = np.random.default_rng(seed)
    a, v = rng.integers(-300, 300, (4, 5)), rng.integers(-300, 300, (20, 5))
    least, most = hn.bounds(a, v.min(axis=0)[None], v.max(axis=0)[None])
    scores = a @ v.T
    assert (least[:, 0] <= scores.min(axis=1)).all() and (scores.max(axis=1) <= most[:, 0]).all()
    big = a * (1 << 44)
    assert (hn.products(big, v) == big @ v.T).all()
