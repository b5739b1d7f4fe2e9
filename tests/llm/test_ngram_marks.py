"""Operator 1: the marking bits are as many as the repeated tokens need."""

import numpy as np

from pkgsift.llm import ngram_join as nj


def test_few_repeated_tokens_take_few_bits(spark):
    words = [f"w{k}" for k in range(400)]
    texts = [" ".join(words[k:k + 40]) for k in range(0, 360, 20)] + ["alone " * 3 + " ".join(f"x{k}" for k in range(50))]
    docs = spark.createDataFrame([(t.encode(),) for t in texts], "text binary")
    order = nj.token_order(docs, 5, 2000)
    assert len(order.marks) << 3 == 1 << order.bits == 1 << nj.RUN_BITS
    assert order.bar == 2
    sets = nj.shingle_sets([t.encode() for t in texts], 5)
    keys, counts = np.unique(np.concatenate(sets), return_counts=True)
    ranks = order.ranks(keys)
    assert (ranks[counts > 1] > 0).all() and (ranks[counts == 1] > 0).mean() < 0.1


def test_bits_grow_with_repeated_tokens(spark, monkeypatch):
    monkeypatch.setattr(nj, "RUN_BITS", 6)
    words = [f"w{k}" for k in range(3000)]
    docs = spark.createDataFrame([(" ".join(words[k:k + 1500]).encode(),) for k in (0, 0, 1500, 1500)], "text binary")
    order = nj.token_order(docs, 5, 6000)
    assert order.bits == 18 and len(order.marks) << 3 == 1 << 18  # 64 bits for each of 2992 tokens
