"""Operator 1 on dense families around the threshold, against every pair."""

import random

import pytest

from pkgsift.llm import ngram_join as nj


def sets_of(texts, n=5):
    out = []
    for t in texts:
        words = t.lower().split()
        out.append({tuple(words[k:k + n]) for k in range(len(words) - n + 1)} if len(words) >= n else {tuple(words)} if words else set())
    return out


def components(ids, texts, percent=80):
    """(doc_id, set size, smallest reachable id) by comparing all pairs."""
    sets = sets_of(texts)
    parent = {i: i for i in ids}

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    links = 0
    for a in range(len(ids)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                links += 1
                x, y = find(ids[a]), find(ids[b])
                parent[max(x, y)] = min(x, y)
    return sorted((i, len(s), find(i)) for i, s in zip(ids, sets)), links


def edited(rng, words, edits, pool):
    words = list(words)
    for _ in range(edits):
        k = rng.randrange(len(words))
        what = rng.random()
        if what < 0.6:
            words[k] = rng.choice(pool)
        elif what < 0.8:
            del words[k]
        else:
            words.insert(k, rng.choice(pool))
    return words


def family(seed, members, size=120, edits=(1, 9), lineages=3):
    """Copies of one text with edits of their own, and some with edits in common (lineages)."""
    rng = random.Random(seed)
    pool = [f"w{k}" for k in range(400)]
    base = [rng.choice(pool) for _ in range(size)]
    roots = [edited(rng, base, rng.randint(3, 8), pool) for _ in range(lineages)] + [base]
    out = []
    for _ in range(members):
        words = edited(rng, rng.choice(roots), rng.randint(*edits), pool)
        if rng.random() < 0.15:
            words = words[:rng.randint(size // 2, size)]
        out.append(" ".join(words))
    return out


def joined(spark, texts):
    rows = [(7 * k % 10_007, t) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted(tuple(r) for r in nj.ngram_components(df).collect())
    return got, components([i for i, _ in rows], texts)


@pytest.mark.parametrize("seed", range(4))
def test_dense_families(spark, seed):
    texts = family(seed, 130, size=300, edits=(1, 8)) + family(seed + 50, 60, size=150, edits=(0, 4), lineages=6)
    got, (want, links) = joined(spark, texts)
    assert got == want
    assert links > 20 and len({c for _, _, c in want}) > 20  # links and gaps, both


def test_candidates_of_a_family_below_the_threshold_grow_with_it(spark, monkeypatch):
    """Members with edits of their own that link to nothing make few candidates, not one for each pair."""
    counts = {}
    real = nj._across

    def counted(*a):
        found = real(*a)
        counts[n] = found.count()
        return found

    monkeypatch.setattr(nj, "_across", counted)
    for n in (60, 180):
        rng = random.Random(n)
        base = [f"b{k}" for k in range(200)]
        texts = [" ".join(base)]
        for m in range(n):
            words = list(base)
            for e in range(5 if m % 3 else 1):  # five edits: below 0.8 of the base; one: above
                words[rng.randrange(8, 192)] = f"m{m}e{e}"
            texts.append(" ".join(words))
        got, (want, _) = joined(spark, texts)
        assert got == want
    assert counts[180] <= 180 and counts[60] <= 60, counts


def test_marks_with_a_higher_bar(spark, monkeypatch):
    """Once the marks fill up, tokens in two texts are no longer told from single ones."""
    monkeypatch.setattr(nj, "BARS", (3, 4, 6, 8, 12, 16, 32, 64, 256, 1024))
    texts = family(9, 80, size=200, edits=(0, 5)) + ["a b c d e f g h", "a b c d e f g h", "x"] * 2
    got, (want, links) = joined(spark, texts)
    assert got == want and links > 20
