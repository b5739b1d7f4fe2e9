"""Operator 12 against a plain version that encodes each text whole."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pkgsift.llm import alignment as al

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def plain(rows):
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) per row."""
    aligner = al.Aligner(A, B)
    found, count = [], Counter()
    for doc_id, text in rows:
        groups = []
        if text:
            full = " " + text
            a = aligner.a.encode(full, add_special_tokens=False).ids
            b = aligner.b.encode(text)
            ends, at = defaultdict(set), {}
            for name, ids, table in (("a", a, aligner.bytes_a), ("b", b, aligner.bytes_b)):
                n = 0
                at[name] = []
                for i in ids:
                    n += len(table[i])
                    ends[name].add(n)
                    at[name].append((i, n))
            same = all(b"".join(t[i] for i in ids) == full.encode() for ids, t in ((a, aligner.bytes_a), (b, aligner.bytes_b)))
            if same:
                low = 0
                for cut in sorted(ends["a"] & ends["b"]):
                    groups.append([[i for i, n in at[name] if low < n <= cut] for name in "ab"])
                    low = cut
        links = Counter((x, y) for own in groups for x in own[0] for y in own[1])
        count.update(links.keys())
        found.append((doc_id, groups, links))
    best = {}
    for (x, _), n in count.items():
        best[x] = max(best.get(x, 0), n)
    out = []
    for doc_id, groups, links in found:
        shown = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        out.append((doc_id, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), sum(links.values()),
                    sum(n for p, n in links.items() if count[p] == best[p[0]]), sum(n * count[p] for p, n in links.items()),
                    hashlib.sha256(shown.encode()).hexdigest() if groups else ""))
    return sorted(out, key=str)


HOSTILE = [None, "", " ", "  ", "\n", "a ", " a", "foo bar", "foo  bar", "foo\n\nbar", "\tx\r\n y", "a  b", "a b c", "x▁y", "　a", "日本語 テキスト",
           "naïve café", "👩‍👩‍👧 ok", "<|endoftext|> x <s> </s>", "<0x41>", "a" * 300, "!" * 77 + " " * 40 + "z", "it's we'll I'D", "é ﬁ ①", "0 1 22 333 4444", "\x00\x01 a", "foo bar"]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_hostile_texts(spark):
    rows = [(k, t) for k, t in enumerate(HOSTILE)] + [(3, "foo bar"), (None, "foo bar"), (7, "foo bar")]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, seg string").repartition(3)
    assert rows_of(al.align_documents(df, A, B)) == plain(rows)


def test_query_against_plain(spark):
    from pkgsift.llm.queries import op12_alignment

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    assert rows_of(op12_alignment(spark, "/root/testdata/sf0.001")) == plain([tuple(r) for r in docs])


def test_many_segments_and_cleared_pieces(spark, monkeypatch):
    monkeypatch.setattr(al, "KEPT_PIECES", 50)
    monkeypatch.setattr(al, "TOGETHER", 40)
    monkeypatch.setattr(al, "SLAB", 16)
    words = "the of, thing sher <|x|> ndion éclair Straße 12 a\nb"
    texts = [" ".join(words.split(" ")[k % 5:]) * (k % 4 + 1) for k in range(30)]
    known = al.Known(al.Aligner(A, B))
    got = [d.result()[:2] for d in known.documents(texts)]
    want = {r[0]: r for r in plain(list(enumerate(texts)))}
    assert [(c, g) for c, g in got] == [(list(want[k][1:5]), want[k][7]) for k in range(30)]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert al.align_documents(df, A, B).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=" \n\t\r'.,aeinorstABé日  ▁<|>0123", max_size=60))
def test_cuts_change_nothing(text):
    aligner = aligner_of()
    if not text:
        return
    whole = (aligner.a.encode(" " + text, add_special_tokens=False).ids, aligner.b.encode(text))
    parts = [aligner.encode(s) for s in aligner.slabs(" " + text)]
    assert [[i for slab in parts for p in slab for i in p[k]] for k in (0, 1)] == [whole[0], whole[1]]


def aligner_of():
    return al.known(A, B).aligner


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(0, 8191), st.integers(1, 9)), min_size=1, max_size=50, unique_by=lambda x: x[0]), min_size=1, max_size=8), st.booleans())
def test_bitmaps_round_trip(runs, dense):
    runs = [sorted(r) for r in runs]
    if dense:
        runs[0] = [(k, 1 + k % 3) for k in range(0, 8192, 2)]
    ordinals = np.array([o for r in runs for o, _ in r])
    many = np.array([m for r in runs for _, m in r])
    starts = np.cumsum([0, *(len(r) for r in runs[:-1])])
    bitmaps = al.planes(ordinals, many, starts)
    for r, own in zip(runs, bitmaps):
        assert all(len(x) <= 1024 for x in own)
        got: dict[int, int] = {}
        for digit, x in enumerate(own):
            found, owner = al.unpack(np.frombuffer(x, np.uint8), np.array([len(x)]), al.SEGMENT_BITS)
            assert not owner.any()
            for o in found.tolist():
                got[o] = got.get(o, 0) + (1 << digit)
        assert sorted(got.items()) == r  # the OR of the planes is the documents, their digits the links
    flat = [x for own in bitmaps for x in own]
    found, owner = al.unpack(np.frombuffer(b"".join(flat), np.uint8), np.cumsum([len(x) for x in flat]), al.SEGMENT_BITS)
    assert len(found) == sum(bin(m).count("1") for m in many.tolist())
    assert len(set(zip(found.tolist(), owner.tolist()))) == len(found)


@pytest.fixture(scope="module", autouse=True)
def _fresh():
    yield
    al.known.cache_clear()


def test_joined_and_single_pieces_agree():
    """Pieces aligned as one text give what each gives by itself."""
    texts = [" ".join(HOSTILE[k] or "" for k in (7, 8, 9, 18, 20, 22, 24, k)) for k in range(12, 25)]
    one, many = al.Known(al.Aligner(A, B)), al.Known(al.Aligner(A, B))
    one._add_joined = lambda pieces: False
    for x, y in zip(one.documents(texts), many.documents(texts)):
        (c1, g1, k1, m1), (c2, g2, k2, m2) = x.result(), y.result()
        assert (c1, g1, k1.tolist(), m1.tolist()) == (c2, g2, k2.tolist(), m2.tolist())
