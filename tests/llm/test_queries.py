"""The registered queries' contracts, and the pipeline against a plain version of it."""
import hashlib
import os
import sys
from collections import Counter

import duckdb
import numpy as np
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

import __spark_entry__ as E  # noqa: E402
import corpus_pipeline as P  # noqa: E402
from oracle_check import TABLES, _rows  # noqa: E402
from test_operators import brute_components, jaccard_link, library, sets_of  # noqa: E402

SF = "/root/testdata/sf0.001"
KINDS = {
    "op1_ngram_join": "doc_id bigint, n_shingles bigint, component_id bigint",
    "op2_quality_rules": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean",
    "op3_license_scan": "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double",
    "op4_mixing": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    "op5_chat_format": "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint",
    "op6_bpe": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    "op7_warc": "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint",
    "op8_embedding_join": "vec_id bigint, n_links bigint, component_id bigint, kept boolean",
    "op9_token_files": "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
    "op10_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op11_hard_negatives": "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint",
    "op12_alignment": "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string",
    "op13_language_id": "doc_id bigint, held_out boolean, lang_pred string, score double",
}


@pytest.mark.parametrize("name", sorted(KINDS))
def test_query_columns_and_rows(spark, name):
    df = E.queries()[name](spark, SF)
    kinds = dict(df.dtypes)
    assert all(kinds[c] == k for c, k in (x.split(" ") for x in KINDS[name].split(", ")))
    table = {"op5_chat_format": "conversations", "op7_warc": "pages", "op8_embedding_join": "embeddings"}.get(name, "documents")
    rows = spark.read.parquet(f"{SF}/{table}.parquet")
    want = rows.select("conv_id").distinct().count() + 1 if table == "conversations" else rows.count()
    if name != "op11_hard_negatives":  # a row per negative, not per vector
        assert df.count() == want
    if name in E.oracle_sql():
        con = duckdb.connect()
        for t in TABLES:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
        res = con.execute(E.oracle_sql()[name])
        cols = [d[0] for d in res.description]
        assert sorted(cols) == sorted(df.columns)
        assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(cols, res.fetchall())


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n.split()[0] for n, _ in P.STAGES] == ["quality", "toxicity", "n-gram", "mixing", "BPE"]
    path, tok = library()
    for k, (_, stage) in enumerate(P.STAGES):
        out = stage(spark, docs, SF)
        before = docs.collect()
        if k == 4:
            break
        assert out.columns == docs.columns
        after = out.collect()
        kept = Counter(r["doc_id"] for r in after)
        texts = {r["doc_id"]: r["text"] for r in before}
        assert all(texts[r["doc_id"]] == r["text"] for r in after)
        if k == 0:
            from pkgsift.llm import quality_rules as Q
            rules = Q.learn(docs, spark.read.parquet(f"{SF}/labels.parquet"))
            assert set(kept) == {r["doc_id"] for r in Q.apply_rules(docs, rules).where("kept").collect()}
        elif k == 1:
            from pkgsift.llm import toxicity as T
            model = T.learn(docs, spark.read.parquet(f"{SF}/labels.parquet"))
            assert set(kept) == {r["doc_id"] for r in T.tag_documents(docs, model).where("predicted = 0").collect()}
        elif k == 2:
            ids = [r["doc_id"] for r in before]
            comp = brute_components(ids, sets_of([r["text"] for r in before]), jaccard_link)
            assert kept == Counter(sorted({comp[i] for i in range(len(ids))}))
        elif k == 3:
            from pkgsift.llm.mixing import mix_report
            want = {r["doc_id"]: r["taken"] // r["size"] for r in mix_report(docs).collect() if r["size"]}
            assert kept == Counter({d: n for d, n in want.items() if n})
        docs = spark.createDataFrame(after, docs.schema)
    want = []
    for r in before:
        ids = tok.encode(r["text"] or "", add_special_tokens=False).ids
        want.append((r["doc_id"], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted(map(tuple, out.collect())) == sorted(want)


def test_pipeline_run_and_awkward_documents(spark):
    assert P.run(spark, SF).count() > 0
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    words = " ".join(f"word{k}" for k in range(80))
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, words, "en", None, 1), (4, words, "en", "b", 1), (5, words + " more", "en", "b", 1),
            (6, "x " * 30_000, "en", "b", 1), (None, words, "en", "c", 1), (7, words[::-1], "de", "c", 1), (7, words[::-1], "de", "c", 1)]
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        empty = not docs.count()
        kept = sorted((r["doc_id"] or 0) for r in P.near_duplicates(spark, docs, SF).collect())
        assert kept == ([] if empty else [0, 1, 2, 3, 6, 7])
        for _, stage in P.STAGES:
            out = stage(spark, docs, SF)
            assert (out.count() == 0) if empty else out.count() >= 0


def test_near_duplicates_of_reused_ids(spark):
    """An id that names several texts loses only the texts that have a near copy."""
    a, b, c = (" ".join(f"{x}{k}" for k in range(80)) for x in ("red", "blue", "green"))
    rows = [(1, a), (7, a), (7, b), (8, c), (8, c + " more"), (9, b + " more"), (10, "a text of six own words"), (10, "a text of six own words"),
            (11, a[::-1]), (11, b[::-1]), (7, ""), (None, a)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    out = Counter((r["doc_id"], r["text"]) for r in P.near_duplicates(spark, docs, SF).collect())
    of8 = [t for i, t in out if i == 8]
    assert len(of8) == 1 and of8[0] in (c, c + " more")
    assert out == Counter([(1, a), (7, b), (8, of8[0]), (10, "a text of six own words"), (11, a[::-1]), (11, b[::-1]), (7, ""), (None, a)])
