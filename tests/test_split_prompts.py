import math

import pytest
from pyspark.sql import functions as F

from conftest import rows
from pkgsift.functions import prompts as PR
from pkgsift.operators import split as SP
from pkgsift.operators.metrics import detection_metrics
from pkgsift.sources.review_csv import detect_columns, to_text_label


def _data(spark, n, pos):
    return spark.createDataFrame([(f"t{i}", 1 if i < pos else 0) for i in range(n)], "text string, label int")


def _sizes(n, val=0.1, test=0.1):
    """scikit-learn's two-stage arithmetic, in Python doubles."""
    nt = math.ceil(test * n)
    nv = math.ceil(val / (1 - test) * (n - nt))
    return n - nt - nv, nv, nt


@pytest.mark.parametrize("n,pos,sizes", [(20, 10, _sizes(20)), (101, 30, (80, 10, 11)),
                                         (399, 120, (319, 40, 40)), (33, 10, _sizes(33))])
def test_split_sizes_and_balance(spark, n, pos, sizes):
    s = SP.stratified_split(_data(spark, n, pos), materialize=False)
    counts = dict(rows(s.groupBy("split").count()))
    assert (counts.get("train", 0), counts.get("validation", 0), counts.get("test", 0)) == sizes
    assert s.count() == n and s.select("text").distinct().count() == n
    per = dict(((sp, lab), c) for sp, lab, c in rows(s.groupBy("split", "label").count()))
    assert abs(per.get(("test", 1), 0) / sizes[2] - pos / n) <= 1 / sizes[2] + 1e-9


def test_split_is_deterministic_and_partition_independent(spark):
    d = _data(spark, 200, 50)
    a = sorted(rows(SP.stratified_split(d, materialize=False)))
    b = sorted(rows(SP.stratified_split(d.repartition(7), materialize=False, n_buckets=16)))
    assert a == b


def test_split_rejects_tiny_class(spark):
    with pytest.raises(Exception, match="fewer than 2"):
        SP.stratified_split(_data(spark, 10, 1), materialize=False).collect()
    with pytest.raises(Exception, match="smaller than the number of classes"):
        SP.stratified_split(_data(spark, 10, 5), materialize=False).collect()


def test_prompt_and_completion(spark):
    df = spark.createDataFrame([("abc", " 1 "), (None, "0")], "t string, l string")
    p = rows(df.select(PR.build_prompt(F.col("t"), F.col("l")), PR.build_prompt(F.col("t"))))
    assert p[0][0].endswith("<|assistant|>: 1") and "文本：abc\n" in p[0][0]
    assert p[1][1].count("nan") == 1 and p[0][1].endswith("<|assistant|>: ")
    gen = spark.createDataFrame([("x <|assistant|>: maybe 1",), ("1 <|assistant|>: none",),
                                 ("<|assistant|>: 0 <|assistant|>: 10",), ("no marker 1",)], "g string")
    assert [r[0] for r in gen.select(PR.prediction(F.col("g"))).collect()] == ["1", "0", "1", "1"]


def test_completion_mask(spark):
    df = spark.createDataFrame([([5, 1, 2, 9, 1, 2, 7], [1, 1, 1, 1, 1, 1, 0]), ([3, 4], [1, 1])],
                               "ids array<int>, att array<int>")
    out = PR.with_completion_mask(df, "ids", F.array(F.lit(1), F.lit(2)), "att")
    got = rows(out, "template_start", "labels")
    assert got[0] == (5, [-100, -100, -100, -100, 1, 2, -100])
    assert got[1] == (None, [-100, -100])


def test_label_detection_and_digit_rule(spark):
    assert detect_columns(["Sentence", "Y"]) == ("Sentence", "Y")
    assert detect_columns(["foo", "label"]) == ("foo", "label")
    with pytest.raises(ValueError):
        detect_columns(["label"])
    df = spark.createDataFrame([("a", "1"), ("b", "0.0"), ("c", "10"), ("d", "2"), ("e", "label_0"),
                                ("f", "True"), ("g", None), (None, "1")], "text string, label string")
    assert rows(to_text_label(df)) == [("a", "1"), ("b", "0"), ("c", "1"), ("e", "0")]


def test_detection_metrics(spark):
    df = spark.createDataFrame([("1", "1"), ("1", "0"), ("0", "1"), ("0", "0"), ("0", "0")], "label string, pred string")
    m = detection_metrics(df).first().asDict()
    assert m["n"] == 5 and m["accuracy"] == 0.6
    assert m["precision"] == 0.5 and m["recall"] == 0.5 and m["f1"] == 0.5
    z = detection_metrics(spark.createDataFrame([("0", "0")], "label string, pred string")).first()
    assert (z["precision"], z["recall"], z["f1"]) == (0.0, 0.0, 0.0)


def test_score_with_generator(spark):
    import numpy as np

    from pkgsift.plans.detector import score_with_generator

    def make_predict_fn():
        def predict(prompts):
            return np.array([p + ("1" if "bad" in p else "maybe") for p in prompts])
        return predict

    df = spark.createDataFrame([("bad thing", "1"), ("fine", "0")], "text string, label string")
    got = sorted(tuple(r) for r in score_with_generator(df, make_predict_fn, batch_size=2).collect())
    assert got == [("bad thing", "1", "1"), ("fine", "0", "0")]


def test_csv_sink_quoting(spark, tmp_path):
    from pkgsift.sources.sinks import write_table
    df = spark.createDataFrame([('say "hi", ok', 1), ("line\nbreak", 0)], "textual_description string, label int")
    write_table(df.coalesce(1), str(tmp_path / "o"), "csv")
    import csv
    import glob
    with open(glob.glob(str(tmp_path / "o" / "*.csv"))[0], newline="", encoding="utf-8") as fh:
        assert list(csv.reader(fh)) == [["textual_description", "label"], ['say "hi", ok', "1"], ["line\nbreak", "0"]]


def test_group_split_keeps_groups_whole(spark):
    data = spark.createDataFrame([(f"p{i % 40}", f"{i}", 1 if i % 40 < 12 else 0) for i in range(200)],
                                 "package string, version string, label int")
    s = SP.group_split(data, "package", materialize=False)
    per_pkg = s.groupBy("package").agg(F.countDistinct("split").alias("n"))
    assert per_pkg.where("n > 1").count() == 0 and s.count() == 200
    groups = dict(rows(s.select("package", "split").distinct().groupBy("split").count()))
    assert (groups["train"], groups["validation"], groups["test"]) == _sizes(40)


def test_split_with_a_hot_group_of_copies(spark):
    """A third of all rows are identical copies, spread over many input
    partitions: sizes stay exact, and each copy lands where a single global
    ranking by (md5(seed|key), key) would put the copies as a block."""
    import hashlib
    from collections import Counter
    data = [(f"row {i}", i % 3 == 0 and 1 or 0) for i in range(600)] + [("same text", 1)] * 300
    df = spark.createDataFrame(data, "text string, label int").repartition(9)
    got = Counter((r.text, r.label, r.split) for r in SP.stratified_split(df, seed=7, n_buckets=16).collect())
    # brute force: rank each class by (md5, key); copies take consecutive ranks
    expect = Counter()
    sizes = {r["label"]: (r["n_test_c"], r["n_val_c"]) for r in
             SP.class_quotas(df).collect()}
    for lab in (0, 1):
        cls = [t for t in data if t[1] == lab]
        keyed = sorted(cls, key=lambda t: (hashlib.md5(f"7|{t[0]}\u0001{t[1]}".encode()).hexdigest(),
                                           f"{t[0]}\u0001{t[1]}"))
        n_test, n_val = sizes[lab]
        for rank, t in enumerate(keyed, start=1):
            sp = "test" if rank <= n_test else "validation" if rank <= n_test + n_val else "train"
            expect[(t[0], t[1], sp)] += 1
    assert got == expect
    assert sum(got.values()) == len(data)
