"""Plan and result invariants on the sf0.001 fixtures."""
import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from pkgsift.plans import catalog as C
from pkgsift.plans import describe as D
from pkgsift.sources import fixtures as FX

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def _npm(spark):
    return FX.source_files(spark, SF).where("ecosystem = 'npm'").drop("ecosystem")


def _src(spark, ecosystem):
    return FX.source_files(spark, SF).where(F.col("ecosystem") == ecosystem).drop("ecosystem")


def test_listing_and_table_agree(spark):
    """Choosing on a listing and reading the chosen rows gives what a table gives."""
    keys = ["package", "version", "rel_path"]
    for eco, features in (("npm", lambda f, **kw: D.npm_version_features(f, k=2, **kw)), ("pypi", D.pypi_file_features), ("rubygems", D.ruby_file_features)):
        files = _src(spark, eco)
        a = features(files)
        b = features(files.drop("content"), read=lambda rows: rows.join(files.select(*keys, "content").withColumnRenamed("rel_path", "_r"),
                     (rows.package == files.package) & (rows.version == files.version)
                     & (F.col("_r") == (F.col("vrel") if "vrel" in rows.columns else rows.rel_path))).select(*(rows[c] for c in rows.columns), "content"))
        cols = sorted(set(a.columns) & set(b.columns) - {"vrel", "size", "path"})
        assert sorted(map(str, rows(a.select(*cols)))) == sorted(map(str, rows(b.select(*cols)))) and a.count() > 0


def test_no_file_body_in_an_exchange(spark, tmp_path, capsys):
    """With broadcasts off, as on a large table, no exchange carries ``content``."""
    labels = C._labels(spark, SF)
    labels.write.parquet(str(tmp_path / "labels"))
    labels = spark.read.parquet(str(tmp_path / "labels"))
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for eco, describe in (("npm", D.npm_descriptions), ("pypi", D.pypi_descriptions), ("rubygems", D.ruby_descriptions)):
            _src(spark, eco).write.parquet(str(tmp_path / eco))
            describe(labels, spark.read.parquet(str(tmp_path / eco))).explain("formatted")
            plan = capsys.readouterr().out
            blocks = [b for b in plan.split("\n\n") if " Exchange" in b.splitlines()[0]] if plan else []
            assert blocks and not any("content" in b or "text#" in b for b in blocks), eco
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


def test_results_independent_of_partitioning(spark):
    files = _npm(spark)
    labels = C._labels(spark, SF)
    base = sorted(rows(D.npm_descriptions(labels, files)))
    shuffled = sorted(rows(D.npm_descriptions(labels.repartition(5), files.repartition(3, "rel_path"))))
    assert base == shuffled


def test_python_nodes_of_plans(spark):
    """Labels and masks run in the JVM alone; sentences scan texts in Arrow batches, once per file read, and do nothing else in Python."""
    for name in ("label_packages", "loss_mask"):
        plan = C.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "ArrowEval" not in plan and "MapInPandas" not in plan, name
    for name, inputs in (("npm_sentences", 3), ("python_sentences", 1), ("ruby_sentences", 1)):  # the npm files are a union of three tables
        plan = C.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ArrowEvalPython") == inputs, name
        assert "BatchEvalPython" not in plan and "MapInPandas" not in plan and "MapInArrow" not in plan, name


def test_topk_count_bounded(spark):
    got = C.queries()["topk_files"](spark, SF)
    worst = got.groupBy("package", "version").count().agg(F.max("count")).first()[0]
    assert worst <= 20


def test_sentence_grammar(spark):
    df = C.queries()["merged_dataset"](spark, SF)
    bad = df.where(~F.col("textual_description").rlike(r"^start entry [^/]+/\S+, .+, end of entry$"))
    assert bad.count() == 0


def test_skewed_version_topk_and_split(spark):
    """One version holds a third of all files / one class a third of all rows."""
    from pkgsift.operators import files as FL
    from pkgsift.operators import split as SP
    hot = [("hot", "1", f"lib/f{i:05d}.js", i) for i in range(3000)]
    cold = [(f"p{j}", "1", f"src/f{i}.js", i) for j in range(600) for i in range(10)]
    df = spark.createDataFrame(hot + cold, "package string, version string, rel_path string, size long")
    top = FL.topk_files(df.repartition(16), k=20)
    assert top.where("package = 'hot'").count() == 20
    assert [r[0] for r in top.where("package = 'hot'").orderBy("rank").select("rel_path").limit(2).collect()] == [
        "lib/f02999.js", "lib/f02998.js"]
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    labelled = df.withColumn("label", (F.col("package") == "hot").cast("int"))
    s = SP.stratified_split(labelled, materialize=False, n_buckets=64)
    sizes = dict(rows(s.groupBy("split").count()))
    import math
    n_test = math.ceil(0.1 * 9000)
    n_val = math.ceil(0.1 / (1 - 0.1) * (9000 - n_test))   # 901 in doubles, as scikit-learn computes
    assert (sizes["test"], sizes["validation"], sizes["train"]) == (n_test, n_val, 9000 - n_test - n_val)
    assert dict(rows(s.where("split = 'test'").groupBy("label").count())) == {1: 300, 0: 600}
