from pkgsift.streaming.describe_stream import SOURCE_SCHEMA, file_features, start_feature_stream


def test_feature_stream_matches_batch(spark, tmp_path):
    src = str(tmp_path / "src")
    rows_in = [("npm", "p/1/a.js", 40, "const cp = require('child_process'); cp.exec('x')"),
               ("npm", "p/1/b.js", 9, "eval('1')"), ("pypi", "q/1/m.py", 9, "import os")]
    spark.createDataFrame(rows_in, SOURCE_SCHEMA).write.parquet(src)
    out = str(tmp_path / "out")
    q = start_feature_stream(spark, src, "npm", out, name="t1")
    q.awaitTermination(120)
    got = sorted((r["path"], r["calls_os"], r["has_eval_exec"]) for r in spark.read.parquet(out).collect())
    batch = file_features(spark.read.parquet(src), "npm")
    assert got == sorted((r["path"], r["calls_os"], r["has_eval_exec"]) for r in batch.collect())
    assert got == [("p/1/a.js", True, False), ("p/1/b.js", False, True)]
