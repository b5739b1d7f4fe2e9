"""Streaming describe step: per-file features as new files land.

The per-file feature functions are stateless Column expressions, so they
run unchanged on a streaming DataFrame.  A registry's ingest appends Parquet
files to ``source_files``; this job reads that folder as a stream and
appends one feature row per new file.  The per-version rollup and sentence
need every file of a version, so they stay batch jobs over the feature
table (``plans.describe``), run when a version is complete.

Checkpoints go under ``spark.checkpoint.dir`` (a shared folder on a
cluster), so a restarted query resumes where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pkgsift.functions import js_features as JS
from pkgsift.functions import python_features as PY
from pkgsift.functions import ruby_features as RB
from pkgsift.session import ensure_checkpoint_dir

SOURCE_SCHEMA = "ecosystem string, path string, size bigint, content string"
JS_SUFFIX = r"\.(js|ts)$"


def file_features(files: DataFrame, ecosystem: str) -> DataFrame:
    """Stateless per-file features for one registry (batch or streaming input)."""
    if ecosystem == "npm":
        f = JS.js_features(files.where(F.col("path").rlike(JS_SUFFIX)), "content", "size", path_col="path")
        cols = ["imports", "has_eval_exec", "calls_os", "calls_proc", "url_count", "b64_count", "light"]
    elif ecosystem == "pypi":
        f = PY.python_features(files.where(F.col("path").endswith(".py")), "content")
        cols = ["imports", "calls", "has_eval_exec", "url_count", "b64_count"]
    else:
        f = RB.ruby_features(files.where(F.col("path").endswith(".rb") | F.col("path").endswith(".gemspec")),
                             "content")
        cols = ["requires", "calls", "has_eval_exec", "url_count", "b64_count"]
    return f.select("path", "size", *cols)


def feature_stream(spark: SparkSession, source_dir: str, ecosystem: str,
                   max_files_per_trigger: int = 1000) -> DataFrame:
    """Streaming DataFrame of per-file features over a ``source_files`` folder."""
    stream = (spark.readStream.schema(SOURCE_SCHEMA)
              .option("maxFilesPerTrigger", max_files_per_trigger)
              .parquet(source_dir)
              .where(F.col("ecosystem") == ecosystem))
    return file_features(stream, ecosystem)


def start_feature_stream(spark: SparkSession, source_dir: str, ecosystem: str, out_dir: str,
                         name: str | None = None, available_now: bool = True) -> StreamingQuery:
    """Append per-file features to Parquet at ``out_dir`` (exactly once via the checkpoint)."""
    ckpt = ensure_checkpoint_dir(spark)
    q = (feature_stream(spark, source_dir, ecosystem).writeStream
         .format("parquet").outputMode("append")
         .option("checkpointLocation", f"{ckpt}/stream-{name or ecosystem}")
         .option("path", out_dir))
    q = q.trigger(availableNow=True) if available_now else q.trigger(processingTime="1 minute")
    return q.start()
