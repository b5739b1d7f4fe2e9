"""Sinks (S1-S5, E6).

Parquet by default; CSV on request with RFC-4180 quoting (a quote inside a
field is doubled, as pandas writes it; Spark's default would write ``\\"``).
Output is ordered only here, at the sink, and only where the reference's
files are ordered (E6): malicious block first, then package, version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                by: str | None = None) -> None:
    """Write a frame, in as many files as it has partitions (an ordered frame's
    files follow its order); ``by`` names a column that becomes folders.  An
    empty frame still writes its schema / CSV header."""
    w = df.write.mode(mode)
    if by is not None:
        w = w.partitionBy(by)
    if fmt == "csv":
        # pandas keeps blanks at the ends of a field; Spark's writer trims them by default
        (w.option("header", True).option("quote", '"').option("escape", '"')
         .option("emptyValue", "").option("ignoreLeadingWhiteSpace", False)
         .option("ignoreTrailingWhiteSpace", False).csv(path))
    elif fmt == "json":
        w.json(path)
    else:
        w.parquet(path)


def scratch_folder(spark, name: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir`` (shared by the cluster)."""
    import uuid

    from pkgsift.session import ensure_checkpoint_dir
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def sink_order(df: DataFrame) -> DataFrame:
    """``label`` descending (malicious first), then package, version."""
    keys = [F.col("label").desc()] if "label" in df.columns else []
    keys += [F.col(c) for c in ("package", "version") if c in df.columns]
    return df.orderBy(*keys) if keys else df


def write_label_tables(tables, out_dir: str, fmt: str = "csv", ordered: bool = True) -> None:
    """labels_version, labels and (policy 'separate') unreviewed_version."""
    prep = sink_order if ordered else (lambda d: d)
    write_table(prep(tables.versions), f"{out_dir}/labels_version", fmt)
    write_table(prep(tables.packages), f"{out_dir}/labels", fmt)
    write_table(prep(tables.unreviewed), f"{out_dir}/unreviewed_version", fmt)


def write_predictions(preds: DataFrame, path: str, fmt: str = "csv") -> None:
    """S3: (text, label, pred) as strings."""
    write_table(preds.select(F.col("text").cast("string"), F.col("label").cast("string"),
                             F.col("pred").cast("string")), path, fmt)


def metrics_document(metrics: DataFrame, group_col: str = "split",
                     names: dict | None = None) -> DataFrame:
    """One row holding ``{"val": {...}, "test": {...}}`` as JSON text.

    ``names`` renames groups (default: validation → val)."""
    names = names or {"validation": "val"}
    key = F.col(group_col)
    for old, new in names.items():
        key = F.when(F.col(group_col) == old, F.lit(new)).otherwise(key)
    per = metrics.select(key.alias("k"), F.struct("accuracy", "precision", "recall", "f1").alias("v"))
    return per.agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "v")))))
                   .alias("metrics"))


def write_metrics_json(metrics: DataFrame, path: str, group_col: str = "split") -> None:
    write_table(metrics_document(metrics, group_col), path, "json")
