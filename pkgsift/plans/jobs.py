"""The three end-to-end jobs, with the reference's command-line options as
parameters (L1, L2, L3).  Each reads its inputs, builds one lazy plan and
writes through ``sources.sinks``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pkgsift.operators import labels as L
from pkgsift.operators.metrics import detection_metrics
from pkgsift.operators import roots as RT
from pkgsift.operators import split as SP
from pkgsift.plans import describe as D
from pkgsift.plans import detector as DT
from pkgsift.sources import archives as AR
from pkgsift.sources import review_csv as RC
from pkgsift.sources import sinks as SK
from pkgsift.sources import tree as TR


def label_job(spark: SparkSession, info_csv: str, out_dir: str, ecosystem: str = "npm",
              policy: str = "drop", fmt: str = "csv", numeric_labels: bool = False,
              pandas_na: bool = False) -> L.LabelTables:
    """L1 (npm / PyPI): review CSV → labels_version, labels, unreviewed_version."""
    tables = L.build_labels(RC.read_review_info(spark, info_csv, ecosystem, pandas_na),
                            policy, numeric_labels)
    SK.write_label_tables(tables, out_dir, fmt)
    return tables


def ruby_label_job(spark: SparkSession, mal_dir: str | None, ben_dir: str | None, out_dir: str,
                   require_gemspec: bool = False, require_ruby: bool = False,
                   fmt: str = "csv") -> DataFrame:
    """L1 (RubyGems): labelled roots → labels_version (+ package labels)."""
    def listing(root):
        if root is None:
            return None
        return TR.walk(spark, root).select(F.col("path").alias("rel_path"), "is_dir")
    versions = L.ruby_version_labels(listing(mal_dir), listing(ben_dir), require_gemspec,
                                     require_ruby, spark=spark)
    SK.write_table(SK.sink_order(versions), f"{out_dir}/labels_version", fmt)
    SK.write_table(SK.sink_order(L.package_labels(versions)), f"{out_dir}/labels", fmt)
    return versions


def describe_job(spark: SparkSession, ecosystem: str, packages_dir: str, out_dir: str,
                 labels_csv: str | None = None, mal_dir: str | None = None,
                 ben_dir: str | None = None, val_size: float = 0.10, test_size: float = 0.10,
                 seed: int = 42, fmt: str = "csv", **kw) -> DataFrame:
    """L2: package tree (+ labels) → sentences → exact split → train/validation/test.

    npm and PyPI take ``labels_csv`` (package, version, label); RubyGems walks
    ``mal_dir`` and ``ben_dir`` (its label is the root a version sits in).
    """
    def read_from(root):
        return lambda rows: TR.read_files(root, rows)

    def expand_from(root, suffixes):
        return lambda chosen: AR.expand_archives_at(spark, root, chosen, suffixes)

    if ecosystem == "rubygems":
        parts = []
        for root, label in ((mal_dir, 1), (ben_dir, 0)):
            if root:
                entries = TR.walk(spark, root)
                versions = L.directory_version_labels(entries.withColumnRenamed("path", "rel_path"), label)
                files = TR.keyed_files(entries.where("not is_dir").drop("is_dir"))
                parts.append(D.ruby_descriptions(versions, files, read=read_from(root), expand=expand_from(root, (".rb", ".gemspec")), **kw))
        if not parts:
            raise ValueError("RubyGems needs mal_dir and/or ben_dir")
        described = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    else:
        if labels_csv is None:
            raise ValueError("npm and PyPI need labels_csv")
        labels = RC.read_version_labels(spark, labels_csv)
        entries = TR.walk(spark, packages_dir, levels=3 if ecosystem == "npm" else 2)
        roots = RT.resolve_roots(labels, entries, ecosystem)
        found = roots.where(F.col("root_top").isNotNull()).select("package", "version").distinct()
        files = RT.files_under_roots(roots, entries, ecosystem)
        if ecosystem == "npm":
            described = D.npm_descriptions(labels, files, found, read=read_from(packages_dir), **kw)
        else:
            described = D.pypi_descriptions(labels, files, found, read=read_from(packages_dir), expand=expand_from(packages_dir, (".py",)), **kw)
    out = SP.stratified_split(described, val_size=val_size, test_size=test_size, seed=seed)
    SP.write_splits(out, out_dir, fmt)
    return out


def train_job(spark: SparkSession, train_csv: str, val_csv: str, test_csv: str, out_dir: str,
              text_col: str | None = None, label_col: str | None = None,
              predict_only: bool = False, model_dir: str | None = None, kind: str = "bayes", **kw):
    """L3: split CSVs → detector → predictions (test) and metrics (val, test)."""
    def load(p, name):
        return RC.load_split_csv(spark, p, text_col, label_col).withColumn("split", F.lit(name))
    val, test = load(val_csv, "validation"), load(test_csv, "test")
    model_path = model_dir or f"{out_dir}/model"
    if predict_only:
        model = DT.load_detector(model_path, kind)
    else:
        model = DT.fit_detector(load(train_csv, "train"), kind=kind, **kw)
        DT.save_detector(model, model_path)
    held = val.unionByName(test)
    scored = model.transform(held).select(
        "text", "label", "split", F.col("_pred").cast("int").cast("string").alias("pred"))
    metrics = detection_metrics(scored, group_cols=["split"])
    SK.write_metrics_json(metrics, f"{out_dir}/metrics")
    SK.write_predictions(scored.where(F.col("split") == "test"), f"{out_dir}/preds_test")
    return model, scored, metrics
