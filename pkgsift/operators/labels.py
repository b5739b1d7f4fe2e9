"""Label construction (B1-B5, D1-D4): review rows → version and package labels.

One lazy plan per output.  The only shuffles are the de-duplication
(``dropDuplicates``, a hash aggregate with a map-side partial step) and the
package-level max (also partial + final), so a package that owns a third of
all rows is pre-aggregated on every mapper before it reaches one reducer.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pkgsift.functions.colcache import cached_columns
from pkgsift.functions.tags import normalize_tag, strip_blanks, tag_class, tag_label


class LabelTables(NamedTuple):
    versions: DataFrame      # package, version, label
    packages: DataFrame      # package, label
    unreviewed: DataFrame    # package, version (filled under policy 'separate')
    tag_counts: DataFrame    # tag, count
    report: DataFrame        # level, rows, positives, negatives, pos_ratio


@cached_columns
def _review_cols():
    return (strip_blanks(F.col("package")).alias("package"),
            strip_blanks(F.col("version")).alias("version"),
            normalize_tag(F.col("threat")).alias("tag"))


@cached_columns
def _label_col(policy: str, numeric_labels: bool):
    return tag_label(F.col("tag"), policy, numeric_labels).alias("label")


def review_rows(info: DataFrame) -> DataFrame:
    """(package, version, threat) → drop rows with a null, strip, normalize."""
    return info.select("package", "version", "threat").dropna().select(*_review_cols())


def tag_counts(rows: DataFrame) -> DataFrame:
    """Rows per normalized tag, most frequent first (before any policy)."""
    return (rows.groupBy("tag").agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.col("count").desc(), F.col("tag")))


def classified(rows: DataFrame, policy: str = "drop", numeric_labels: bool = False) -> DataFrame:
    """(package, version, tag) → (package, version, label); excluded rows removed."""
    return (rows.select("package", "version", _label_col(policy, numeric_labels))
            .where(F.col("label").isNotNull()))


def version_labels(rows: DataFrame, policy: str = "drop", numeric_labels: bool = False) -> DataFrame:
    """Distinct (package, version, label); two labels for one version both stay."""
    return classified(rows, policy, numeric_labels).dropDuplicates(["package", "version", "label"])


def package_labels(versions: DataFrame) -> DataFrame:
    """D3: package label = max of its version labels."""
    return versions.groupBy("package").agg(F.max("label").cast("int").alias("label"))


def unreviewed_versions(rows: DataFrame, numeric_labels: bool = False) -> DataFrame:
    """B5 'separate': distinct (package, version) of unreviewed rows."""
    return (rows.where(tag_class(F.col("tag"), numeric_labels) == "unreviewed")
            .select("package", "version").dropDuplicates(["package", "version"]))


def _summary(df: DataFrame, level: str) -> DataFrame:
    return df.agg(
        F.lit(level).alias("level"),
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("label") == 1).alias("positives"),
        F.count_if(F.col("label") == 0).alias("negatives"),
        # null when there are no rows (the reference prints "NA")
        (F.count_if(F.col("label") == 1).cast("double")
         / F.nullif(F.count(F.lit(1)), F.lit(0)).cast("double")).alias("pos_ratio"))


def label_report(versions: DataFrame, packages: DataFrame) -> DataFrame:
    """Row counts and positive ratio per level, as a DataFrame."""
    return _summary(versions, "version").unionByName(_summary(packages, "package"))


def conflicting_versions(versions: DataFrame) -> DataFrame:
    """Q4 report: versions that carry both labels."""
    return (versions.groupBy("package", "version")
            .agg(F.countDistinct("label").alias("n_labels"))
            .where(F.col("n_labels") > 1).drop("n_labels"))


def build_labels(info: DataFrame, policy: str = "drop", numeric_labels: bool = False) -> LabelTables:
    """L1 end to end: review info → every label output."""
    rows = review_rows(info)
    versions = version_labels(rows, policy, numeric_labels)
    packages = package_labels(versions)
    unrev = unreviewed_versions(rows, numeric_labels)
    if policy != "separate":
        unrev = unrev.where(F.lit(False))
    return LabelTables(versions, packages, unrev, tag_counts(rows), label_report(versions, packages))


def directory_version_labels(listing: DataFrame, label: int | None, require_gemspec: bool = False,
                             require_ruby: bool = False) -> DataFrame:
    """Versions found under a labelled root → (package, version, label).

    ``listing`` has ``rel_path`` relative to the root (``pkg/ver/...``) and, from
    a walk, ``is_dir``: a version directory without files is a version too.  With
    ``label`` None the listing's own ``label`` column says which root it is.  The
    version root is the version directory, or its first ``*.src`` child directory
    when one exists; the flag checks look inside that root only.  Two aggregates:
    flags per child directory, then the choice of the child.
    """
    parts = F.split(F.col("rel_path"), "/")
    is_dir = F.col("is_dir") if "is_dir" in listing.columns else F.lit(False)
    rows = listing.select(parts.alias("p"), is_dir.alias("d"), (F.col("label") if label is None else F.lit(label)).cast("int").alias("label"))
    rows = rows.where((F.size("p") >= 3) | (F.col("d") & (F.size("p") == 2)))
    inside = (F.size("p") >= 4) | (F.col("d") & (F.size("p") == 3))
    name = F.element_at("p", -1)
    keys = [F.col("p")[0].alias("package"), F.col("p")[1].alias("version"), "label"]
    per_child = rows.groupBy(*keys, F.when(inside, F.col("p")[2]).alias("child")).agg(
        F.bool_or(~F.col("d") & name.endswith(".gemspec")).alias("gem"), F.bool_or(~F.col("d") & name.endswith(".rb")).alias("rb"))
    flags = per_child.groupBy("package", "version", "label").agg(
        F.min(F.when(F.col("child").endswith(".src"), F.struct("child", "gem", "rb"))).alias("src"), F.bool_or("gem").alias("gem"), F.bool_or("rb").alias("rb"))
    if require_gemspec:
        flags = flags.where(F.coalesce("src.gem", "gem"))
    if require_ruby:
        flags = flags.where(F.coalesce("src.rb", "rb"))
    return flags.select("package", "version", "label")


def ruby_version_labels(mal_listing: DataFrame | None, ben_listing: DataFrame | None,
                        require_gemspec: bool = False, require_ruby: bool = False,
                        spark=None) -> DataFrame:
    """malicious versions ∪ benign versions, de-duplicated (a missing root is empty)."""
    both = None
    for listing, label in ((mal_listing, 1), (ben_listing, 0)):
        if listing is not None:
            is_dir = F.col("is_dir") if "is_dir" in listing.columns else F.lit(False)
            one = listing.select("rel_path", is_dir.alias("is_dir"), F.lit(label).alias("label"))
            both = one if both is None else both.unionByName(one)
    if both is None:
        if spark is None:
            raise ValueError("no listing given and no session to build an empty frame")
        return spark.createDataFrame([], "package string, version string, label int")
    return directory_version_labels(both, None, require_gemspec, require_ruby)
