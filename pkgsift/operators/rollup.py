"""Per-version rollup of file features.

One pass over the files.  A file's row is dealt out to its imports, of which the
first carries its flags and counts; rows are merged per (version, module) before
they are merged per version, so a version's list is bounded by its distinct
modules, however many files it has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def version_rollup(file_feats: DataFrame) -> DataFrame:
    """Set-union imports, OR flags and sum counts per version."""
    keys = ["package", "version"]
    flags, sums = ["has_eval_exec", "calls_os", "calls_proc"], ["url_count", "b64_count"]
    dealt = file_feats.select(*keys, *flags, *sums, F.posexplode_outer("imports").alias("_at", "_m"))
    first = F.coalesce(F.col("_at"), F.lit(0)) == 0
    # rows without a package or version are no version: they share no imports
    known, none = F.col("package").isNotNull() & F.col("version").isNotNull(), F.array().cast("array<string>")
    modules = dealt.groupBy(*keys, "_m").agg(
        *(F.bool_or(f).alias(f) for f in flags), *(F.sum(F.when(first, F.col(s))).alias(s) for s in sums), F.count_if(first).alias("n_files"))
    return modules.groupBy(*keys).agg(
        *(F.bool_or(f).alias(f) for f in flags), *(F.sum(s).cast("bigint").alias(s) for s in sums),
        F.sum("n_files").alias("n_files"), F.array_sort(F.collect_list("_m")).alias("imports")).withColumn("imports", F.when(known, F.col("imports")).otherwise(none))
