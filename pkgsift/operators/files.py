"""File choice per version.

All choices run on narrow columns (package, version, rel_path, size and
features): file bodies never enter a shuffle.  Features are computed where a
body is read, before the choice; on a tree the chosen paths are read after it.

* ``topk_files`` – npm: best K files by (priority, -size).  ``row_number() <= K``
  lets Spark put a partial WindowGroupLimit before the shuffle, so each
  mapper sends at most K rows per version: a version with a third of all
  files cannot flood one reducer.
* ``representative_python`` / ``representative_ruby`` – one file per version
  by (tier, path), as ``min(struct(tier, path))``: a hash aggregate with a
  map-side partial step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Deny-path patterns and npm priorities (the reference's).
NPM_DENY = r"(?i)(?:^|/)(tests?|__tests__|examples?|docs?|node_modules)(?:/|$)"
PYPI_DENY = r"(?i)(?:^|/)(tests?|examples?|docs?|.*egg\-info)(?:/|$)"
NPM_PRIORITY = [("/dist/", -30), ("/lib/", -20), ("/src/", -10)]
NPM_INDEX_BONUS = -5
NPM_DENY_PENALTY = 100
REFERENCE_TOP_K = 20
JS_EXTENSIONS = r"\.(js|ts)$"
# ---------------------------------------------------------------------------


def tree_path(package: Column, version: Column, rel_path: Column) -> Column:
    """Q6: patterns see ``/package/version/rel_path``, not the mount point."""
    return F.concat(F.lit("/"), package, F.lit("/"), version, F.lit("/"), rel_path)


def npm_priority(path: Column) -> Column:
    pri = None
    for needle, score in NPM_PRIORITY:
        cond = F.instr(path, needle) > 0
        pri = F.when(cond, F.lit(score)) if pri is None else pri.when(cond, F.lit(score))
    pri = pri.otherwise(F.lit(0))
    idx = path.endswith("/index.js") | path.endswith("/index.ts")
    return (pri + F.when(idx, F.lit(NPM_INDEX_BONUS)).otherwise(F.lit(0))
            + F.when(path.rlike(NPM_DENY), F.lit(NPM_DENY_PENALTY)).otherwise(F.lit(0)))


def js_candidates(files: DataFrame, include_tests: bool = False) -> DataFrame:
    """A7 + B7: ``*.js`` / ``*.ts`` files, deny paths removed unless ``include_tests``."""
    path = tree_path(F.col("package"), F.col("version"), F.col("rel_path"))
    out = files.where(F.col("rel_path").rlike(JS_EXTENSIONS))
    if not include_tests:
        out = out.where(~path.rlike(NPM_DENY))
    return out


def topk_files(files: DataFrame, k: int | None = None, include_tests: bool = False) -> DataFrame:
    """(package, version, rel_path, size, other narrow columns) → best ``k``
    per version with ``rank``; all of them without ``k``.

    Ties keep the reference's stable order: all ``.js`` before ``.ts``, then path.
    File bodies stay out: ``content`` is dropped before the rank.
    """
    narrow = js_candidates(files.drop("content"), include_tests)
    path = tree_path(F.col("package"), F.col("version"), F.col("rel_path"))
    w = Window.partitionBy("package", "version").orderBy(
        npm_priority(path), F.col("size").desc(), F.col("rel_path").endswith(".ts"),
        F.col("rel_path"))
    ranked = narrow.withColumn("rank", F.row_number().over(w))
    return ranked if k is None else ranked.where(F.col("rank") <= k)


def python_tier(package: Column, version: Column, rel_path: Column,
                from_archive: Column | None = None, vrel: Column | None = None) -> Column:
    """E2 tiers: 1 ``<hint>/__init__.py``; 2 under ``/<hint>/``; 3 ``src/`` non-deny;
    4 any non-deny; 5 any.  ``hint`` is the package with '-' → '_'.

    ``rel_path`` is relative to the version root; path patterns see the path
    relative to the version directory (``vrel``) under ``/package/version``.
    """
    hint = F.regexp_replace(package, "-", "_")
    tree = tree_path(package, version, rel_path if vrel is None else vrel)
    # files from an archive are seen by member path only (Q6)
    seen = tree if from_archive is None else F.when(from_archive, F.concat(F.lit("/"), rel_path)).otherwise(tree)
    init = (rel_path == F.concat(hint, F.lit("/__init__.py"))) | rel_path.endswith(
        F.concat(F.lit("/"), hint, F.lit("/__init__.py")))
    under = F.instr(seen, F.concat(F.lit("/"), hint, F.lit("/"))) > 0
    deny = seen.rlike(PYPI_DENY)
    return (F.when(init, 1).when(under, 2)
            .when(rel_path.startswith("src/") & ~deny, 3)
            .when(~deny, 4).otherwise(5))


def _pick_min(files: DataFrame, tier: Column, among: Column | None = None, notes: tuple[Column, ...] = ()) -> DataFrame:
    """Per version, the row of least (tier, rel_path) with its other columns, in
    one aggregate.  ``content`` is dropped: features come before the choice, or
    the chosen paths are read after it.  Only rows ``among`` can be chosen (nulls
    stand where there are none); ``notes`` are further aggregates of all rows."""
    files = files.drop("content")
    rest = [c for c in files.columns if c not in ("package", "version", "rel_path", "tier")]
    row = F.struct(tier.alias("tier"), F.col("rel_path"), *rest)
    best = F.min(row if among is None else F.when(among, row))
    chosen = files.groupBy("package", "version").agg(best.alias("_b"), *notes)
    return chosen.select("package", "version", "_b.rel_path", "_b.tier", *(F.col(f"_b.{c}").alias(c) for c in rest), *chosen.columns[3:])


def representative_python(files: DataFrame) -> DataFrame:
    """One ``*.py`` per version → (package, version, rel_path, tier, …)."""
    py = files.where(F.col("rel_path").endswith(".py"))
    arch = F.col("from_archive") if "from_archive" in files.columns else None
    vrel = F.col("vrel") if "vrel" in files.columns else None
    return _pick_min(py, python_tier(F.col("package"), F.col("version"), F.col("rel_path"), arch, vrel))


def ruby_tier(rel_path: Column) -> Column:
    """E3 tiers: 1 ``*.gemspec``; 2 ``lib/**/*.rb``; 3 any ``*.rb``."""
    return (F.when(rel_path.endswith(".gemspec"), 1)
            .when(rel_path.startswith("lib/") & rel_path.endswith(".rb"), 2)
            .otherwise(3))


def _is_ruby() -> Column:
    return F.col("rel_path").endswith(".gemspec") | F.col("rel_path").endswith(".rb")


def ruby_candidates(files: DataFrame) -> DataFrame:
    return files.where(_is_ruby())


def representative_ruby(files: DataFrame) -> DataFrame:
    """One Ruby file per version → (package, version, rel_path, tier, …)."""
    return _pick_min(ruby_candidates(files), ruby_tier(F.col("rel_path")))


def representative_members(members: DataFrame) -> DataFrame:
    """E3 on the member rows of opened archives, marker and error rows included:
    the same row per version (null without a Ruby file), ``opened`` if its
    archives were read to their ends, ``broken`` if one could not be read."""
    found = F.col("error").isNull() & F.col("rel_path").isNotNull()
    notes = (F.bool_or(F.col("error").isNull() & F.col("rel_path").isNull()).alias("opened"), F.bool_or(F.col("error").isNotNull()).alias("broken"))
    return _pick_min(members.where(~found | _is_ruby()), ruby_tier(F.col("rel_path")), found, notes)
