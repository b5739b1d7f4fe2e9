"""Version roots: label rows ↔ directories of a package tree.

The listing is a table of file paths relative to the packages root
(``path``).  A *root* is a directory prefix: ``(top, second)`` for
``pkg/ver/``, or ``(top, null)`` for ``pkg@ver/``.

Resolution follows the reference's order with deterministic "first"
choices (Q5: shortest name, then name):

1. package directory: exact name (C1), else fallback (C3): npm takes a
   directory whose name equals the package or ends with its last path
   segment, PyPI one whose name starts with the package;
2. version directory: exact (C1), else one whose name contains the
   version (C2);
3. npm: else ``{pkg}@{ver}`` at the top level (C4, tried for every unresolved row).

Fallbacks only see the anti-join remainder, and every theta condition
(ends with, starts with, contains) becomes an equi-join on exploded
suffixes, prefixes or substrings of the directory names.  Each key keeps its
best directory before the join, so every remaining row meets exactly one
candidate per kind: no pair enumeration inside a package, however many
versions or directories it has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# PyPI intermediate directory names.
PYPI_INNER_DIRS = ["tar-gz", "zip", "src", "source", "build", "dist"]
# ---------------------------------------------------------------------------


def _split_top(path: Column, ecosystem: str) -> Column:
    """array<struct<top, rest>>: a path's package directory and the parts below it.
    An npm path below ``@scope`` is read both ways: the package may be the scope's
    child (``@scope/name``) or, by the name fallback, the directory itself."""
    parts = F.split(path, "/")

    def at(depth: int) -> Column:
        return F.struct(F.array_join(F.slice(parts, 1, depth), "/").alias("top"),
                        F.slice(parts, F.lit(depth + 1), F.size(parts)).alias("rest"))

    if ecosystem != "npm":
        return F.array(at(1))
    return F.when(parts[0].startswith("@") & (F.size(parts) >= 2), F.array(at(1), at(2))).otherwise(F.array(at(1)))


def directory_table(listing: DataFrame, materialize: bool = True, ecosystem: str = "npm") -> DataFrame:
    """Distinct (top, second) of a listing; ``second`` is null for files directly
    under a package directory.  ``listing`` has file paths and, from a walk, also
    directories (``is_dir``), so that empty ones are found.  One row per version
    directory; written once because every resolution step reads it."""
    is_dir = F.col("is_dir") if "is_dir" in listing.columns else F.lit(False)
    rows = listing.select(F.inline(_split_top(F.col("path"), ecosystem)), is_dir.alias("d"))
    d = (rows.where((F.size("rest") >= 1) | F.col("d"))
         .select("top", F.when((F.size("rest") >= 2) | (F.col("d") & (F.size("rest") == 1)), F.col("rest")[0]).alias("second"))
         .distinct())
    return _materialize(d) if materialize else d


def _materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage of a narrow table that several branches read: it is
    written once to ``spark.checkpoint.dir`` (a shared folder on a cluster),
    so the branches scan it instead of recomputing its plan."""
    from pkgsift.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _affixes(name: Column, kind: str) -> Column:
    """All suffixes or prefixes of ``name`` (exact, no cap)."""
    n = F.length(name)
    rng = F.sequence(F.lit(1), F.greatest(n, F.lit(1)))
    if kind == "suffix":
        return F.transform(rng, lambda i: F.substring(name, i, n))
    if kind == "prefix":
        return F.transform(rng, lambda i: F.substring(name, 1, i))
    raise ValueError("kind must be 'suffix' or 'prefix'")


def _substrings_of_lengths(name: Column, lens: Column) -> Column:
    """Every substring of ``name`` whose length is in ``lens`` (exact)."""
    n = F.length(name)
    fits = F.filter(lens, lambda ln: (ln >= 1) & (ln <= n))
    return F.flatten(F.transform(fits, lambda ln: F.transform(
        F.sequence(F.lit(1), n - ln + 1), lambda i: F.substring(name, i, ln))))


def _best(cands: DataFrame, keys, order, payload) -> DataFrame:
    """Per key, the candidate with the smallest ``order`` tuple (one hash aggregate)."""
    fields = ([F.col(c).alias(f"_o{i}") for i, c in enumerate(order)]
              + [F.col(c).alias(f"_v{i}") for i, c in enumerate(payload)])
    best = F.min(F.struct(*fields)).alias("_b")
    return cands.groupBy(*keys).agg(best).select(
        *keys, *[F.col(f"_b._v{i}").alias(c) for i, c in enumerate(payload)])


def resolve_package_dirs(packages: DataFrame, tops: DataFrame, ecosystem: str) -> DataFrame:
    """(package) → (package, pkg_dir): exact name first, else the fallback
    with the shortest, then smallest, name.

    The fallback keeps one directory per affix key *before* the join (a hash
    aggregate with a map-side partial step), so a common key such as ``utils``
    sends one row per mapper, and every remaining package meets one candidate.
    """
    exact = (packages.join(tops.select(F.col("top").alias("package")), "package", "left_semi")
             .select("package", F.col("package").alias("pkg_dir")))
    rest = packages.join(exact.select("package"), "package", "left_anti")
    kind = "prefix" if ecosystem == "pypi" else "suffix"
    key = F.col("package") if ecosystem == "pypi" else F.element_at(F.split(F.col("package"), "/"), -1)
    # the reference looks at the root's own directories only, so not inside scopes
    affixes = tops.where(F.instr("top", "/") == 0).select(F.col("top").alias("pkg_dir"), F.length("top").alias("_len"),
                          F.explode(F.array_distinct(_affixes(F.col("top"), kind))).alias("_k"))
    best_by_key = _best(affixes, ["_k"], ["_len", "pkg_dir"], ["pkg_dir"])
    fb = rest.select("package", key.alias("_k")).join(best_by_key, "_k").select("package", "pkg_dir")
    return exact.unionByName(fb)


def resolve_roots(labels: DataFrame, listing: DataFrame, ecosystem: str = "npm",
                  materialize: bool = True) -> DataFrame:
    """Label rows → + ``root_top``, ``root_second`` (both null when not found).

    Candidates of the three kinds carry a priority (exact 0, contains 1,
    ``pkg@ver`` 2); the smallest (priority, name length, name) wins, which
    is the reference's fallback order with a deterministic "first".
    """
    d = directory_table(listing, materialize, ecosystem)
    dirs = d.where(F.col("second").isNotNull())
    tops = d.select("top").distinct()
    keys = labels.select("package", "version").distinct()
    pkg = resolve_package_dirs(keys.select("package").distinct(), tops, ecosystem)
    lab = keys.join(pkg, "package", "left")
    # one row per label key; the exact, contains and pkg@ver branches all read it
    if materialize:
        lab = _materialize(lab)

    exact = (lab.join(dirs, (F.col("pkg_dir") == F.col("top")) & (F.col("version") == F.col("second")))
             .select("package", "version", F.lit(0).alias("_p"), "top", "second"))
    # only rows without an exact directory need the fallbacks
    rest = lab.join(exact.select("package", "version"), ["package", "version"], "left_anti")
    # Version directories of those packages, by every substring of their name
    # keyed by (directory, substring) and reduced to the shortest, then smallest,
    # name before the join: one candidate per remaining row, never all pairs
    # Only substrings as long as one of the package's remaining versions can
    # equal one: (distinct version lengths per package) × positions, not all
    # O(L²) substrings.  The length set is bounded by the longest name.
    lens = (rest.where(F.col("pkg_dir").isNotNull())
            .groupBy(F.col("pkg_dir").alias("top"))
            .agg(F.collect_set(F.length("version")).alias("_lens")))
    sub = (dirs.join(lens, "top")
           .select("top", "second", F.length("second").alias("_len"),
                   F.explode(F.array_distinct(_substrings_of_lengths(F.col("second"), F.col("_lens"))))
                   .alias("_sub")))
    sub = _best(sub, ["top", "_sub"], ["_len", "second"], ["second"])
    contains = (rest.join(sub, (F.col("pkg_dir") == F.col("top")) & (F.col("version") == F.col("_sub")))
                .select("package", "version", F.lit(1).alias("_p"), "top", "second"))
    # C4: {pkg}@{ver} at the top level
    at = (rest.join(tops, F.concat_ws("@", "package", "version") == F.col("top"))
          .select("package", "version", F.lit(2).alias("_p"), "top",
                  F.lit(None).cast("string").alias("second")))
    cands = exact.unionByName(contains)
    if ecosystem == "npm":  # the other registries have no such layout
        cands = cands.unionByName(at)
    cands = (cands
             .withColumn("_len", F.length(F.coalesce("second", "top"))))
    best = _best(cands, ["package", "version"], ["_p", "_len", "second"], ["top", "second"])
    best = best.select("package", "version", F.col("top").alias("root_top"),
                       F.col("second").alias("root_second"))
    return labels.join(best, ["package", "version"], "left")


def files_under_roots(roots: DataFrame, listing: DataFrame, ecosystem: str = "npm") -> DataFrame:
    """Files below each resolved root → (package, version, rel_path, + listing columns).

    ``rel_path`` is relative to the root; ``path`` stays, so that a chosen row can
    be read.  Two equi-joins of narrow rows, one per root shape.
    """
    if "is_dir" in listing.columns:
        listing = listing.where(~F.col("is_dir")).drop("is_dir")
    files = listing.select("*", F.inline(_split_top(F.col("path"), ecosystem)).alias("_top", "_rest"))
    r = roots.where(F.col("root_top").isNotNull()).select(
        "package", "version", "root_top", "root_second").distinct()
    two = (r.where(F.col("root_second").isNotNull())
           .join(files.where(F.size("_rest") >= 2).withColumn("_second", F.col("_rest")[0]),
                 (F.col("root_top") == F.col("_top")) & (F.col("root_second") == F.col("_second")))
           .withColumn("rel_path", F.array_join(F.slice("_rest", 2, 1 << 30), "/")))
    one = (r.where(F.col("root_second").isNull())
           .join(files.where(F.size("_rest") >= 1), F.col("root_top") == F.col("_top"))
           .withColumn("rel_path", F.array_join("_rest", "/")))
    cols = ["package", "version", "rel_path", *listing.columns]
    return two.select(*cols).unionByName(one.select(*cols))


def _under(rows: DataFrame, inner: DataFrame) -> DataFrame:
    """Rows inside their version's ``inner`` directory (all rows where there is
    none), with ``rel_path`` relative to it and the version-relative ``vrel``."""
    keyed = rows.join(inner, ["package", "version"], "left").withColumn("vrel", F.col("rel_path"))
    inside = F.col("inner").isNull() | F.col("rel_path").startswith(F.concat(F.col("inner"), F.lit("/")))
    rel = F.when(F.col("inner").isNull(), F.col("rel_path")).otherwise(F.expr("substring(rel_path, length(inner) + 2)"))
    return keyed.where(inside).withColumn("rel_path", rel).drop("inner")


def pypi_inner_root(files: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """C5 (PyPI): a preferred subdirectory (tar-gz, zip, src, source, build,
    dist; first in that order) becomes the root.

    The directories are found in ``files`` (package, version, rel_path relative
    to the version directory) and applied to ``rows``, by default ``files``: a
    listing decides, and rows with features follow it.
    """
    first = F.split(F.col("rel_path"), "/")[0]
    prefs = F.array(*[F.lit(n) for n in PYPI_INNER_DIRS])
    inner = (files.where((F.instr("rel_path", "/") > 0) & first.isin(PYPI_INNER_DIRS))
             .groupBy("package", "version").agg(F.min(F.array_position(prefs, first)).alias("_i"))
             .select("package", "version", F.element_at(prefs, F.col("_i").cast("int")).alias("inner")))
    return _under((files if rows is None else rows).drop("content"), inner)


def ruby_inner_root(files: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """C5 (Ruby): the first ``*.src`` subdirectory, when one exists, is the root."""
    first = F.split(F.col("rel_path"), "/")[0]
    src = (files.where((F.instr("rel_path", "/") > 0) & first.endswith(".src"))
           .groupBy("package", "version").agg(F.min(first).alias("inner")))
    return _under((files if rows is None else rows).drop("content"), src)
