"""Describe stage per registry: source files + labels → one sentence per label row.

``files`` – (package, version, rel_path, size, …) keyed by the version directory
they sit in – comes in two forms:

* a table with ``content`` (``sources.tree.ingest``, or the fixtures): features
  are computed where a body is read, and the choice of files runs on the
  feature rows;
* a listing without ``content``, with ``read``: the choice runs on the listing,
  and ``read`` adds the bodies of the chosen rows inside the tasks.

Either way no file body crosses an exchange.  ``expand`` opens archives: it
takes chosen (package, version, path) rows and gives member rows with
``content``, a row with a null member per archive read to its end, and a row
with ``error`` per broken one.

``labels`` – (package, version, label) label rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pkgsift.functions import evidence as EV
from pkgsift.functions import js_features as JS
from pkgsift.functions import python_features as PY
from pkgsift.functions import ruby_features as RB
from pkgsift.functions.colcache import cached_columns
from pkgsift.functions.lexers import DEFAULT_MAX_TOKENS
from pkgsift.operators import files as FL
from pkgsift.operators import roots as RT
from pkgsift.operators import split as SP
from pkgsift.operators.rollup import version_rollup

Read = Callable[[DataFrame], DataFrame]
Expand = Callable[[DataFrame], DataFrame]

NO_JS = "no javascript file"
NO_SOURCE = "no source found"
NO_PY = "no python file"
NO_RUBY = "no ruby file"


# --------------------------------------------------------------------------- npm

def _features(files: DataFrame, choose, extract, read) -> DataFrame:
    """Choice and features, in the order that keeps bodies out of exchanges."""
    rows = choose(extract(files)) if read is None else extract(read(choose(files)))
    return rows.drop("content", "text")


def npm_file_features(files: DataFrame, k: int | None = None, include_tests: bool = False,
                      max_file_bytes: int = JS.DEFAULT_MAX_FILE_BYTES,
                      max_tokens: int = DEFAULT_MAX_TOKENS, extended: bool = False,
                      read: Read | None = None) -> DataFrame:
    """Candidate files per version with their features, one row per file: all of
    them, or the best ``k`` (E1)."""
    def choose(rows):
        return FL.js_candidates(rows, include_tests) if k is None else FL.topk_files(rows, k, include_tests)

    def extract(rows):
        text = FL.js_candidates(rows, include_tests).withColumn("text", EV.decode_text(F.col("content")))
        return JS.js_features(text, "text", "size", max_file_bytes, max_tokens, extended=extended, path_col="rel_path").drop("content", "text", "calls")

    return _features(files, choose, extract, read)


def npm_version_features(files: DataFrame, **kw) -> DataFrame:
    """D5 rollup per version."""
    return version_rollup(npm_file_features(files, **kw))


def manifest_hooks(files: DataFrame, read: Read | None = None) -> DataFrame:
    """A9 + G5: ``package.json`` at the version root → (package, version, startup)."""
    JS.allow_repeated_keys(files.sparkSession)
    manifests = files.where(F.col("rel_path") == "package.json")
    return ((manifests if read is None else read(manifests))
            .select("package", "version",
                    JS.install_hook(EV.decode_text(F.col("content"))).alias("startup")))


def npm_descriptions(labels: DataFrame, files: DataFrame, found: DataFrame | None = None,
                     read: Read | None = None, **kw) -> DataFrame:
    """L2 (npm): label rows → (package, version, textual_description, label).

    ``found`` lists (package, version) that have a version root; by default
    every version present in ``files``.
    """
    feats = npm_version_features(files, read=read, **kw)
    hooks = manifest_hooks(files, read)
    if found is None:
        found = files.select("package", "version").distinct()
    rows = (labels.select("package", "version", "label")
            .join(found.withColumn("_found", F.lit(True)), ["package", "version"], "left")
            .join(feats, ["package", "version"], "left")
            .join(hooks, ["package", "version"], "left"))
    return rows.select("package", "version", *_npm_text_cols())


@cached_columns
def _npm_text_cols():
    zero = F.lit(0).cast("bigint")
    text = JS.npm_sentence(
        F.col("package"), F.col("version"),
        F.coalesce(F.col("imports"), F.array().cast("array<string>")),
        F.coalesce(F.col("calls_os"), F.lit(False)), F.coalesce(F.col("calls_proc"), F.lit(False)),
        F.coalesce(F.col("has_eval_exec"), F.lit(False)),
        F.coalesce(F.col("url_count"), zero), F.coalesce(F.col("b64_count"), zero),
        F.coalesce(F.col("startup"), F.lit(False)))
    text = F.when(F.col("_found").isNull(),
                  EV.fixed_sentence(F.col("package"), F.col("version"), NO_JS)).otherwise(text)
    return text.alias("textual_description"), F.col("label").cast("int").alias("label")


# --------------------------------------------------------------------------- PyPI

def _py_features(rows: DataFrame, from_imports: bool, max_tokens: int) -> DataFrame:
    text = rows.where(F.col("rel_path").endswith(".py")).withColumn("text", EV.decode_text(F.col("content")))
    return PY.python_features(text, "text", from_imports, 1, max_tokens).drop("content", "text")


# Archive kinds tried at the PyPI inner root, in the reference's order.
PYPI_ARCHIVE_ORDER = [".tar.gz", ".tgz", ".zip", ".whl", ".tar"]


def pypi_archive_choice(listing: DataFrame) -> DataFrame:
    """A10: (package, version, path) of the first archive directly in the inner
    root (by kind order, then name) of versions without ``*.py`` there.

    ``listing`` has the file's own ``path`` in the tree, so an archive under a
    fallback root is found where it lies.
    """
    inner = RT.pypi_inner_root(listing)
    low = F.lower(F.col("rel_path"))
    kind = None
    for i, suf in enumerate(PYPI_ARCHIVE_ORDER):
        cond = low.endswith(suf)
        kind = F.when(cond, F.lit(i)) if kind is None else kind.when(cond, F.lit(i))
    direct = F.when(F.instr("rel_path", "/") == 0, kind)
    return (inner.groupBy("package", "version")
            .agg(F.bool_or(F.col("rel_path").endswith(".py")).alias("_py"),
                 F.min(F.when(direct.isNotNull(), F.struct(direct.alias("k"), F.col("rel_path").alias("r"), F.col("path").alias("p")))).alias("_a"))
            .where(~F.col("_py") & F.col("_a").isNotNull())
            .select("package", "version", F.col("_a.p").alias("path")))


def pypi_file_features(files: DataFrame, from_imports: bool = True, max_tokens: int = DEFAULT_MAX_TOKENS,
                       read: Read | None = None, expand: Expand | None = None) -> DataFrame:
    """E2 representative file per version, with its features."""
    listing = files.drop("content")
    own = _features(files, lambda rows: FL.representative_python(RT.pypi_inner_root(listing, rows)),
                    lambda rows: _py_features(rows, from_imports, max_tokens), read)
    if expand is None:
        return own
    members = expand(pypi_archive_choice(listing)).where("error is null and member is not null").withColumnRenamed("member", "rel_path")
    packed = FL.representative_python(_py_features(members, from_imports, max_tokens).withColumn("from_archive", F.lit(True)))
    cols = ["package", "version", "rel_path", "tier", "imports", "calls", "url_count", "b64_count", "has_eval_exec"]
    return own.select(*cols).unionByName(packed.select(*cols))


def pypi_descriptions(labels: DataFrame, files: DataFrame, found: DataFrame | None = None,
                      read: Read | None = None, expand: Expand | None = None, **kw) -> DataFrame:
    """L2 (PyPI): label rows → (package, version, textual_description, label).

    With ``expand`` a version without Python files at its inner root falls back
    to its first archive's members (A10).
    """
    feats = pypi_file_features(files, read=read, expand=expand, **kw)
    if found is None:
        found = files.select("package", "version").distinct()
    rows = (labels.select("package", "version", "label")
            .join(found.withColumn("_found", F.lit(True)), ["package", "version"], "left")
            .join(feats, ["package", "version"], "left"))
    return rows.select("package", "version", *_pypi_text_cols())


@cached_columns
def _pypi_text_cols():
    ident = F.concat(F.col("version"), F.lit("/"), F.col("rel_path"))
    text = (F.when(F.col("_found").isNull(),
                   EV.fixed_sentence(F.col("package"), F.col("version"), NO_SOURCE))
            .when(F.col("rel_path").isNull(),
                  EV.fixed_sentence(F.col("package"), F.col("version"), NO_PY))
            .otherwise(PY.pypi_sentence(F.col("package"), ident, F.col("imports"), F.col("calls"),
                                        F.col("has_eval_exec"), F.col("url_count"),
                                        F.col("b64_count"))))
    return text.alias("textual_description"), F.col("label").cast("int").alias("label")


# --------------------------------------------------------------------------- RubyGems

def _rb_features(rows: DataFrame, max_tokens: int) -> DataFrame:
    text = FL.ruby_candidates(rows).withColumn("text", EV.decode_text(F.col("content")))
    return RB.ruby_features(text, "text", 1, max_tokens).drop("content", "text")


def gem_choice(listing: DataFrame) -> DataFrame:
    """(package, version, path) of the first ``.gem`` directly in the version
    directory of versions without a ``*.src`` directory."""
    first = F.split(F.col("rel_path"), "/")[0]
    inside = F.instr("rel_path", "/") > 0
    gem = F.when(~inside & F.col("rel_path").endswith(".gem"), F.struct(F.col("rel_path").alias("r"), F.col("path").alias("p")))
    return (listing.groupBy("package", "version")
            .agg(F.bool_or(inside & first.endswith(".src")).alias("_src"), F.min(gem).alias("_g"))
            .where(~F.col("_src") & F.col("_g").isNotNull()).select("package", "version", F.col("_g.p").alias("path")))


def ruby_file_features(files: DataFrame, max_tokens: int = DEFAULT_MAX_TOKENS, read: Read | None = None,
                       expand: Expand | None = None) -> DataFrame:
    """E3 representative file per version, with its features: from the ``*.src``
    directory, else from the ``.gem`` (if it can be read), else from the version."""
    listing = files.drop("content")
    packed = None
    if expand is not None:
        # archives are opened once: what the two sides below need is one narrow row per version
        got = expand(gem_choice(listing)).withColumnRenamed("member", "rel_path")
        text = F.when(F.col("error").isNull(), EV.decode_text(F.col("content")))
        rows = RB.ruby_features(got.withColumn("text", text), "text", 1, max_tokens).drop("content", "text")
        packed = SP._stored(FL.representative_members(rows).where("not broken"), "gem-features")

    def choose(rows):
        rows = RT.ruby_inner_root(listing, rows)
        return FL.representative_ruby(rows if packed is None else rows.join(packed.where("opened").select("package", "version"), ["package", "version"], "left_anti"))

    own = _features(files, choose, lambda rows: _rb_features(rows, max_tokens), read)
    if packed is None:
        return own
    packed = packed.where("rel_path is not null")
    cols = ["package", "version", "rel_path", "tier", "requires", "calls", "url_count", "b64_count", "has_eval_exec"]
    return own.select(*cols).unionByName(packed.select(*cols))


def ruby_descriptions(versions: DataFrame, files: DataFrame, **kw) -> DataFrame:
    """L2 (RubyGems): labelled versions (from the roots) → sentences.

    Every labelled version has a directory (that is where its label came
    from); a version without a Ruby file gets "no ruby file".
    """
    feats = ruby_file_features(files, **kw)
    rows = versions.select("package", "version", "label").join(feats, ["package", "version"], "left")
    return rows.select("package", "version", *_ruby_text_cols())


@cached_columns
def _ruby_text_cols():
    ident = F.concat(F.col("version"), F.lit("/"), F.col("rel_path"))
    text = F.when(F.col("rel_path").isNull(),
                  EV.fixed_sentence(F.col("package"), F.col("version"), NO_RUBY)).otherwise(
        RB.ruby_sentence(F.col("package"), ident, F.col("requires"), F.col("calls"),
                         F.col("has_eval_exec"), F.col("url_count"), F.col("b64_count")))
    return text.alias("textual_description"), F.col("label").cast("int").alias("label")
