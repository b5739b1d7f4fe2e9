"""Package source trees (A6-A9): file listings and the ``source_files`` ingest.

A tree is ``{root}/{package}/{version}/...`` (with the layout variants that
``operators.roots`` resolves).

Spark's file index skips every name that starts with ``_`` or ``.``, so the
``binaryFile`` source cannot see ``__init__.py`` or ``.npmignore``.  The
listing is therefore a distributed walk: one level per step (root →
package directories → version directories → recursive walk of each version
directory), each step a ``mapInPandas`` over the previous step's
directories using ``pyarrow.fs`` (local, HDFS, S3, GCS …).  No step sends
the whole listing through the driver, and a package with many versions is
spread over tasks at the version level.

* ``walk``       – (path, is_dir, size) of every file and directory, walked once
  and written to the shared folder, for the jobs that read it several times.
* ``list_tree``  – (path, size) of the files, no bodies.
* ``read_files`` – adds ``content`` to listing rows, inside the tasks that need it.
* ``read_tree``  – (path, size, content) of a whole tree.

Many small files: ``ingest`` writes one Parquet table once, so later jobs
never walk or open the tree again.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pkgsift.functions.evidence import decode_text
from pkgsift.session import ship_package

ARCHIVE_SUFFIXES = (".tar.gz", ".tgz", ".tar", ".zip", ".whl", ".gem")


def _fs(root: str):
    import pyarrow.fs as pafs
    if "://" in root:
        return pafs.FileSystem.from_uri(root)
    import os
    return pafs.LocalFileSystem(), os.path.abspath(root)


def _children(base: str, recursive: bool) -> Iterator[pd.DataFrame]:
    """mapInPandas body: (dir) rows → (path, is_dir, size) of their entries, in
    frames of at most ``ENTRY_ROWS`` rows.  Directories below are walked one at a
    time, so no task holds a whole listing."""
    def fn(batches):
        import pyarrow.fs as pafs
        fs, root = _fs(base)
        for pdf in batches:
            todo, out = list(pdf["dir"]), []
            while todo:
                d = todo.pop()
                try:
                    infos = fs.get_file_info(pafs.FileSelector(f"{root}/{d}" if d else root))
                except (OSError, FileNotFoundError):
                    continue
                for info in infos:
                    rel = info.path[len(root) + 1:] if info.path.startswith(root + "/") else info.path
                    if info.type == pafs.FileType.Directory:
                        out.append((rel, True, None))
                        if recursive:
                            todo.append(rel)
                    elif info.type == pafs.FileType.File:
                        out.append((rel, False, int(info.size)))
                    if len(out) >= ENTRY_ROWS:
                        yield pd.DataFrame(out, columns=["path", "is_dir", "size"])
                        out = []
            yield pd.DataFrame(out, columns=["path", "is_dir", "size"])
    return fn


ENTRY_ROWS = 10_000
_ENTRY_SCHEMA = "path string, is_dir boolean, size bigint"


def _entries(spark: SparkSession, root: str, levels: int) -> DataFrame:
    ship_package(spark)
    n = max(spark.sparkContext.defaultParallelism, 1)
    dirs = spark.createDataFrame([("",)], "dir string")
    out = None
    for level in range(levels + 1):
        found = dirs.mapInPandas(_children(root, level == levels), _ENTRY_SCHEMA)
        out = found if out is None else out.unionByName(found)
        dirs = found.where("is_dir").select(F.col("path").alias("dir")).repartition(n * 4, "dir")
    return out


def walk(spark: SparkSession, root: str, levels: int = 2) -> DataFrame:
    """(path, is_dir, size) of every file and directory below ``root``.

    ``levels`` directory levels (package, version) are listed one step at a time
    and spread over tasks; below, a directory is walked in one task.  The walk is
    written once to the shared folder: file systems are slow to list, and the
    result must not change between two reads."""
    from pkgsift.sources.sinks import scratch_folder
    out = scratch_folder(spark, "walk")
    _entries(spark, root, levels).write.parquet(out)
    return spark.read.schema(_ENTRY_SCHEMA).parquet(out)


def list_tree(spark: SparkSession, root: str, glob: str | None = None,
              levels: int = 2) -> DataFrame:
    """(path relative to ``root``, size) of every regular file, hidden names included.

    ``glob`` is a file-name pattern (``*.py``; ``{a,b}`` alternation allowed).
    """
    files = _entries(spark, root, levels).where(~F.col("is_dir")).select("path", "size")
    if glob:
        files = files.where(F.element_at(F.split("path", "/"), -1).rlike(_glob_regex(glob)))
    return files


def _glob_regex(glob: str) -> str:
    out, i = [], 0
    while i < len(glob):
        c = glob[i]
        if c == "*":
            out.append("[^/]*")
        elif c == "?":
            out.append("[^/]")
        elif c == "{":
            j = glob.index("}", i)
            out.append("(?:" + "|".join(re.escape(a) for a in glob[i + 1:j].split(",")) + ")")
            i = j
        else:
            out.append(re.escape(c))
        i += 1
    return "^" + "".join(out) + "$"


BATCH_BYTES = 64 * 1024 * 1024   # bodies per Arrow batch handed back to the JVM


def _reader(base: str, columns: list[str]):
    """mapInPandas body: rows with ``path`` → the same rows with ``bytes``, yielded
    in batches of at most ~BATCH_BYTES so a task never holds many large files."""
    def fn(batches):
        fs, root = _fs(base)
        for pdf in batches:
            start, bodies, held = 0, [], 0
            for k, p in enumerate(pdf["path"]):
                try:
                    with fs.open_input_stream(f"{root}/{p}", compression=None) as f:
                        body = f.read()
                except OSError:
                    body = None   # unreadable → empty features downstream
                bodies.append(body)
                held += len(body) if body else 0
                if held >= BATCH_BYTES:
                    yield pdf.iloc[start:k + 1].assign(bytes=bodies)[[*columns, "bytes"]]
                    start, bodies, held = k + 1, [], 0
            if bodies:
                yield pdf.iloc[start:].assign(bytes=bodies)[[*columns, "bytes"]]
    return fn


def read_files(root: str, listing: DataFrame) -> DataFrame:
    """``listing`` rows (with ``path`` below ``root``) plus ``content``: bodies are
    read in the tasks and decoded in the JVM (A8); no join, no exchange."""
    ship_package(listing.sparkSession)
    kinds = ", ".join(f"`{c}` {t}" for c, t in listing.dtypes)
    raw = listing.mapInPandas(_reader(root, listing.columns), f"{kinds}, bytes binary")
    return raw.withColumn("content", decode_text(F.col("bytes"))).drop("bytes")


def read_tree(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """(path, size, content) of every file of a tree."""
    return read_files(root, list_tree(spark, root, glob).select("path", "size"))


def keyed_files(tree: DataFrame) -> DataFrame:
    """``pkg/ver/rest`` rows → (package, version, rel_path, path, ...) for the plain layout."""
    parts = F.split(F.col("path"), "/")
    return (tree.where(F.size(parts) >= 3)
            .select(parts[0].alias("package"), parts[1].alias("version"),
                    F.array_join(F.slice(parts, 3, 1 << 30), "/").alias("rel_path"),
                    *tree.columns))


def ingest(spark: SparkSession, root: str, ecosystem: str, out_path: str,
           mode: str = "append", row_group_bytes: int = 32 << 20,
           max_records_per_file: int = 100_000) -> None:
    """Write one registry's tree to the ``source_files`` Parquet table,
    partitioned by ecosystem: (ecosystem, path, size, content).

    A split reads whole row groups, and lexing costs far more per byte than
    reading, so row groups are kept small (``row_group_bytes``): later scans
    split the table into many CPU-sized tasks.  ``max_records_per_file``
    bounds each output file."""
    (read_tree(spark, root).withColumn("ecosystem", F.lit(ecosystem))
     .write.mode(mode).partitionBy("ecosystem")
     .option("parquet.block.size", str(row_group_bytes))
     .option("maxRecordsPerFile", str(max_records_per_file))
     .parquet(out_path))


ARCHIVE_GLOB = "*.{" + ",".join(s.lstrip(".") for s in ARCHIVE_SUFFIXES) + "}"


def archives(spark: SparkSession, root: str) -> DataFrame:
    """Archive files of a tree with their bytes: (path, size, bytes).

    Listed by the tree walk (hidden names included), filtered by name, and
    read inside the tasks, in bounded batches."""
    listing = list_tree(spark, root, ARCHIVE_GLOB).select("path", "size")
    return listing.mapInPandas(_reader(root, listing.columns), "path string, size bigint, bytes binary")
