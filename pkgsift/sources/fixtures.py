"""Derived fixtures: package-shaped tables built from the driver's tables.

The driver's tables hold prose, not packages.  These frames put the
shapes the engine consumes on top of them (see FIXTURES.md):

* ``code_files``   – one source file per document: ecosystem, package,
                     version, path, content (a behaviour snippet + the
                     document's text made ASCII).  12 documents per package,
                     4 per version, one of four paths each.
* ``npm_files``    – the npm files of ``code_files`` plus manifests, ``.ts`` files
                     and versions with 34 files, also derived row by row.
* ``archives``     – one archive per package version (tar.gz, zip or gem) of its
                     ``code_files``, built in the tasks.
* ``package_info`` – one review row per ``labels`` row: name, version,
                     threat_type (messy tags, nulls, conflicting duplicates).

Both grow linearly with the tables they are derived from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pkgsift.functions.colcache import cached_columns

# ---------------------------------------------------------------------------
# Snippets per ecosystem, indexed by doc_id % 11 (FIXTURES.md §3).
PYPI_SNIPPETS = [
    'import os, base64 ; os.system("curl http://x.example/a") ; ',
    'import subprocess ; subprocess.Popen("ls") ; subprocess.run("id") ; ',
    'eval(input()) ; ',
    'import requests as r ; x = "QUJDREVGR0hJSktMTU5PUFFSU1RVVldYWVo" ; ',
    '',
    'import os, \\\n  sys ; os\\\n                .system("id") ; ',
    'eval                    ("1") ; a.b.c.d.e.f.g.h.i.j.k.l.m.n.o.p.q.r.s.t.run("x") ; ',
    'import socket, \\\n  http.client as h ; def exec(x): return x ; ', 'x = "eval(1)" ; ', 'import sys ; obj.eval("x") ; ', '',
]
NPM_SNIPPETS = [
    'const cp = require("child_process"); cp.exec("curl http://x.example/a"); ',
    'import { spawn as sp } from "child_process"; sp("ls"); ',
    'eval("1+1"); ',
    'import ax from "axios"; var k = "QUJDREVGR0hJSktMTU5PUFFSU1RVVldYWVo"; ',
    '',
    'const cp = require("child_process"); cp\n                    .exec("ls"); import "fs/promises"; ',
    'function* eval(x) { } ; a.b.c.d.e.f.g.h.i.j.k.l.m.n.o.p.q.r.s.t.run("x"); ',
    'const util = require("child_process");\nexec("ls"); ',
    'exec(a, (b), require("child_process")); ',
    'class A { eval(x) { return (x) } get exec() { return 1 } } ',
    'require("child_process").spawn("ls"); ',
]
# those of them whose call has no module but names child_process in its own text
NPM_NAMES_CHILD_PROCESS = [NPM_SNIPPETS[8], NPM_SNIPPETS[10]]
RUBY_SNIPPETS = [
    'require "net/http" ; system("curl http://x.example/a") ; ',
    'require "open3" ; Open3.popen3("ls") ; ',
    'instance_eval("1") ; ',
    'require "base64" ; k = "QUJDREVGR0hJSktMTU5PUFFSU1RVVldYWVo" ; ',
    '',
    'require "fileutils" ; spawn                    ("x") ; ',
    'puts 1 ; ', 'class_eval("x") ; ', 'require "socket" ; ', 'exec("ls") ; ', '',
]
PATH_STEMS = ["src/main", "lib/index", "tests/case", "dist/index"]
ECOSYSTEMS = ["pypi", "npm", "rubygems"]
EXTENSIONS = [".py", ".js", ".rb"]
# package.json texts; the first two have an install hook (of equal keys the last counts)
MANIFESTS = [
    '{"scripts": {"postinstall": "node x"}}',
    '{"scripts": {"test": "x"}, "name": "a", "scripts": {"install": "y"}}',
    '{"scripts": {"install": "y"}, "name": "a", "scripts": {"test": "x"}}',
    '{"scripts": ["a"]}',
    '{"scripts": {"install": "y"',
    '{"name": "x"}',
    '[1]',
]
MANIFESTS_WITH_HOOK = MANIFESTS[:2]
TS_CONTENT = 'import fsp from "fs/promises"; import net from "net"; '
MORE_CONTENT = 'const h = require("https"); '
MORE_FILES = 30
# ---------------------------------------------------------------------------


def _pick(index: Column, values) -> Column:
    out = None
    for i, v in enumerate(values):
        out = (F.when(index == i, F.lit(v)) if out is None
               else out.when(index == i, F.lit(v)))
    return out


def _group() -> Column:
    return F.floor(F.col("doc_id") / F.lit(12.0)).cast("bigint")


def spread(df: DataFrame, key: str) -> DataFrame:
    """The driver's small tables are one row group each, which one task reads;
    deal their rows out by key so that lexing uses every core.  Real inputs come
    through ``tree.ingest``, which writes small row groups instead."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def code_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One source file per document (see module doc)."""
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), "doc_id")
    return docs.select(*_code_file_cols())


@cached_columns
def _code_file_cols():
    g = _group()
    eco_ix = g % 3
    snip_ix = F.col("doc_id") % len(NPM_SNIPPETS)
    snippet = (F.when(eco_ix == 0, _pick(snip_ix, PYPI_SNIPPETS))
               .when(eco_ix == 1, _pick(snip_ix, NPM_SNIPPETS))
               .otherwise(_pick(snip_ix, RUBY_SNIPPETS)))
    ascii_text = F.regexp_replace(F.col("text"), "[^ -~]", " ")
    return (
        F.col("doc_id"),
        _pick(eco_ix, ECOSYSTEMS).alias("ecosystem"),
        F.concat(F.lit("pkg-"), g.cast("string")).alias("package"),
        F.concat(F.lit("1."), F.floor((F.col("doc_id") % 12) / F.lit(4.0)).cast("bigint")
                 .cast("string")).alias("version"),
        F.concat(_pick(F.col("doc_id") % 4, PATH_STEMS), _pick(eco_ix, EXTENSIONS)).alias("path"),
        F.concat(snippet, ascii_text).alias("content"),
    )


def source_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``code_files`` in the ingest table's shape:
    (ecosystem, package, version, rel_path, size, content)."""
    return code_files(spark, sf_dir).select(
        "ecosystem", "package", "version",
        F.col("path").alias("rel_path"),
        F.length("content").cast("bigint").alias("size"),
        "content")


def npm_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(package, version, rel_path, size, content) of npm: code, manifests, ``.ts``
    files, and for some versions 30 files more."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id").where(_group() % 3 == 1)
    g, d = _group(), F.col("doc_id")
    key = (F.concat(F.lit("pkg-"), g.cast("string")).alias("package"),
           F.concat(F.lit("1."), F.floor((d % 12) / F.lit(4.0)).cast("bigint").cast("string")).alias("version"))
    manifests = docs.where(d % 4 == 0).select(*key, F.lit("package.json").alias("rel_path"),
                                               _pick(F.floor(d / 4) % len(MANIFESTS), MANIFESTS).alias("content"))
    ts = docs.where(d % 4 == 1).select(*key, F.lit("src/extra.ts").alias("rel_path"), F.lit(TS_CONTENT).alias("content"))
    more = (docs.where(d % 36 == 12).select(*key, F.explode(F.sequence(F.lit(0), F.lit(MORE_FILES - 1))).alias("i"))
            .select("package", "version", F.concat(F.lit("lib/more/f"), F.col("i").cast("string"), F.lit(".js")).alias("rel_path"),
                    F.concat(F.lit(MORE_CONTENT), F.repeat(F.lit("x"), F.col("i"))).alias("content")))
    extra = manifests.unionByName(ts).unionByName(more).withColumn("size", F.length("content").cast("bigint"))
    code = source_files(spark, sf_dir).where("ecosystem = 'npm'").drop("ecosystem")
    return code.unionByName(extra)


# archive kind of a version: 1.0, 1.1, 1.2 of PyPI packages; gems for RubyGems
PYPI_ARCHIVES = {"1.0": ".tar.gz", "1.1": ".zip", "1.2": ".tgz"}


def archives(spark: SparkSession, sf_dir: str, ecosystem: str) -> DataFrame:
    """(package, version, path, bytes): every package version of ``code_files`` as
    one archive, its files below ``package-version/`` (PyPI) or at the top (gem)."""
    import pandas as pd

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        import io
        import tarfile
        import zipfile

        def tar(files, mode):
            out = io.BytesIO()
            with tarfile.open(fileobj=out, mode=mode) as t:
                for name, body in files:
                    info = tarfile.TarInfo(name)
                    info.size = len(body)
                    t.addfile(info, io.BytesIO(body))
            return out.getvalue()

        package, version = pdf["package"].iloc[0], pdf["version"].iloc[0]
        stem = f"{package}-{version}"
        files = sorted((p if ecosystem == "rubygems" else f"{stem}/{p}", c.encode()) for p, c in zip(pdf["path"], pdf["content"]))
        if ecosystem == "rubygems":
            kind, data = ".gem", tar([("metadata.gz", b""), ("data.tar.gz", tar(files, "w:gz"))], "w")
        else:
            kind = PYPI_ARCHIVES[version]
            if kind == ".zip":
                out = io.BytesIO()
                with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
                    for name, body in files:
                        z.writestr(name, body)
                data = out.getvalue()
            else:
                data = tar(files, "w:gz")
        return pd.DataFrame([(package, version, f"{package}/{version}/{stem}{kind}", data)], columns=["package", "version", "path", "bytes"])

    # at most four files per version by construction
    code = code_files(spark, sf_dir).where(F.col("ecosystem") == ecosystem).where("content is not null")
    return (code.select("package", "version", "path", "content").groupBy("package", "version")
            .applyInPandas(build, "package string, version string, path string, bytes binary"))


def damaged_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The PyPI ``archives``, damaged: in 1.0 the second member's header is no header
    any more, 1.1 has lost its directory, and 1.2 ends in the middle of its last member."""
    import pandas as pd

    def damage(batches):
        import gzip
        import io
        import tarfile

        for pdf in batches:
            out = []
            for version, data in zip(pdf["version"], pdf["bytes"]):
                if version == "1.1":
                    out.append(data[:data.index(b"PK\x01\x02")])
                    continue
                raw = bytearray(gzip.decompress(data))
                members = tarfile.open(fileobj=io.BytesIO(bytes(raw))).getmembers()
                if version == "1.0" and len(members) > 1:
                    raw[members[1].offset + 148] = ord("x")  # the checksum field
                if version == "1.2":
                    raw = raw[:members[-1].offset_data + members[-1].size // 2] if members[-1].size > 1 else raw
                out.append(gzip.compress(bytes(raw)))
            yield pdf.assign(bytes=pd.Series(out, index=pdf.index, dtype=object))

    return archives(spark, sf_dir, "pypi").mapInPandas(damage, "package string, version string, path string, bytes binary")


def package_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One review row per ``labels`` row: name, version, threat_type."""
    lab = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return lab.select(*_package_info_cols())


@cached_columns
def _package_info_cols():
    g = _group()
    threat = (F.when(F.col("toxic") == 1, F.lit(" Confirmed-Malware"))
              .when(F.col("quality") == 0, F.lit("un_reviewed"))
              .when(F.col("doc_id") % 11 == 0, F.lit("adware"))
              .when(F.col("doc_id") % 13 == 0, F.lit(None).cast("string"))
              .otherwise(F.lit("False Positive ")))
    return (
        F.concat(F.lit("pkg-"), g.cast("string")).alias("name"),
        F.concat(F.lit("1."), F.floor((F.col("doc_id") % 12) / F.lit(4.0)).cast("bigint")
                 .cast("string")).alias("version"),
        threat.alias("threat_type"))


# DuckDB text of the same fixtures, used as CTEs by the oracle SQL.
def _sql_case(expr: str, values) -> str:
    whens = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values[:-1]))
    return f"CASE {expr} {whens} ELSE '{values[-1]}' END"


_G = "CAST(floor(doc_id/12.0) AS BIGINT)"
CODE_FILES_SQL = f"""code_files AS (
  SELECT doc_id,
    {_sql_case(f'{_G} % 3', ECOSYSTEMS)} AS ecosystem,
    concat('pkg-', CAST({_G} AS VARCHAR)) AS package,
    concat('1.', CAST(CAST(floor((doc_id % 12)/4.0) AS BIGINT) AS VARCHAR)) AS version,
    concat({_sql_case('doc_id % 4', PATH_STEMS)}, {_sql_case(f'{_G} % 3', EXTENSIONS)}) AS path,
    concat(CASE {_G} % 3
             WHEN 0 THEN {_sql_case('doc_id % 11', PYPI_SNIPPETS)}
             WHEN 1 THEN {_sql_case('doc_id % 11', NPM_SNIPPETS)}
             ELSE {_sql_case('doc_id % 11', RUBY_SNIPPETS)} END,
           regexp_replace(text, '[^ -~]', ' ', 'g')) AS content
  FROM documents)"""

SOURCE_FILES_SQL = CODE_FILES_SQL + """,
source_files AS (
  SELECT ecosystem, package, version, path AS rel_path,
         CAST(length(content) AS BIGINT) AS size, content
  FROM code_files)"""

NPM_FILES_SQL = f"""npm_docs AS (
  SELECT doc_id, concat('pkg-', CAST({_G} AS VARCHAR)) AS package,
         concat('1.', CAST(CAST(floor((doc_id % 12)/4.0) AS BIGINT) AS VARCHAR)) AS version
  FROM documents WHERE {_G} % 3 = 1),
npm_rows AS (
  SELECT package, version, path AS rel_path, content FROM code_files WHERE ecosystem = 'npm'
  UNION ALL SELECT package, version, 'package.json', {_sql_case(f'CAST(floor(doc_id / 4) AS BIGINT) % {len(MANIFESTS)}', MANIFESTS)}
  FROM npm_docs WHERE doc_id % 4 = 0
  UNION ALL SELECT package, version, 'src/extra.ts', '{TS_CONTENT}' FROM npm_docs WHERE doc_id % 4 = 1
  UNION ALL SELECT package, version, 'lib/more/f' || i || '.js', '{MORE_CONTENT}' || repeat('x', CAST(i AS INTEGER))
  FROM npm_docs, range({MORE_FILES}) r(i) WHERE doc_id % 36 = 12)"""

PACKAGE_INFO_SQL = f"""package_info AS (
  SELECT concat('pkg-', CAST({_G} AS VARCHAR)) AS name,
         concat('1.', CAST(CAST(floor((doc_id % 12)/4.0) AS BIGINT) AS VARCHAR)) AS version,
         CASE WHEN toxic = 1 THEN ' Confirmed-Malware' WHEN quality = 0 THEN 'un_reviewed'
              WHEN doc_id % 11 = 0 THEN 'adware' WHEN doc_id % 13 = 0 THEN NULL
              ELSE 'False Positive ' END AS threat_type
  FROM labels)"""
