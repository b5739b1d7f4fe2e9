"""Registered queries over snippets whose answers are known.

The oracle SQL joins each document with the hand-written answer of its snippet;
it restates no lexer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pkgsift.functions import js_features as JS
from pkgsift.functions import python_features as PY
from pkgsift.functions import ruby_features as RB
from pkgsift.sources import snippets as SN


def _text(x) -> str:
    return "'" + x.replace("'", "''") + "'" if isinstance(x, str) else str(x).lower() if isinstance(x, bool) else str(x)


def _cases(names: str, rows: list[tuple]) -> str:
    return f"WITH c({names}) AS (VALUES {', '.join('(' + ', '.join(map(_text, r)) + ')' for r in rows)})"


def _mixed(calls) -> str:
    return "|".join(f"{c[0]}:{c[1]}" for c in calls)


def _calls(column: str):
    return F.array_join(F.transform(column, lambda c: F.concat(c["mod"], F.lit(":"), c["func"])), "|")


def _js_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = SN.snippet_files(spark, sf_dir, [c[1] for c in SN.JS_CASES])
    return files.withColumn("path", F.element_at(F.array(*(F.lit(c[0]) for c in SN.JS_CASES)), F.col("case_no") + 1))


def js_snippets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls, flags and literal counts of context-dependent JavaScript and TypeScript."""
    f = JS.js_features(_js_files(spark, sf_dir), "text", None, path_col="path")
    return f.select("doc_id", _calls("calls").alias("calls"), "has_eval_exec", "calls_os", "calls_proc", "url_count", "b64_count")


_JS_SNIPPETS = f"""{_cases("k, calls, has_eval_exec, calls_os, calls_proc, url_count, b64_count", [
    (k, _mixed(c), "e" in f, "o" in f, "p" in f, u, b) for k, (_, _, f, u, b, c) in enumerate(SN.JS_CASES)])}
SELECT doc_id, calls, has_eval_exec, calls_os, calls_proc, CAST(url_count AS BIGINT) AS url_count, CAST(b64_count AS BIGINT) AS b64_count
FROM documents JOIN c ON doc_id % {len(SN.JS_CASES)} = k"""

#: Cases whose call texts hold no text of the document.
_PLAIN = [k for k, c in enumerate(SN.JS_CASES) if all(t is not None for *_, t in c[5])]


def js_call_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole text of every call, at any depth of brackets."""
    files = _js_files(spark, sf_dir).where(F.col("case_no").isin(_PLAIN))
    return JS.js_call_texts(files, "text", "path").select("doc_id", F.col("call_index").cast("int").alias("call_index"), "mod", "func", "call_text")


_JS_CALL_TEXT = f"""{_cases("k, call_index, mod, func, call_text", [(k, i, *c) for k in _PLAIN for i, c in enumerate(SN.JS_CASES[k][5])])}
SELECT doc_id, CAST(call_index AS INTEGER) AS call_index, mod, func, call_text FROM documents JOIN c ON doc_id % {len(SN.JS_CASES)} = k"""


def js_broken_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files whose brackets, literals or comments don't close take the fallback patterns as well."""
    files = SN.snippet_files(spark, sf_dir, [c[0] for c in SN.BROKEN_CASES])
    return JS.js_features(files, "text", None, lenient="broken").select("doc_id", "has_eval_exec")


_JS_BROKEN = f"""{_cases("k, has_eval_exec", [(k, c[2]) for k, c in enumerate(SN.BROKEN_CASES)])}
SELECT doc_id, has_eval_exec FROM documents JOIN c ON doc_id % {len(SN.BROKEN_CASES)} = k"""


def python_snippets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Imports, calls and literal counts of Python with nested f-strings."""
    f = PY.python_features(SN.snippet_files(spark, sf_dir, [c[0] for c in SN.PYTHON_CASES]), "text")
    # a literal that holds the document's own text has no fixed count
    count = F.when(F.col("case_no").isin([k for k, c in enumerate(SN.PYTHON_CASES) if c[2] is None]), F.lit(-1)).otherwise(F.col("url_count"))
    return f.select("doc_id", F.array_join("imports", ",").alias("imports"), _calls("calls").alias("calls"), "has_eval_exec", count.cast("bigint").alias("url_count"))


_PYTHON_SNIPPETS = f"""{_cases("k, imports, calls, has_eval_exec, url_count", [
    (k, ",".join(i), _mixed(c), e, -1 if u is None else u) for k, (_, e, u, i, c) in enumerate(SN.PYTHON_CASES)])}
SELECT doc_id, imports, calls, has_eval_exec, CAST(url_count AS BIGINT) AS url_count FROM documents JOIN c ON doc_id % {len(SN.PYTHON_CASES)} = k"""


def ruby_snippets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Literal counts of Ruby with percent literals, heredocs and interpolation."""
    f = RB.ruby_features(SN.snippet_files(spark, sf_dir, [c[0] for c in SN.RUBY_CASES]), "text")
    return f.select("doc_id", "url_count", "b64_count")


_RUBY_SNIPPETS = f"""{_cases("k, url_count, b64_count", [(k, u, b) for k, (_, u, b) in enumerate(SN.RUBY_CASES)])}
SELECT doc_id, CAST(url_count AS BIGINT) AS url_count, CAST(b64_count AS BIGINT) AS b64_count FROM documents JOIN c ON doc_id % {len(SN.RUBY_CASES)} = k"""

QUERIES = {f.__name__: f for f in (js_snippets, js_call_text, js_broken_files, python_snippets, ruby_snippets)}
ORACLES = {"js_snippets": _JS_SNIPPETS, "js_call_text": _JS_CALL_TEXT, "js_broken_files": _JS_BROKEN,
           "python_snippets": _PYTHON_SNIPPETS, "ruby_snippets": _RUBY_SNIPPETS}
