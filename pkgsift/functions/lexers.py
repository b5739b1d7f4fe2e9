"""Scans of source text as Spark columns.

Brackets nest to any depth and the meaning of a character depends on what is
open around it, which regular expressions and array functions cannot express in
linear time.  So one small pass per language (``scan_js``, ``scan_python``,
``scan_ruby``) runs over each text in Arrow batches and returns the calls, import
statements and evidence counts as one struct; aliases, flags and sentences are
built from it by column expressions.  Each text crosses to Python once and
never comes back.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable, Iterable
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pkgsift.functions import scan_js, scan_python, scan_ruby
from pkgsift.session import bound_arrow_batches, ship_package

# ---------------------------------------------------------------------------
# The evidence patterns, as the reference has them, and the module that a
# call without one may name in its own text.
URL_PATTERN = re.compile(r"(https?://|\burl\b)", re.I)
B64_PATTERN = re.compile(r"\b[A-Za-z0-9+/]{24,}={0,2}\b")
PROCESS_MODULE = re.compile("child_process", re.I | re.A)
# Bare heads that are statements or keywords, not calls.
PYTHON_KEYWORDS = ["and", "as", "assert", "async", "await", "del", "elif", "else", "except",
                   "for", "from", "global", "if", "import", "in", "is", "lambda", "nonlocal",
                   "not", "or", "pass", "raise", "return", "while", "with", "yield"]
JS_KEYWORDS = ["if", "for", "while", "switch", "catch", "function", "return", "typeof",
               "import", "super", "with", "await", "void", "in", "of", "instanceof", "do",
               "else", "case", "throw", "yield", "delete", "new"]
# ---------------------------------------------------------------------------
# Whole texts by default: 0 means no cap.  A positive value reads only the
# first ``max_tokens`` tokens, an opt-in stand-in for the reference's parse
# budget (tokens are not tree nodes, so it is never an exact match).
DEFAULT_MAX_TOKENS = 0

_COUNTS = [T.StructField("urls", T.LongType()), T.StructField("b64", T.LongType())]
_CALL = T.StructType([T.StructField("base", T.StringType()), T.StructField("func", T.StringType())])
JS_SCAN = T.StructType([
    T.StructField("calls", T.ArrayType(T.StructType([*_CALL.fields, T.StructField("start", T.IntegerType()), T.StructField("stop", T.IntegerType()),
                                                     T.StructField("mentions", T.BooleanType())]))),
    T.StructField("broken", T.BooleanType()), *_COUNTS])
PYTHON_SCAN = T.StructType([T.StructField("imports", T.ArrayType(T.StringType())), T.StructField("calls", T.ArrayType(_CALL)), *_COUNTS])
RUBY_SCAN = T.StructType(_COUNTS)


def holding(spans: Iterable[tuple[int, int]], places: list[tuple[int, int]]) -> list[bool]:
    """Whether each span holds one of the ``places`` (ascending, apart from each other) whole."""
    starts = [a for a, _ in places]

    def holds(low: int, high: int) -> bool:
        k = bisect_left(starts, low)
        return k < len(places) and places[k][1] <= high

    return [holds(low, high) for low, high in spans] if places else [False] * len(list(spans))


def _places(pattern: re.Pattern[str], text: str) -> list[tuple[int, int]]:
    return [m.span() for m in pattern.finditer(text)]


def _lists(rows: list[list[tuple]], kind: T.StructType) -> pa.Array:
    """One list of structs per row, from tuples in the order of the struct's fields."""
    from pyspark.sql.pandas.types import to_arrow_type

    offsets = [0]
    for row in rows:
        offsets.append(offsets[-1] + len(row))
    columns = list(zip(*(x for row in rows for x in row))) or [()] * len(kind.fields)
    fields = [pa.array(c, to_arrow_type(f.dataType)) for c, f in zip(columns, kind.fields)]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(fields, [f.name for f in kind.fields]))


def _counts(scan, text: str) -> tuple[int, int]:
    """Literals that hold a URL, and literals that hold a base64 run."""
    if not scan.literals:
        return 0, 0
    urls = _places(URL_PATTERN, text) if "://" in text or "url" in text.lower() else []  # what every match holds
    return tuple(sum(holding(scan.literals, places)) for places in (urls, _places(B64_PATTERN, text)))


def _struct(kind: T.StructType, columns: list[pa.Array]) -> pa.Array:
    return pa.StructArray.from_arrays(columns, [f.name for f in kind.fields])


def _count_arrays(found: list[tuple[int, int]]) -> list[pa.Array]:
    return [pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)]


@lru_cache(maxsize=None)
def _js(limit: int) -> Callable[..., Column]:
    def scan(texts: pa.Array, typed: pa.Array) -> pa.Array:
        calls, broken, counts = [], [], []
        for text, ts in zip(texts, typed):
            text = text.as_py() or ""
            s = scan_js.Scan(text, bool(ts.as_py()), limit)
            spans = [c[3:5] for c in s.calls]
            calls.append([(base, func, a, b, own) for (_, base, func, a, b), own in zip(s.calls, holding(spans, _places(PROCESS_MODULE, text) if spans else []))])
            broken.append(s.broken)
            counts.append(_counts(s, text))
        return _struct(JS_SCAN, [_lists(calls, JS_SCAN["calls"].dataType.elementType), pa.array(broken, pa.bool_()), *_count_arrays(counts)])

    return F.arrow_udf(scan, JS_SCAN)


@lru_cache(maxsize=None)
def _python(limit: int) -> Callable[..., Column]:
    def scan(texts: pa.Array) -> pa.Array:
        imports, calls, counts = [], [], []
        for text in texts:
            text = text.as_py() or ""
            s = scan_python.Scan(text, limit)
            imports.append(s.imports)
            calls.append([c[1:] for c in s.calls])
            counts.append(_counts(s, text))
        return _struct(PYTHON_SCAN, [pa.array(imports, pa.list_(pa.string())), _lists(calls, _CALL), *_count_arrays(counts)])

    return F.arrow_udf(scan, PYTHON_SCAN)


@lru_cache(maxsize=None)
def _ruby(limit: int) -> Callable[..., Column]:
    def scan(texts: pa.Array) -> pa.Array:
        return _struct(RUBY_SCAN, _count_arrays([_counts(scan_ruby.Scan(t, limit), t) for t in (x.as_py() or "" for x in texts)]))

    return F.arrow_udf(scan, RUBY_SCAN)


def js_scan(text: Column, typed: Column, max_tokens: int = DEFAULT_MAX_TOKENS) -> Column:
    """calls (base, func, start, stop, mentions), broken, urls, b64 of JavaScript, or of TypeScript where ``typed``.

    ``start`` and ``stop`` bound the whole call, what it is chained to included, in
    characters; ``mentions`` says that this text names child_process.  A null text is empty."""
    return _js(max_tokens)(text, typed)


def python_scan(text: Column, max_tokens: int = DEFAULT_MAX_TOKENS) -> Column:
    """imports (statements), calls (base, func), urls, b64 of Python.  A null text is empty."""
    return _python(max_tokens)(text)


def ruby_scan(text: Column, max_tokens: int = DEFAULT_MAX_TOKENS) -> Column:
    """urls and b64 of Ruby.  A null text is empty."""
    return _ruby(max_tokens)(text)


def ready(df: DataFrame) -> None:
    """Before a scan: the workers have this package, and batches of whole files stay small."""
    ship_package(df.sparkSession)
    bound_arrow_batches(df.sparkSession)
