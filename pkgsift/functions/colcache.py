"""Reuse of parameter-only Column expressions.

Building a large expression tree costs one JVM round trip per node.  The
feature and sentence expressions depend only on column names and constants,
so each distinct parameter set is built once per JVM and reused by every
later plan (a Column is an unresolved expression; reusing it is safe).
"""

from __future__ import annotations

import functools

from pyspark import SparkContext


def cached_columns(fn):
    cache: dict = {}

    @functools.wraps(fn)
    def wrap(*args, **kw):
        key = (id(SparkContext._gateway), args, tuple(sorted(kw.items())))
        hit = cache.get(key)
        if hit is None:
            hit = cache[key] = fn(*args, **kw)
        return hit

    wrap.cache_clear = cache.clear
    return wrap


def apply_stages(df, stages, drop=()):
    """Apply ``[{name: Column}, ...]`` with one ``withColumns`` per stage, then drop."""
    for stage in stages:
        df = df.withColumns(stage)
    return df.drop(*drop) if drop else df
