"""Evidence scalars shared by the three registries.

All are Column functions that stay inside the JVM (whole-stage codegen or
higher-order functions); none needs a Python worker.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Evidence patterns (same text as the reference's, with (?U) so
# Java's \b and \w follow Unicode as Python's do on str patterns).
URL_PATTERN = r"(?iU)(https?://|\burl\b)"
B64_PATTERN = r"(?U)\b[A-Za-z0-9+/]{24,}={0,2}\b"
MAX_B64_PHRASES = 4
NO_BEHAVIOR = "no notable behavior"
# ---------------------------------------------------------------------------


def decode_text(content: Column) -> Column:
    """Bytes or string → valid UTF-8 text with bad bytes deleted.

    ``make_valid_utf8`` puts U+FFFD where bytes are invalid; deleting it
    matches Python's ``decode('utf-8', 'ignore')`` (a genuine U+FFFD in the
    source is deleted too).
    """
    return F.regexp_replace(F.make_valid_utf8(content.cast("binary")), "\ufffd", "")


def url_count(text: Column) -> Column:
    """Whole-text URL evidence count (non-overlapping matches)."""
    return F.regexp_count(text, F.lit(URL_PATTERN)).cast("bigint")


def b64_count(text: Column) -> Column:
    """Whole-text base64-run count (non-overlapping matches)."""
    return F.regexp_count(text, F.lit(B64_PATTERN)).cast("bigint")


def module_base(imp: Column) -> Column:
    """Text before the first '/' (a scoped ``@x/y`` also reduces to ``@x``)."""
    return F.substring_index(imp, "/", 1)


def ruby_base(req: Column) -> Column:
    """The first two '/' segments, or the single segment."""
    return F.substring_index(req, "/", 2)


def base64_phrases(n: Column) -> Column:
    """G9: 'use base64 string' repeated min(4, n) times (empty when n <= 0)."""
    k = F.greatest(F.least(n, F.lit(MAX_B64_PHRASES)), F.lit(0)).cast("int")
    return F.array_repeat(F.lit("use base64 string"), k)


def flag_phrase(cond: Column, phrase: str) -> Column:
    """A one- or zero-element array: [phrase] when cond holds."""
    return F.when(F.coalesce(cond, F.lit(False)), F.array(F.lit(phrase))).otherwise(
        F.array().cast("array<string>"))


def sentence(package: Column, ident: Column, parts: Column) -> Column:
    """Sentence grammar shared by all registries (G10):
    ``start entry {pkg}/{id}, {part, part, ...}, end of entry``."""
    middle = F.when(F.size(parts) > 0, F.array_join(parts, ", ")).otherwise(F.lit(NO_BEHAVIOR))
    return F.concat(F.lit("start entry "), package, F.lit("/"), ident,
                    F.lit(", "), middle, F.lit(", end of entry"))


def fixed_sentence(package: Column, ident: Column, middle: str) -> Column:
    """The sentence for a version with no usable file."""
    return F.concat(F.lit("start entry "), package, F.lit("/"), ident,
                    F.lit(f", {middle}, end of entry"))
