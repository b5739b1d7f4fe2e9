"""Ruby file features and the RubyGems sentence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pkgsift.functions import evidence as EV
from pkgsift.functions.colcache import apply_stages, cached_columns
from pkgsift.functions import lexers as LX
from pkgsift.functions import phrases as PH
from pkgsift.functions.tags import strip_blanks

# ---------------------------------------------------------------------------
# The reference's Ruby patterns (cues run on the lower-cased
# text, comments included; quantifiers made possessive where that cannot
# change a match).
REQUIRE_PATTERN = r"""require(?:_relative)?\s*+(?:\(?\s*+['"]([^'"]++)['"]\s*+\)?)"""
CUE_PATTERNS = [
    ("system", r"(?U)\b(?:kernel\s*+\.\s*+)?system\s*+\("),
    ("exec", r"(?U)\b(?:kernel\s*+\.\s*+)?exec\s*+\("),
    ("spawn", r"(?U)\b(?:kernel\s*+\.\s*+)?spawn\s*+\("),
    ("open3.popen", r"(?U)\bopen3\s*+\.\s*+popen[23]?\b"),
    ("io.popen", r"(?U)\bio\s*+\.\s*+popen\b"),
]
EVAL_PATTERN = r"(?U)\b(?:eval|instance_eval|class_eval|module_eval)\s*+\("
BACKTICK_PATTERN = r"(?s)`[^`]+`|%x\{.*?\}|%x\([^\)]*\)|%x\[[^\]]*\]"
# ---------------------------------------------------------------------------


def requires(text: Column) -> Column:
    """Require / require_relative names, trimmed and lower-cased, sorted."""
    found = F.when(~F.contains(text, F.lit("require")), F.array().cast("array<string>")).otherwise(
        F.regexp_extract_all(text, F.lit(REQUIRE_PATTERN), F.lit(1)))
    return F.array_sort(F.array_distinct(F.transform(found, lambda r: F.lower(strip_blanks(r)))))


def cues(text: Column) -> Column:
    """G41 + G43: call cues in the reference's order (a backtick adds 'system')."""
    low = F.lower(text)
    # a cue's own last word is in the text before its pattern is tried
    found = [F.when(F.contains(low, F.lit(name.split(".")[-1])) & low.rlike(p), F.lit(name)) for name, p in CUE_PATTERNS]
    found.append(F.when((F.contains(text, F.lit("`")) | F.contains(text, F.lit("%x"))) & text.rlike(BACKTICK_PATTERN), F.lit("system")))
    return F.filter(F.array(*found), lambda c: c.isNotNull())


@cached_columns
def _rb_stages(text_col: str, literal_weight: int, max_tokens: int):
    text = F.col(text_col)
    scan = F.col("_scan")
    return [
        {"_scan": LX.ruby_scan(text, max_tokens)},
        {"requires": requires(text), "calls": cues(text),
         "has_eval_exec": F.contains(F.lower(text), F.lit("eval")) & F.lower(text).rlike(EVAL_PATTERN),
         "url_count": scan["urls"] * F.lit(literal_weight), "b64_count": scan["b64"] * F.lit(literal_weight)},
    ], ["_scan"]


def ruby_features(df: DataFrame, text_col: str = "text", literal_weight: int = 1,
                  max_tokens: int = LX.DEFAULT_MAX_TOKENS) -> DataFrame:
    """Add requires, calls (cues), has_eval_exec, url_count, b64_count."""
    LX.ready(df)
    stages, drop = _rb_stages(text_col, literal_weight, max_tokens)
    return apply_stages(df, stages, drop)


def _starts(key: str):
    return lambda c: c.startswith(key)


def call_phrases(cue_list: Column) -> Column:
    """Phrases whose key prefixes some cue; sorted and unique."""
    out = F.array().cast("array<string>")
    for key, phrase in PH.RUBY_CALLS:
        if phrase is not None:
            out = F.concat(out, EV.flag_phrase(F.exists(cue_list, _starts(key)), phrase))
    return F.array_sort(F.array_distinct(out))


def ruby_parts(reqs: Column, cue_list: Column, has_eval: Column,
               url_n: Column, b64_n: Column) -> Column:
    return F.concat(
        PH.import_phrases(reqs, PH.RUBY_REQUIRES, EV.ruby_base),
        call_phrases(cue_list),
        EV.flag_phrase(has_eval, PH.EVAL_PHRASE),
        EV.flag_phrase(url_n > 0, PH.URL_PHRASE),
        EV.base64_phrases(b64_n))


def ruby_sentence(package: Column, ident: Column, reqs: Column, cue_list: Column,
                  has_eval: Column, url_n: Column, b64_n: Column) -> Column:
    """``start entry {pkg}/{version/relpath}, ..., end of entry``."""
    return EV.sentence(package, ident, ruby_parts(reqs, cue_list, has_eval, url_n, b64_n))
