"""Python file features and the PyPI sentence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pkgsift.functions import evidence as EV
from pkgsift.functions.colcache import apply_stages, cached_columns
from pkgsift.functions import lexers as LX
from pkgsift.functions import phrases as PH

_IDENT = r"^[A-Za-z_][A-Za-z0-9_]*$"


def _import_names(tok: Column) -> Column:
    """``import a.b as c, d`` → [a, c, d]: every word but 'as', cut at the first '.'."""
    body = F.regexp_replace(tok, r"^import", " ")
    words = F.filter(F.split(body, r"[\s,\\]+"), lambda w: (w != "") & (w != "as"))
    bases = F.transform(words, lambda w: F.split(w, r"\.")[0])
    return F.filter(bases, lambda b: b.rlike(_IDENT))


def _from_module(tok: Column) -> Column:
    """``from x.y import z`` → [x]; relative ``from . import z`` → []."""
    mod = F.split(F.regexp_extract(tok, r"^from[\s\\]+([^\s\\]*)", 1), r"\.")[0]
    return F.when(mod != "", F.array(mod)).otherwise(F.array().cast("array<string>"))


def imports_from_tokens(toks: Column, from_imports: bool = True) -> Column:
    """Sorted, distinct module bases of import statements."""
    plain = F.flatten(F.transform(F.filter(toks, lambda t: t.startswith("import")),
                                  _import_names))
    if from_imports:
        plain = F.concat(plain, F.flatten(F.transform(
            F.filter(toks, lambda t: t.rlike(r"^from[\s\\]")), _from_module)))
    return F.array_sort(F.array_distinct(plain))


@cached_columns
def _py_stages(text_col: str, from_imports: bool, literal_weight: int, max_tokens: int):
    scan = F.col("_scan")
    calls = F.transform(scan["calls"], lambda c: F.struct(c["base"].alias("mod"), c["func"].alias("func")))
    return [
        {"_scan": LX.python_scan(F.col(text_col), max_tokens)},
        {"imports": imports_from_tokens(scan["imports"], from_imports), "calls": calls,
         "url_count": scan["urls"] * F.lit(literal_weight), "b64_count": scan["b64"] * F.lit(literal_weight)},
        # Any function named eval or exec, whatever its object
        {"has_eval_exec": F.exists("calls", lambda c: c["func"].isin("eval", "exec"))},
    ], ["_scan"]


def python_features(df: DataFrame, text_col: str = "text", from_imports: bool = True,
                    literal_weight: int = 1, max_tokens: int = LX.DEFAULT_MAX_TOKENS) -> DataFrame:
    """Add feature columns for Python source in ``text_col``.

    imports array<string>, calls array<struct<mod,func>>, has_eval_exec,
    url_count, b64_count.  Each text is scanned once.
    """
    LX.ready(df)
    stages, drop = _py_stages(text_col, from_imports, literal_weight, max_tokens)
    return apply_stages(df, stages, drop)


def call_phrases(calls: Column) -> Column:
    """One phrase per dictionary key present, in dictionary order."""
    keys = F.array_distinct(F.transform(calls, lambda c: F.concat_ws("\u0000", c["mod"], c["func"])))
    out = F.array().cast("array<string>")
    for (mod, func), phrase in PH.PYPI_CALLS:
        out = F.concat(out, EV.flag_phrase(F.array_contains(keys, f"{mod}\u0000{func}"), phrase))
    return out


def pypi_parts(imports: Column, calls: Column, has_eval: Column,
               url_n: Column, b64_n: Column) -> Column:
    return F.concat(
        PH.import_phrases(imports, PH.PYPI_IMPORTS),
        call_phrases(calls),
        EV.flag_phrase(has_eval, PH.EVAL_PHRASE),
        EV.flag_phrase(url_n > 0, PH.URL_PHRASE),
        EV.base64_phrases(b64_n))


def pypi_sentence(package: Column, ident: Column, imports: Column, calls: Column,
                  has_eval: Column, url_n: Column, b64_n: Column) -> Column:
    """``start entry {pkg}/{version/relpath}, ..., end of entry``."""
    return EV.sentence(package, ident, pypi_parts(imports, calls, has_eval, url_n, b64_n))
