"""Building blocks for the DuckDB oracle SQL.

DuckDB's RE2 has neither possessive quantifiers, lookarounds nor
back-references, so the lexers are restated in RE2 form.  On inputs without
triple quotes or heredocs (true of the fixtures) they produce the same
token streams as the Java patterns: a digit-led word is consumed as a junk
token, which stands in for the ``(?<![\\w$])`` lookbehind.
"""

from __future__ import annotations

from pkgsift.functions import evidence as EV



def _head(blank: str) -> str:
    return rf"(?:\.{blank})?[A-Za-z_$][\w$]*(?:{blank}\??\.{blank}[A-Za-z_$][\w$]*)*{blank}\("


_JS_BLANK = r"\s*"
_PY_BLANK = r"(?:\s|\\\r?\n)*"
_PY_GAP = r"(?:[ \t]|\\\r?\n)"
_JUNK = r"[0-9][\w$]*"

PY_TOKENS_RE2 = "|".join([
    r"#[^\n]*",
    r'"(?:[^"\\\n]|\\[\s\S])*"?',
    r"'(?:[^'\\\n]|\\[\s\S])*'?",
    rf"\bfrom{_PY_GAP}+\.*[\w.]*{_PY_GAP}+import\b",
    rf"\bimport{_PY_GAP}+[\w.]+(?:{_PY_GAP}+as{_PY_GAP}+\w+)?(?:{_PY_GAP}*,{_PY_GAP}*[\w.]+(?:{_PY_GAP}+as{_PY_GAP}+\w+)?)*",
    r"\b(?:def|class)\s+\w+",
    _JUNK,
    _head(_PY_BLANK),
])

def js_arguments(depth: int = 4) -> str:
    """Arguments with balanced parentheses, as deep as the fixtures need."""
    text = r"""(?:[^()'"`]|'(?:[^'\\\n]|\\[\s\S])*'|"(?:[^"\\\n]|\\[\s\S])*"|`(?:[^`\\]|\\[\s\S])*`"""
    return f"{text}{rf'|\({js_arguments(depth - 1)}\)' if depth else ''})*"


JS_TOKENS_RE2 = "|".join([
    r"//[^\n]*",
    r"/\*[\s\S]*?(?:\*/|\z)",
    r"'(?:[^'\\\n]|\\[\s\S])*'?",
    r'"(?:[^"\\\n]|\\[\s\S])*"?',
    r"`(?:[^`\\]|\\[\s\S])*`?",
    r"\bnew\s+[\w$.]+\s*\(",
    r"\bfunction\s*(?:\*\s*)?[\w$]+\s*\(",
    _JUNK,
    rf"[A-Za-z_$][\w$]*\s*\({js_arguments()}\)[ \t]*\{{",
    _head(_JS_BLANK),
])

RUBY_STRINGS_RE2 = "(?m)" + "|".join([
    r"^=begin[\s\S]*?(?:^=end|\z)",
    r"#(?:[^{\n][^\n]*)?",
    r'"(?:[^"\\]|\\[\s\S])*"?',
    r"'(?:[^'\\]|\\[\s\S])*'?",
])

URL_RE2 = r"(?i)(https?://|\burl\b)"
B64_RE2 = r"\b[A-Za-z0-9+/]{24,}={0,2}\b"


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def case_map(expr: str, d: dict) -> str:
    whens = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in d.items())
    return f"(CASE {expr} {whens} ELSE NULL END)"


def in_list(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def first_seen(lst: str) -> str:
    """Distinct elements of a list expression in first-seen order."""
    return f"list_filter({lst}, lambda x, i: list_position({lst}, x) = i)"


def no_nulls(lst: str) -> str:
    return f"list_filter({lst}, lambda x: x IS NOT NULL)"


def literals(toks: str) -> str:
    return f"list_filter({toks}, lambda t: left(t, 1) IN ('\"', '''', '`'))"


def count_matching(lits: str, pattern: str) -> str:
    return f"CAST(len(list_filter({lits}, lambda s: regexp_matches(s, {q(pattern)}))) AS BIGINT)"


def heads(toks: str) -> str:
    """Call heads without blanks, '(' and '?' (non-call 'new'/'function' removed)."""
    return (f"list_transform(list_filter({toks}, lambda t: right(t, 1) = '(' AND NOT "
            f"regexp_matches(t, '^(new\\s|function[\\s*])')), "
            f"lambda t: regexp_replace(t, '[\\s(?\\\\]', '', 'g'))")


def head_base(h: str) -> str:
    return (f"(CASE WHEN starts_with({h}, '.') THEN '' "
            f"WHEN len(string_split({h}, '.')) > 1 THEN string_split({h}, '.')[1] ELSE '' END)")


def head_func(h: str) -> str:
    return f"string_split(regexp_replace({h}, '^\\.', ''), '.')[-1]"


def head_member(h: str) -> str:
    return f"(starts_with({h}, '.') OR len(string_split({h}, '.')) > 1)"


def head_is_keyword(h: str, keywords) -> str:
    return f"(NOT {head_member(h)} AND {head_func(h)} IN {in_list(keywords)})"


def b64_phrases(n: str) -> str:
    return (f"list_transform(range(CAST(greatest(least({n}, {EV.MAX_B64_PHRASES}), 0) AS BIGINT)), "
            f"lambda x: 'use base64 string')")


def flag(cond: str, phrase: str) -> str:
    return f"(CASE WHEN coalesce({cond}, false) THEN [{q(phrase)}] ELSE []::VARCHAR[] END)"


def sentence(pkg: str, ident: str, parts: str) -> str:
    return (f"('start entry ' || {pkg} || '/' || {ident} || ', ' || "
            f"CASE WHEN len({parts}) > 0 THEN array_to_string({parts}, ', ') "
            f"ELSE {q(EV.NO_BEHAVIOR)} END || ', end of entry')")


def fixed_sentence(pkg: str, ident: str, middle: str) -> str:
    return f"('start entry ' || {pkg} || '/' || {ident} || ', {middle}, end of entry')"
