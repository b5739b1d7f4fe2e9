"""The passes over source text: known answers, hostile texts, and invariants."""

import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pkgsift.functions import js_features as JS
from pkgsift.functions import lexers as LX
from pkgsift.functions import scan_js, scan_python, scan_ruby
from pkgsift.sources import snippets as SN

WORDS = "the end of\nurl words not here 12"


def fill(code):
    return code.replace("@T@", WORDS).replace("@L@", WORDS.replace("\n", " "))


@pytest.mark.parametrize("case", SN.JS_CASES, ids=range(len(SN.JS_CASES)))
def test_js_cases(case):
    path, code, _, urls, b64, calls = case
    text = fill(code)
    s = scan_js.Scan(text, path.endswith(".ts"))
    assert [name for _, _, name, _, _ in s.calls] == [name for _, name, _ in calls]
    assert [text[a:b] for *_, a, b in s.calls] == [own if own is not None else text[a:b] for (*_, a, b), (_, _, own) in zip(s.calls, calls)]
    assert LX._counts(s, text) == (urls, b64)


@pytest.mark.parametrize("case", SN.PYTHON_CASES, ids=range(len(SN.PYTHON_CASES)))
def test_python_cases(case):
    code, _, urls, _, calls = case
    s = scan_python.Scan(fill(code))
    assert [c[1:] for c in s.calls] == calls
    assert urls is None or LX._counts(s, s.text)[0] == urls


@pytest.mark.parametrize("case", SN.RUBY_CASES, ids=range(len(SN.RUBY_CASES)))
def test_ruby_cases(case):
    code, urls, b64 = case
    s = scan_ruby.Scan(fill(code))
    assert LX._counts(s, s.text) == (urls, b64)


@pytest.mark.parametrize("code,broken,_", SN.BROKEN_CASES)
def test_broken_files(code, broken, _):
    assert scan_js.Scan(fill(code)).broken == broken


def calls_of(text, typed=False):
    return [(base, name, text[a:b]) for _, base, name, a, b in scan_js.Scan(text, typed).calls]


@pytest.mark.parametrize("text,want", [
    ("a.b.c(1).d(2)", [("a", "c", "a.b.c(1)"), ("", "d", "a.b.c(1).d(2)")]),
    ("super.f(1); super(2); this.g(3); import('x')", [("", "f", "super.f(1)"), ("", "g", "this.g(3)")]),
    ("new A.B(x).c(1)", [("", "c", "new A.B(x).c(1)")]),
    ("a\n  .b()\n  ?.c()", [("a", "b", "a\n  .b()"), ("", "c", "a\n  .b()\n  ?.c()")]),
    ("f?.(x)", [("", "f", "f?.(x)")]),
    ("while (a) /b(/.test(c)", [("", "test", "/b(/.test(c)")]),
    ("x = {a: 1} / f(2) / 3", [("", "f", "f(2)")]),
    ("function f() {} /g(/.h()", [("", "h", "/g(/.h()")]),
    ("(a) / b(1) / c", [("", "b", "b(1)")]),
    ("[1] / b(1) / c", [("", "b", "b(1)")]),
    ("return /[/]b(/.c(1)", [("", "c", "/[/]b(/.c(1)")]),
    ("a = b\n/c(1)/d", [("", "c", "c(1)")]),                       # a division over two lines
    ("class A extends f(B) { get x() {} static y() {} #z() {} *w() {} async v() {} 'u'() {} [t()]() {} }", [("", "f", "f(B)"), ("", "t", "t()")]),
    ("class A { x = 1\n  y() { z() }\n}", [("", "z", "z()")]),
    ("@Dec({a: b()}) class A {}", [("", "Dec", "Dec({a: b()})"), ("", "b", "b()")]),
    ("f(a => { g() }, {h() { i() }})", [("", "f", "f(a => { g() }, {h() { i() }})"), ("", "g", "g()"), ("", "i", "i()")]),
    ("`${`${a(`${b()}`)}`}`", [("", "a", "a(`${b()}`)"), ("", "b", "b()")]),
    ("`\\${a()}` + '${b()}'", []),
    ("`}` + `{${c({d: '}'})}}` + e()", [("", "c", "c({d: '}'})"), ("", "e", "e()")]),
    ("\\u0065val(1)", [("", "\\u0065val", "\\u0065val(1)")]),
    ("1..f(); 1.5.g(); .5.h(); 0x1F.i()", [("", "f", "1..f()"), ("", "g", "1.5.g()"), ("", "h", ".5.h()"), ("", "i", "0x1F.i()")]),
    ("#!/usr/bin/env node f(\ng()", [("", "g", "g()")]),
    ("switch (a) { case f(1): { g() } default: h() }", [("", "f", "f(1)"), ("", "g", "g()"), ("", "h", "h()")]),
    ("a ? b() : /c(/.d()", [("", "b", "b()"), ("", "d", "/c(/.d()")]),
    ("f(", [("", "f", "f(")]),
    ("a) ] } f(1)", [("", "f", "f(1)")]),
])
def test_js_shapes(text, want):
    assert calls_of(text) == want


@pytest.mark.parametrize("text,want", [
    ("f<T>(x)", ["f"]), ("a < b, c > (d)", ["a"]), ("a < b && c > (d)", []), ("x!.f(1)", ["f"]), ("i<n;i++) f(1)", ["f"]),
    ("interface I { f(a: string): void }\ng<A<B>[]>(1)", ["g"]), ("abstract class A { abstract f(a): b; h(x): y { z() } }", ["z"]),
])
def test_typescript_shapes(text, want):
    assert [name for _, name, _ in calls_of(text, True)] == want


HOSTILE = {
    "slashes": "/" + "a/[" * 120_000, "escaped slashes": "x = " + "\\/" * 180_000, "classes": "x=/[" * 60_000, "lone regexes": "=/a" * 120_000,
    "open brackets": "(" * 300_000, "wrong brackets": "(" * 140_000 + "]" * 140_000, "templates": "`${" * 100_000, "half templates": "`${a" * 60_000 + "}`" * 10,
    "angles": "a<" * 140_000, "angles and brackets": "a<b>(" * 60_000, "quotes": "'\"`" * 80_000, "chain": "a(" * 80_000 + ")." * 80_000, "stars": "/*" + "*" * 200_000,
    "comments": "/**/" * 80_000, "backslashes": '"' + "\\" * 300_000, "heredocs": "<<A\n" * 60_000, "heredocs on a line": "<<A," * 60_000 + "\n", "holes": '"#{' * 80_000,
    "percents": "%q(" * 80_000, "heredoc holes": "x = <<A\n" + "#{a}\n" * 40_000 + "A\n", "f-strings": "f'{" * 80_000, "specs": "f'{a:{" * 40_000, "braces": "{" * 200_000 + "}" * 200_000,
    "words": "%w[" + "a " * 120_000, "names": "a" * 400_000 + "(", "dots": "a." * 140_000,
}


@pytest.mark.parametrize("name", HOSTILE)
def test_hostile_texts_stay_linear(name):
    """Twice the text takes about twice the time: measured on both, with room for noise."""
    text = HOSTILE[name]
    for scan in (lambda t: scan_js.Scan(t, True), scan_python.Scan, scan_ruby.Scan):
        times = []
        for part in (text[:len(text) // 8], text):
            start = time.process_time()
            s = scan(part)
            LX._counts(s, part)
            times.append(time.process_time() - start)
        assert times[1] < 0.3 + 24 * times[0] and times[1] < 20, (name, times)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abx.()[]{}`'\"$/\\\n *<>=,;:#?!%wq1f@ ", max_size=40), st.sampled_from([0, 1, 2]))
def test_any_text_is_scanned(text, which):
    s = [lambda: scan_js.Scan(text, True), lambda: scan_python.Scan(text), lambda: scan_ruby.Scan(text)][which]()
    assert all(0 <= a <= b <= len(text) for a, b in s.literals)
    assert not s.stack or which == 2
    if which == 0:
        assert all(text[at] in "(`" and a <= at < b <= len(text) for at, _, _, a, b in s.calls)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["f", "(", ")", "'a'", ",", "[", "]", "/* ) */", "// (\n", "`x`", "{", "}", ".g"]), max_size=25))
def test_balanced_calls_close_where_their_bracket_does(parts):
    text = " ".join(parts)
    bare = re.sub(r"'a'|`x`|/\* \) \*/|// \(\n", lambda m: " " * len(m.group()), text)
    ends, stack, ok = {}, [], True
    for k, c in enumerate(bare):
        if c in "([{":
            stack.append((c, k))
        elif c in ")]}":
            if not stack or stack[-1][0] != {")": "(", "]": "[", "}": "{"}[c]:
                ok = False
                break
            ends[stack.pop()[1]] = k + 1
    s = scan_js.Scan(text)
    if ok and not stack:
        assert not s.broken
        assert all(ends[at] == b for at, _, _, _, b in s.calls if text[at] == "(")


def test_one_scan_per_file_and_no_row_udf(spark):
    df = spark.createDataFrame([("a", "x.js", 1)], "text string, path string, size long")
    plan = JS.js_features(df, path_col="path")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "BatchEvalPython" not in plan


def test_null_text_and_path(spark):
    df = spark.createDataFrame([(None, None, 1), ("", "a.ts", 1)], "text string, path string, size long")
    for r in JS.js_features(df, path_col="path").collect():
        assert (r["calls"], r["has_eval_exec"], r["calls_os"], r["url_count"], r["b64_count"]) == ([], False, False, 0, 0)
    assert JS.js_call_texts(df, "text", "path").collect() == []


def test_astral_characters_keep_places(spark):
    """Places are counted in characters on both sides."""
    df = spark.createDataFrame([("'👩‍👧🎉'; é𝒳.eval('🎉')",)], "text string")
    assert [(r["mod"], r["func"], r["call_text"]) for r in JS.js_call_texts(df).collect()] == [("é𝒳", "eval", "é𝒳.eval('🎉')")]


def test_snippet_queries_equal_their_answers(spark):
    """Each registered snippet query against its hand-written answers, in DuckDB."""
    import duckdb

    from pkgsift.plans import snippet_queries as Q

    sf = "/root/testdata/sf0.001"
    db = duckdb.connect()
    db.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    for name, query in Q.QUERIES.items():
        got = query(spark, sf)
        columns = sorted(got.columns)
        want = db.sql(f"SELECT {', '.join(columns)} FROM ({Q.ORACLES[name]})").fetchall()
        assert sorted(map(tuple, got.select(*columns).collect()), key=str) == sorted(want, key=str), name


def test_token_limit_is_opt_in(spark):
    text = "a(1); eval(2)"
    df = spark.createDataFrame([(text, len(text))], "text string, size long")
    assert JS.js_features(df).select("has_eval_exec").first()[0]
    assert not JS.js_features(df, max_tokens=4).select(F.col("has_eval_exec")).first()[0]
