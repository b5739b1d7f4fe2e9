"""The work of the scans and of the rollup: one pass over the files, plain prose passed over."""

import random

import pytest

from pkgsift.functions import lexers as LX
from pkgsift.functions import scan_js, scan_python, scan_ruby
from pkgsift.functions.plain_runs import skipper
from pkgsift.operators.rollup import version_rollup
from tests.conftest import rows

FEATURES = "package string, version string, imports array<string>, has_eval_exec boolean, calls_os boolean, calls_proc boolean, url_count long, b64_count long"


def test_rollup_reads_files_once(spark, tmp_path):
    data = [("a", "1", ["x", "y"], True, False, None, 1, 2), ("a", "1", ["y", None], False, False, None, 10, None),
            ("a", "1", None, False, None, None, 100, 4), ("b", "1", [], None, True, False, None, None)]
    spark.createDataFrame(data, FEATURES).write.parquet(str(tmp_path / "f"))
    out = version_rollup(spark.read.parquet(str(tmp_path / "f")))
    assert sorted(rows(out.select("package", "imports", "has_eval_exec", "calls_os", "calls_proc", "url_count", "b64_count", "n_files"))) == [
        ("a", ["x", "y"], True, False, None, 111, 6, 3), ("b", [], None, True, False, None, None, 1)]
    assert out._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


@pytest.mark.parametrize("prose", ["plain words, then so on. ", "a. b. c. ", "Some of it is new; let class be ", "word\n"])
def test_long_prose_is_few_steps(prose):
    """Tokens are looked at one by one only near what may matter."""
    text = "x = f(a) " + prose * 5000 + "g(b)"
    for module, make, calls in ((scan_js, lambda t: scan_js.Scan(t), True), (scan_python, lambda t: scan_python.Scan(t), True), (scan_ruby, lambda t: scan_ruby.Scan(t), False)):
        special = prose.startswith("Some")  # every word of the language ends a run
        steps, blank = [0], module._BLANK

        class Counted:
            def match(self, *args):
                steps[0] += 1
                return blank.match(*args)

        module._BLANK = Counted()
        try:
            scan = make(text)
        finally:
            module._BLANK = blank
        assert not calls or [c[-3 if module is scan_js else -1] for c in scan.calls] == ["f", "g"]
        if prose[0] != "a" and not special:
            assert steps[0] < 100, module


def test_skipping_changes_nothing():
    """A limit that is never met reads every token, so both ways must agree."""
    rnd = random.Random(3)
    words = "foo bar get async static new return class interface of as function import from def in if eval exec require r f".split()
    marks = ["(", ")", "{", "}", "[", "]", "'", '"', "`", "/", ":", ".", "=>", "\n", "#", "<", "\\", "f'", "${", "<<A\n", "\nA\n", "1.5", "é"]
    for _ in range(3000):
        text = "".join(rnd.choice(words) + rnd.choice([" ", " ", " ", ", ", ". ", "; ", ": ", "\n", "."]) if rnd.random() < .8 else rnd.choice(marks) for _ in range(rnd.randrange(80)))
        for typed in (False, True):
            a, b = scan_js.Scan(text, typed), scan_js.Scan(text, typed, 10**9)
            assert (a.calls, a.literals, a.broken) == (b.calls, b.literals, b.broken), text
        c = scan_ruby.Scan(text), scan_ruby.Scan(text, 10**9)
        assert c[0].literals == c[1].literals, text
        if "f'" in text:
            continue
        a, b = scan_python.Scan(text), scan_python.Scan(text, 10**9)
        assert (a.calls, a.literals, a.imports) == (b.calls, b.literals, b.imports), text


def test_runs_without_a_place_are_asked_once():
    skip = skipper(["return"])
    assert skip("a. b. c. d. e. f", 0) == (0, "", 15)
    assert skip("one two three, four return x y z u ", 0) == (15, ",", 20)
    assert skip("one two three(four) ", 0) == (0, "", 0)


def test_counts_of_literals():
    for text, want in (('x = "HTTPS://a" ; y = "the URL"', (2, 0)), ("no literal http://a url", (0, 0)), ('"' + "QUJD" * 6 + '"', (0, 1))):
        assert LX._counts(scan_js.Scan(text), text) == want
