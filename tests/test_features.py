import re

import pytest
from pyspark.sql import functions as F

from conftest import rows
from pkgsift.functions import evidence as EV
from pkgsift.functions import js_features as JS
from pkgsift.functions import python_features as PY
from pkgsift.functions import ruby_features as RB


def _one(df):
    return df.collect()[0].asDict()


def _py(spark, text, **kw):
    return _one(PY.python_features(spark.createDataFrame([(text,)], "text string"), **kw))


def _js(spark, text, size=None, **kw):
    df = spark.createDataFrame([(text, size or len(text))], "text string, size long")
    return _one(JS.js_features(df, **kw))


def _rb(spark, text):
    return _one(RB.ruby_features(spark.createDataFrame([(text,)], "text string")))


# ---------------------------------------------------------------- evidence regexes vs Python re
SAMPLES = ["see url here", "URL:", "https://x", "http://a http://b", "curl", "urls", "éurl",
           "QUJDREVGR0hJSktMTU5PUFFSU1RVVldYWVo=", "a" * 23, "b" * 24, "x/+" * 10 + "==",
           "tokenQUJDREVGR0hJSktMTU5PUFFSU1RVVldYWVo", ""]


def test_url_b64_counts_match_python(spark):
    url = re.compile(r"(https?://|\burl\b)", re.I)
    b64 = re.compile(r"\b[A-Za-z0-9+/]{24,}={0,2}\b")
    df = spark.createDataFrame([(s,) for s in SAMPLES], "t string")
    got = rows(df.select(EV.url_count(F.col("t")), EV.b64_count(F.col("t"))))
    assert got == [(len(url.findall(s)), len(b64.findall(s))) for s in SAMPLES]


def test_decode_drops_bad_bytes(spark):
    df = spark.createDataFrame([(bytearray(b"ok\xff\xfeend\xc3\xa9"),)], "b binary")
    assert rows(df.select(EV.decode_text(F.col("b")))) == [("okendé",)]


# ---------------------------------------------------------------- Python
def test_python_imports_calls_and_decoys(spark):
    f = _py(spark, 'import a.b as c, d\nfrom x.y import z\nfrom . import rel\n'
                   'import sp as subprocess_alias\nsp.Popen("x")\nsubprocess.run("a"); subprocess.run("b")\n'
                   '# os.system("comment")\ns = "eval(1) https://in.string"\n'
                   't = """triple\nhttp://x"""\nfoo().bar()\ndef exec(): pass\n')
    assert f["imports"] == ["a", "c", "d", "sp", "subprocess_alias", "x"]
    calls = [(c["mod"], c["func"]) for c in f["calls"]]
    assert ("sp", "Popen") in calls and calls.count(("subprocess", "run")) == 2
    assert ("os", "system") not in calls                        # comment
    assert ("", "foo") in calls and ("", "bar") in calls        # call on a call result
    assert not f["has_eval_exec"]                               # 'def exec' is not a call
    assert f["url_count"] == 2                                  # two literals carry URLs


def test_python_from_imports_option(spark):
    assert _py(spark, "from os import path\n", from_imports=False)["imports"] == []
    assert _py(spark, "from os import path\n")["imports"] == ["os"]


def test_python_sentence(spark):
    df = PY.python_features(spark.createDataFrame(
        [('import os, base64 ; os.system("curl http://x") ; subprocess.Popen(1); subprocess.run(2)',)],
        "text string"))
    s = df.select(PY.pypi_sentence(F.lit("p"), F.lit("1.0/a.py"), F.col("imports"), F.col("calls"),
                                   F.col("has_eval_exec"), F.col("url_count"), F.col("b64_count"))).first()[0]
    assert s == ("start entry p/1.0/a.py, import base64 module, import operating system module, "
                 "use operating system module call, use process module call, use process module call, "
                 "use URL, end of entry")


# ---------------------------------------------------------------- JavaScript
def test_js_aliases_and_flags(spark):
    src = ("// require('child_process').exec('x')\n"
           "const s = \"cp.exec(\";\n"
           "const cp = require('child_process'); let cp2 = require('fs');\n"
           "const { exec: run, spawn } = require('node:child_process');\n"
           "import d, {x} from 'axios';\n"
           "import * as ns from 'http';\n"
           "import { fork as f2 } from 'child_process';\n"
           "cp.exec('ls'); f2('a'); this.eval2(); new Function('x'); a.b.c.d(1);\n")
    f = _js(spark, src)
    assert f["imports"] == ["child_process", "fs", "http", "node:child_process"]
    calls = [(c["mod"], c["func"]) for c in f["calls"]]
    assert ("child_process", "exec") in calls and ("child_process", "fork") in calls
    assert ("", "eval2") in calls and ("a", "d") in calls
    assert not any(c[1] == "Function" for c in calls)           # new X( is not a call
    assert f["calls_os"] and f["calls_proc"] and not f["has_eval_exec"]


def test_js_direct_require_and_last_alias_wins(spark):
    f = _js(spark, "require('child_process').execSync('id'); var a = require('x'); var a = require('vm');"
                   " a.runInNewContext('1'); eval('2')")
    assert f["calls_os"] and f["has_eval_exec"]
    assert ("vm", "runInNewContext") in [(c["mod"], c["func"]) for c in f["calls"]]


def test_js_light_mode(spark):
    src = "const x = require('child_process'); require('child_process').spawn('a'); 'http://u'; " + "z" * 50
    f = _js(spark, src, max_file_bytes=10)
    assert f["light"] and f["calls"] == [] and f["calls_proc"] and not f["calls_os"]
    assert f["url_count"] == 1 and f["imports"] == ["child_process"]


def test_install_hook(spark):
    df = spark.createDataFrame([('{"scripts": {"postinstall": "x"}}',), ('{"scripts": "install"}',),
                                ('﻿{"scripts": {"install": 1}}',), ('not json',), ('{}',),
                                ('{"scripts": {"preinstall": null}}',), ('{"scripts": ["install"]}',)],
                               "j string")
    assert [r[0] for r in df.select(JS.install_hook(F.col("j"))).collect()] == [
        True, False, False, False, False, True, False]


# ---------------------------------------------------------------- Ruby
def test_ruby_features(spark):
    f = _rb(spark, 'require "Net/HTTP/post"\nrequire_relative \'lib/x\'\nsystem "x"\n'
                   '# `in comment`\n%x{\nls\n}\nOpen3.popen2("a")\nx = <<EOS\nhttps://h\nEOS\n'
                   'module_eval("1")\n')
    assert f["requires"] == ["lib/x", "net/http/post"]
    assert f["calls"] == ["open3.popen", "system"]
    assert f["has_eval_exec"] and f["url_count"] == 1
    s = spark.createDataFrame([(f["requires"], f["calls"])], "r array<string>, c array<string>").select(
        RB.ruby_sentence(F.lit("g"), F.lit("1/a.rb"), F.col("r"), F.col("c"), F.lit(True),
                         F.lit(1), F.lit(9))).first()[0]
    assert s == ("start entry g/1/a.rb, import network module, use operating system module call, "
                 "use process module call, evaluate code at run-time, use URL, use base64 string, "
                 "use base64 string, use base64 string, use base64 string, end of entry")


def test_no_notable_behavior(spark):
    f = _rb(spark, "puts 1")
    df = spark.createDataFrame([(f["requires"], f["calls"])], "r array<string>, c array<string>")
    s = df.select(RB.ruby_sentence(F.lit("g"), F.lit("1"), F.col("r"), F.col("c"), F.lit(False),
                                   F.lit(0), F.lit(0))).first()[0]
    assert s == "start entry g/1, no notable behavior, end of entry"


# ---------------------------------------------------------------- hostile inputs (must finish)
@pytest.mark.parametrize("text", [
    '"' + "\\\\" * 1_500_000,                     # ~3 MB escaped, unclosed string
    "const {" + " " * 10_000,                     # unclosed brace, long blanks
    "import {" + " " * 10_000 + "x",
    "a." * 200_000 + "(",                          # long member chain
    "'" + "x" * 1_000_000,                         # unclosed literal
])
def test_hostile_inputs_finish(spark, text):
    df = spark.createDataFrame([(text, len(text))], "text string, size long")
    JS.js_features(df, max_file_bytes=10_000_000).collect()
    PY.python_features(df).collect()
    RB.ruby_features(df).collect()


def test_js_lenient_mode_adds_parse_failure_regexes(spark):
    src = "var f = new Function('return 1'); child_process.spawn('x')"
    strict = _js(spark, src)
    lenient = _js(spark, src, lenient=True)
    assert not strict["has_eval_exec"] and lenient["has_eval_exec"]
    assert lenient["calls_proc"]


def test_js_child_process_in_call_text(spark):
    # no module, but the call's own text names child_process (object or argument)
    assert _js(spark, "foo('child_process').spawn('x')")["calls_proc"]
    assert _js(spark, "exec('child_process ls')")["calls_os"]
    assert _js(spark, "require(\"CHILD_PROCESS\").execSync('id')")["calls_os"]
    # only in a comment or a plain string: no call, no flag
    f = _js(spark, "// require('child_process').exec('x')\nvar s = \"require('child_process').exec(\";")
    assert not f["calls_os"]


def test_js_extended_mode_is_opt_in(spark):
    src = ("import d, {execFile as ef, x} from 'node:child_process';\n"
           "require('got'); import('axios');\n"
           "const cp = require('node:child_process'); cp.spawnSync('a'); ef('b');\n")
    plain = _js(spark, src)
    ext = _js(spark, src, extended=True)
    assert plain["imports"] == ["node:child_process"] and not plain["calls_os"] and not plain["calls_proc"]
    assert ext["imports"] == ["axios", "child_process", "got"]
    assert ext["calls_os"] and ext["calls_proc"]
    assert ("child_process", "execFile") in [(c["mod"], c["func"]) for c in ext["calls"]]


# ---------------------------------------------------------------- call shapes, by the reference's rules
@pytest.mark.parametrize("src,flags", [  # (has_eval_exec, calls_os, calls_proc)
    ('const util = require("child_process");\nexec("ls")', (False, False, False)),   # the call's own text does not name it
    ('exec(a, b, require("child_process"))', (False, True, False)),
    ('exec(a, f(g("x"), h(")")), require("child_process"))', (False, True, False)),
    ('require("child_process").exec("ls")', (False, True, False)),
    ('require("child_process")\n   .spawn("ls")', (False, False, True)),
    ('wrap(require("child_process")).x.y.fork("ls")', (False, False, True)),
    ('const cp = require("child_process"); cp\n' + " " * 40 + '.exec("ls")', (False, True, False)),
    ('class A { eval(x) { return x } }', (False, False, False)),                       # method definitions
    ('class A { async *eval(x = f(1)) { } }', (False, False, False)),
    ('class A { foo(x = eval("1")) { } }', (True, False, False)),                      # a call inside one
    ('function* eval(x) {}', (False, False, False)),
    ('function *eval(x) {}', (False, False, False)),
    ('eval(payload)\n{ }', (True, False, False)),                                     # a call, then a block
    ('if (eval("x")) { }', (True, False, False)),
    ("eval" + " " * 9 + '("x")', (True, False, False)),
    ("eval" + "\n" * 5000 + '("x")', (True, False, False)),
    (".".join(["a"] * 500) + '.eval("x")', (True, False, False)),
])
def test_js_call_shapes(spark, src, flags):
    f = _js(spark, src)
    assert (f["has_eval_exec"], f["calls_os"], f["calls_proc"]) == flags


@pytest.mark.parametrize("src,imports,calls,ev", [
    ("import os, \\\n  sys\n", ["os", "sys"], [], False),
    ("from os \\\n import path\n", ["os"], [], False),
    ("os\\\n    .system('x')", [], [("os", "system")], False),
    ("eval" + " " * 30 + "('x')", [], [("", "eval")], True),
    (".".join(["a"] * 20) + ".run('x')", [], [("a", "run")], False),
])
def test_python_call_shapes(spark, src, imports, calls, ev):
    f = _py(spark, src)
    assert f["imports"] == imports and [(c["mod"], c["func"]) for c in f["calls"]] == calls and f["has_eval_exec"] == ev


def test_hostile_calls_stay_linear(spark):
    import time
    texts = ["a(" * 50_000, "a.b." * 50_000, "exec(" + "(" * 50_000 + '"child_process"', "x" * 500_000 + "(", "f(x) {" * 20_000,
             'require("child_process").' * 10_000 + "exec(", "a" + " " * 200_000 + "b"]
    df = spark.createDataFrame([(t, len(t)) for t in texts], "text string, size long")
    start = time.time()
    JS.js_features(df).collect()
    assert time.time() - start < 60


def test_possessive_patterns_match_like_the_plain_ones(spark):
    """The reference's patterns and their possessive forms find the same on common inputs."""
    plain = [r"\b(?:const|let|var)\s+([A-Za-z_$][\w$]*)\s*=\s*require\s*\(\s*['\"]([^'\"]+)['\"]\s*\)",
             r"\bimport\s+([A-Za-z_$][\w$]*)\s+from\s+['\"]([^'\"]+)['\"]"]
    texts = ['const a = require("x"); let b=require( \'y\' )', "import q from 'z'", "var  c  = require ( \"m/n\" ) ;import r  from  \"s\"", "const = require('x')", ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for p, own in zip(plain, (JS.REQUIRE_ALIAS, JS.IMPORT_DEFAULT)):
        got = rows(df.select(F.regexp_extract_all("t", F.lit(own), F.lit(0))))
        assert [g[0] for g in got] == [[m[0] for m in re.finditer(p, t)] for t in texts]
