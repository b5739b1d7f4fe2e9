"""Source snippets with the answers their languages' grammars give.

Each document becomes one file: the snippet of its number, with the document's
text (letters, digits, blanks and line ends) wherever a snippet says ``@T@``, and without line
ends where it says ``@L@``.  The answers are written by hand from the language rules, so they
check the scans independently of how those work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pkgsift.functions.colcache import cached_columns
from pkgsift.sources.fixtures import spread

B64 = "QUJDREVGR0hJSktMTU5PUFFSU1RVVldYWVo"
_DEEP = "exec(" + "(" * 50 + "require('child_process')" + ")" * 50 + ")"
_REQ = "require('child_process')"

# ---------------------------------------------------------------------------
# Fixed values: (file name, code, flags, literals with a URL, with a base64 run, calls as (module, function, text)).
# Flags: e = run-time evaluation, o = operating system call, p = process call.
JS_CASES = [
    ("a.js", "var a = /[\"]/; /* @T@ */ cp.exec('y'); eval('z')", "eo", 0, 0, [("cp", "exec", "cp.exec('y')"), ("", "eval", "eval('z')")]),
    ("a.js", f"var t = `a ${{{_REQ}.exec('x')}} b`", "o", 0, 0, [("", "require", _REQ), ("", "exec", f"{_REQ}.exec('x')")]),
    ("a.js", "`${`${eval('https://h.example')}`} https://u.example`", "e", 3, 0, [("", "eval", "eval('https://h.example')")]),
    ("a.js", _DEEP, "o", 0, 0, [("", "exec", _DEEP), ("", "require", _REQ)]),
    ("a.js", f"a[0].exec({_REQ})", "o", 0, 0, [("", "exec", f"a[0].exec({_REQ})"), ("", "require", _REQ)]),
    ("a.js", f"{_REQ}?.exec('x')", "o", 0, 0, [("", "require", _REQ), ("", "exec", f"{_REQ}?.exec('x')")]),
    ("a.js", f"{_REQ}['x'].exec('y')", "o", 0, 0, [("", "require", _REQ), ("", "exec", f"{_REQ}['x'].exec('y')")]),
    ("a.js", f"foo().exec(s); // {_REQ}.exec('x') @L@\n", "", 0, 0, [("", "foo", "foo()"), ("", "exec", "foo().exec(s)")]),
    ("a.js", "foo().exec(s); var q = \"require('child_process').exec('x')\"", "", 0, 0, [("", "foo", "foo()"), ("", "exec", "foo().exec(s)")]),
    ("a.js", "eval/**/('x')", "e", 0, 0, [("", "eval", "eval/**/('x')")]),
    ("a.js", "cp./*a*/exec('y')", "o", 0, 0, [("cp", "exec", "cp./*a*/exec('y')")]),
    ("a.js", "cp // x.eval( @L@\n  .exec /* y */ ('y')", "o", 0, 0, [("cp", "exec", None)]),
    ("a.ts", "cp.exec<string>('y'); a < b; eval<Map<string, number[]>>('z')", "eo", 0, 0,
     [("cp", "exec", "cp.exec<string>('y')"), ("", "eval", "eval<Map<string, number[]>>('z')")]),
    ("a.js", "cp.exec<string>('y')", "", 0, 0, []),
    ("a.js", "cp.exec`ls ${eval('x')}`", "eo", 0, 0, [("cp", "exec", "cp.exec`ls ${eval('x')}`"), ("", "eval", "eval('x')")]),
    ("a.js", f"réeval(1); this.#exec({_REQ})", "", 0, 0, [("", "réeval", "réeval(1)"), ("", "#exec", f"this.#exec({_REQ})"), ("", "require", _REQ)]),
    ("a.js", "// see x.eval( @L@\nx.run(1) /* y.eval( @T@ */", "", 0, 0, [("x", "run", "x.run(1)")]),
    ("a.js", "class A { eval(x) { return /eval(/.test(x) }\n exec = cp.exec('z') }", "o", 0, 0, [("", "test", "/eval(/.test(x)"), ("cp", "exec", "cp.exec('z')")]),
    ("a.js", "a = b / c; eval('d') / e", "e", 0, 0, [("", "eval", "eval('d')")]),
    ("a.js", f"if (x) /['\"]/.test(y); fork({_REQ})", "p", 0, 0, [("", "test", "/['\"]/.test(y)"), ("", "fork", f"fork({_REQ})"), ("", "require", _REQ)]),
    ("a.js", "var o = { eval(x) { return 1 }, b: { exec() {} } }; o.eval(1)", "e", 0, 0, [("o", "eval", "o.eval(1)")]),
    ("a.js", "x = a++ / 2; spawn(`${'child_process'}`) / 3", "p", 0, 0, [("", "spawn", "spawn(`${'child_process'}`)")]),
    ("a.js", "new Function('a'); new (eval('B'))(1); new a.b.exec('child_process')", "e", 0, 0, [("", "eval", "eval('B')")]),
    ("a.js", "async (x) => { await eval('1') }", "e", 0, 0, [("", "eval", "eval('1')")]),
    ("a.js", "'it\\'s'; \"url\"; `url ${1} ${\"https://b.example\"}`", "", 3, 0, []),
    ("a.js", "var s = 'abc\neval('x')", "e", 0, 0, [("", "eval", "eval('x')")]),
    ("a.js", "(0, eval)('x'); f(function exec(a) { return a })('y')", "", 0, 0, [("", "f", "f(function exec(a) { return a })")]),
    ("a.js", "for (const x of /u/g.exec('v')) { of(x) }", "", 0, 0, [("", "exec", "/u/g.exec('v')"), ("", "of", "of(x)")]),
    ("a.js", f"var k = [/\"{B64}\"/, \"{B64}\"] // \"{B64}\"", "", 0, 1, []),
    ("a.js", f"const c = {_REQ}; function f(a) {{ if (a) {{ return `}}${{c.fork(')')}}` }} }} /}}(/.exec('child_process')", "op", 0, 0,
     [("", "require", _REQ), ("child_process", "fork", "c.fork(')')"), ("", "exec", "/}(/.exec('child_process')")]),
]
# (code, evaluates, literals with a URL, imports, calls as (object, function))
PYTHON_CASES = [
    ("f'{eval(x)}'", True, 0, [], [("", "eval")]),
    ("f\"{os.system(f'{a!r:>{w}}')}\" # x.exec( @L@\n", False, 0, [], [("os", "system")]),
    ("# see x.exec( @L@\nx = 1\n", False, 0, [], []),
    ("f'{{eval(x)}}'", False, 0, [], []),
    ('f"""{\n exec("y") }""" ; "https://a"', True, 1, [], [("", "exec")]),
    ("a = rb'https://a' ; b = u\"https://b\" + R'''https://c'''", False, 3, [], []),
    ("f'{a:{b(\"https://c\")}}'", False, 2, [], [("", "b")]),
    ("print(f\"{d['k']}{eval('x')!r}\")", True, 0, [], [("", "print"), ("", "eval")]),
    ('"""a "quoted" eval(x) @T@"""; obj.exec (\'y\')', True, None, [], [("obj", "exec")]),
    ("def exec(x): return f'{x:%Y-%m-%d}'\nclass eval(object): pass\n", False, 0, [], []),
    ("foo\n(eval)\n", False, 0, [], []),
    ("from os import (\n path) ; import subprocess as sp\nsp.run(['a'])[0].exec()", True, 0, ["os", "sp", "subprocess"], [("sp", "run"), ("", "exec")]),
    ("x = f'{(lambda y: eval(y))(1)}' 'it''s' f'{x}{{'", True, 0, [], [("", "eval")]),
    ("x = (a\n  # b.eval( @L@\n  .run('url'))", False, 1, [], [("a", "run")]),
    ("f'{x:eval(y)}{z:}}' ; \"https://a\"", False, 1, [], []),
]
# (code, literals with a URL, with a base64 run)
RUBY_CASES = [
    ("x = %q(https://a)", 1, 0),
    ("x = %Q{https://a #{\"https://b\"} {} }", 2, 0),
    ("x = %w[https://a b https://c]", 2, 0),
    ("x = <<~eos\n  https://a\n  eos\ny = 1\n", 1, 0),
    ("\"#{\"https://a\"} b\"", 2, 0),
    ("x =~ /\"/ ; y = \"https://a\"; z = 'https://b'", 2, 0),
    ("# \"https://a\" @L@\n=begin\nx = \"https://b\" @T@\n=end\nputs \"c\"", 0, 0),
    ("puts \"a\"\n__END__\nx = \"https://a\"\n@T@", 0, 0),
    ("foo(<<A, <<-'B')\nhttps://a\nA\n #{\"https://x\"} https://b\n  B\ny = \"https://c\"", 3, 0),
    ("%w(a (https://b) c)", 1, 0),
    ("x = a / b ; y = \"https://a\" / 2", 1, 0),
    ("c = ?\" ; y = \"https://a\"", 1, 0),
    ("x = `curl https://a`", 1, 0),
    ("x = %[https://a] ; y = 5 % (3) ; z = %(url)", 2, 0),
    ("\"a #{x.map { |y| \"https://#{y}\" }} b\"", 2, 0),
    (f"k = %q({B64}) # '{B64}'", 0, 1),
    ("class A << self ; x <<1 ; puts %r{url}i, :\"url\" ; end", 2, 0),
    ("a = \"it's #{b ? 'url' : \"x\"}\" ; '#{\"url\"}'", 3, 0),
]
# (code, whether the fallback patterns apply, evaluates with them)
BROKEN_CASES = [
    ("var f = (new Function('x')", True, True),
    ("var f = (new Function('x'))", False, False),
    ("vm.runInNewContext('x'); /* @T@", True, True),
    ("vm.runInNewContext('x'); /* @T@ */", False, False),
    ("new Function('x'); var t = `a", True, True),
    ("new Function('x'); var t = `a ${b}`", False, False),
    ("new Function('x') }", True, True),
    ("var s = 'abc\nnew Function('x')", True, True),
    ("var x = {a: [1, (2)]}; function f() { return /[}(]/ }", False, False),
]
# ---------------------------------------------------------------------------


def snippet_files(spark: SparkSession, sf_dir: str, codes: list[str]) -> DataFrame:
    """doc_id, case_no and code: the snippet ``doc_id`` mod their number of each document."""
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), "doc_id")
    return docs.select(*_columns(tuple(codes)))


@cached_columns
def _columns(codes: tuple[str, ...]) -> list[Column]:
    case = F.col("doc_id") % len(codes)
    code = F.element_at(F.array(*map(F.lit, codes)), (case + 1).cast("int"))
    words = F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), "[^A-Za-z0-9 \n]", " ")
    full = F.replace(F.replace(code, F.lit("@T@"), words), F.lit("@L@"), F.translate(words, "\n", " "))
    return [F.col("doc_id"), case.cast("int").alias("case_no"), full.alias("text")]
