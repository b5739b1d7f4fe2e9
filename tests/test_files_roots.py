from pyspark.sql import functions as F

from conftest import rows
from pkgsift.operators import files as FL
from pkgsift.operators import roots as RT
from pkgsift.plans import describe as D


def _files(spark, items):
    return spark.createDataFrame(items, "package string, version string, rel_path string, size long, content string")


def test_topk_priority_and_deny(spark):
    f = _files(spark, [
        ("p", "1", "dist/index.js", 10, ""), ("p", "1", "lib/a.js", 500, ""), ("p", "1", "src/b.ts", 50, ""),
        ("p", "1", "src/b.js", 50, ""), ("p", "1", "x.js", 9999, ""), ("p", "1", "test/t.js", 1, ""),
        ("p", "1", "node_modules/m/index.js", 1, ""), ("p", "1", "README.md", 1, "")])
    got = rows(FL.topk_files(f, k=20).orderBy("rank"), "rel_path", "rank")
    assert got == [("dist/index.js", 1), ("lib/a.js", 2), ("src/b.js", 3), ("src/b.ts", 4), ("x.js", 5)]
    assert len(rows(FL.topk_files(f, k=2))) == 2
    with_tests = rows(FL.topk_files(f, include_tests=True).orderBy("rank"), "rel_path")
    assert with_tests[-2:] in ([("node_modules/m/index.js",), ("test/t.js",)],
                               [("test/t.js",), ("node_modules/m/index.js",)])


REP = ("package", "version", "rel_path", "tier")


def test_topk_plan_ranks_narrow_columns(spark, tmp_path):
    _files(spark, [("p", "1", "a.js", 1, "body")]).write.parquet(str(tmp_path / "f"))
    f = spark.read.parquet(str(tmp_path / "f"))
    plan = FL.topk_files(f)._jdf.queryExecution().executedPlan().toString()
    scan = [ln for ln in plan.splitlines() if "ReadSchema" in ln or "FileScan" in ln]
    assert scan and all("content" not in ln for ln in scan)


def test_representative_python_tiers(spark):
    f = _files(spark, [
        ("my-pkg", "1", "docs/conf.py", 1, ""), ("my-pkg", "1", "setup.py", 1, ""),
        ("my-pkg", "1", "my_pkg/__init__.py", 1, ""), ("other", "2", "tests/t.py", 1, ""),
        ("other", "2", "src/o/core.py", 1, ""), ("third", "3", "tests/only.py", 1, "")])
    got = sorted(rows(FL.representative_python(f), *REP))
    # an un-hyphenated package name is also its directory name, so tier 2
    # ("/<hint>/" in the path) matches every file of it, as in the reference
    assert got == [("my-pkg", "1", "my_pkg/__init__.py", 1), ("other", "2", "src/o/core.py", 2),
                   ("third", "3", "tests/only.py", 2)]
    g = _files(spark, [("a-b", "1", "tests/t.py", 1, ""), ("a-b", "1", "src/m.py", 1, ""),
                       ("c-d", "1", "docs/x.py", 1, ""), ("c-d", "1", "z.py", 1, ""),
                       ("e-f", "1", "tests/only.py", 1, "")])
    assert sorted(rows(FL.representative_python(g), *REP)) == [
        ("a-b", "1", "src/m.py", 3), ("c-d", "1", "z.py", 4), ("e-f", "1", "tests/only.py", 5)]


def test_pypi_inner_root_prefers_listed_order(spark):
    f = _files(spark, [("p", "1", "dist/a.py", 1, ""), ("p", "1", "src/b.py", 1, ""),
                       ("q", "1", "x/c.py", 1, "")])
    got = sorted(rows(RT.pypi_inner_root(f), "package", "rel_path", "vrel"))
    assert got == [("p", "b.py", "src/b.py"), ("q", "x/c.py", "x/c.py")]


def test_representative_ruby(spark):
    f = _files(spark, [("g", "1", "lib/z.rb", 1, ""), ("g", "1", "bin/a.rb", 1, ""),
                       ("h", "1", "h.gemspec", 1, ""), ("h", "1", "lib/a.rb", 1, ""),
                       ("k", "1", "x.src/lib/k.rb", 1, "")])
    inner = RT.ruby_inner_root(f)
    got = sorted(rows(FL.representative_ruby(inner), *REP))
    assert got == [("g", "1", "lib/z.rb", 2), ("h", "1", "h.gemspec", 1), ("k", "1", "lib/k.rb", 2)]


def test_resolve_roots_all_fallbacks(spark):
    listing = spark.createDataFrame([(p,) for p in [
        "a/1.0/index.js", "b/v1.0-rc/index.js", "b/v1.0/index.js", "c@2.0/index.js",
        "@scope-d/3.0/x.js", "e/9.9/x.js", "@s/f/1.0/x.js"]], "path string")
    labels = spark.createDataFrame([("a", "1.0"), ("b", "1.0"), ("c", "2.0"), ("d", "3.0"),
                                    ("e", "1.0"), ("zz", "1"), ("@s/f", "1.0")], "package string, version string")
    got = sorted(rows(RT.resolve_roots(labels, listing, "npm", materialize=False)))
    assert got == [("@s/f", "1.0", "@s/f", "1.0"), ("a", "1.0", "a", "1.0"), ("b", "1.0", "b", "v1.0"), ("c", "2.0", "c@2.0", None),
                   ("d", "3.0", "@scope-d", "3.0"), ("e", "1.0", None, None), ("zz", "1", None, None)]
    files = RT.files_under_roots(RT.resolve_roots(labels, listing, "npm", materialize=False), listing)
    assert sorted(rows(files, "package", "version", "rel_path")) == [("@s/f", "1.0", "x.js"), ("a", "1.0", "index.js"), ("b", "1.0", "index.js"),
                                   ("c", "2.0", "index.js"), ("d", "3.0", "x.js")]


def test_resolve_package_prefix_for_pypi(spark):
    listing = spark.createDataFrame([("requests-2.0/2.0/a.py",), ("requests-toolbelt/2.0/b.py",)], "path string")
    labels = spark.createDataFrame([("requests", "2.0")], "package string, version string")
    assert rows(RT.resolve_roots(labels, listing, "pypi", materialize=False)) == [
        ("requests", "2.0", "requests-2.0", "2.0")]


def test_npm_descriptions_missing_and_manifest(spark):
    files = _files(spark, [("p", "1", "index.js", 30, "const cp = require('child_process'); cp.fork('x')"),
                           ("p", "1", "package.json", 40, '{"scripts": {"install": "node x"}}'),
                           ("q", "2", "README", 1, "")])
    labels = spark.createDataFrame([("p", "1", 1), ("q", "2", 0), ("r", "3", 0)],
                                   "package string, version string, label int")
    got = sorted(rows(D.npm_descriptions(labels, files), "package", "textual_description"))
    assert got == [
        ("p", "start entry p/1, import process module, use process module call, modify startup behavior, end of entry"),
        ("q", "start entry q/2, no notable behavior, end of entry"),
        ("r", "start entry r/3, no javascript file, end of entry")]


def test_python_and_ruby_fixed_sentences(spark):
    files = _files(spark, [("p", "1", "README", 1, ""), ("g", "1", "README", 1, "")])
    labels = spark.createDataFrame([("p", "1", 1), ("x", "9", 0)], "package string, version string, label int")
    got = sorted(rows(D.pypi_descriptions(labels, files), "textual_description"))
    assert got == [("start entry p/1, no python file, end of entry",),
                   ("start entry x/9, no source found, end of entry",)]
    rb = D.ruby_descriptions(spark.createDataFrame([("g", "1", 1)], "package string, version string, label int"), files)
    assert rows(rb, "textual_description") == [("start entry g/1, no ruby file, end of entry",)]


def _brute_roots(listing, labels, ecosystem):
    """Per-row Python restatement of C1-C4 with the deterministic 'first'."""
    parts = [p.split("/") for p in listing]
    tops = {p[0] for p in parts if len(p) >= 2}
    dirs = {(p[0], p[1]) for p in parts if len(p) >= 3}
    out = []
    for pkg, ver in labels:
        if pkg in tops:
            pdir = pkg
        else:
            key = pkg if ecosystem == "pypi" else pkg.split("/")[-1]
            ok = [t for t in tops if (t.startswith(key) if ecosystem == "pypi" else t.endswith(key))]
            pdir = min(ok, key=lambda t: (len(t), t)) if ok else None
        if pdir is not None and (pdir, ver) in dirs:
            out.append((pkg, ver, pdir, ver))
            continue
        hits = [s for t, s in dirs if t == pdir and ver in s]
        if hits:
            out.append((pkg, ver, pdir, min(hits, key=lambda s: (len(s), s))))
        elif f"{pkg}@{ver}" in tops:
            out.append((pkg, ver, f"{pkg}@{ver}", None))
        else:
            out.append((pkg, ver, None, None))
    return sorted(out, key=repr)


def test_resolve_roots_hot_package_matches_brute_force(spark):
    """One package holds most directories, and short versions occur in many of
    them: every label row still gets the one root the per-row rule picks."""
    import random
    rnd = random.Random(7)
    listing, labels = [], []
    for i in range(400):  # the hot package: many release directories
        listing.append(f"hot/r{rnd.randint(0, 60)}.{rnd.randint(0, 9)}-{rnd.choice('abc')}/f.js")
    for v in ["1", "2", "3.1", "9", "0.1", "12", "r1", "x"]:
        labels.append(("hot", v))
    for j in range(30):  # small packages with exact, contains, @ and missing layouts
        pkg, ver = f"p{j}", f"{j % 4}.{j % 3}"
        layout = j % 4
        if layout == 0:
            listing.append(f"{pkg}/{ver}/i.js")
        elif layout == 1:
            listing.append(f"{pkg}/v{ver}-final/i.js")
            listing.append(f"{pkg}/release-{ver}/i.js")
        elif layout == 2:
            listing.append(f"{pkg}@{ver}/i.js")
        labels.append((pkg, ver))
        labels.append((pkg, "7.7"))
    for scoped in ["@s/utils", "@t/utils"]:  # two packages sharing one suffix key
        labels.append((scoped, "1.0"))
    listing += ["x-utils/1.0/a.js", "utils/1.0/a.js", "my-utils/1.0/b.js"]
    listing = sorted(set(listing))
    ldf = spark.createDataFrame([(p,) for p in listing], "path string").repartition(5)
    lab = spark.createDataFrame(labels, "package string, version string")
    got = sorted(rows(RT.resolve_roots(lab, ldf, "npm", materialize=True)), key=repr)
    assert got == _brute_roots(listing, labels, "npm")
    # one output row per label row: the fallbacks never fan out
    assert len(got) == len(labels)
