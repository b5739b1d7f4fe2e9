"""End-to-end jobs on small trees built in a temp folder."""
import io
import json
import tarfile
import zipfile

from pkgsift.plans import jobs


def _write(root, rel, text):
    p = root / rel
    p.parent.mkdir(parents=True, exist_ok=True)
    if isinstance(text, bytes):
        p.write_bytes(text)
    else:
        p.write_text(text, encoding="utf-8")


def _tgz(members):
    buf = io.BytesIO()
    with tarfile.open(fileobj=buf, mode="w:gz") as tf:
        for name, data in members:
            ti = tarfile.TarInfo(name)
            ti.size = len(data)
            tf.addfile(ti, io.BytesIO(data))
    return buf.getvalue()


def _zip(members):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        for name, data in members:
            z.writestr(name, data)
    return buf.getvalue()


def _gem(members):
    inner, buf = _tgz(members), io.BytesIO()
    with tarfile.open(fileobj=buf, mode="w") as tf:
        ti = tarfile.TarInfo("data.tar.gz")
        ti.size = len(inner)
        tf.addfile(ti, io.BytesIO(inner))
    return buf.getvalue()


def test_label_job_csv(spark, tmp_path):
    info = tmp_path / "info.csv"
    info.write_text("package,ver,malware\nb,1.0,Malware\na,2.0,clean\na,1.0,unknown\n", encoding="utf-8")
    t = jobs.label_job(spark, str(info), str(tmp_path / "out"), policy="separate")
    lines = [r[0] for r in spark.read.text(str(tmp_path / "out" / "labels_version")).collect()]
    assert lines == ["package,version,label", "b,1.0,1", "a,2.0,0"]    # malicious first (E6)
    assert [tuple(r) for r in t.unreviewed.collect()] == [("a", "1.0")]


def test_describe_jobs_and_train(spark, tmp_path):
    npm = tmp_path / "npm"
    for i in range(12):
        body = "const cp = require('child_process'); cp.exec('x');" if i % 2 else "console.log(1)"
        _write(npm, f"p{i}/1.0/index.js", body)
        if i % 3 == 0:
            _write(npm, f"p{i}/1.0/package.json", json.dumps({"scripts": {"postinstall": "node x"}}))
    _write(npm, "q@2.0/lib/main.js", "eval('1')")
    labels = tmp_path / "lv.csv"
    labels.write_text("package,version,label\n" + "".join(f"p{i},1.0,{i % 2}\n" for i in range(12))
                      + "q,2.0,1\nmissing,1,0\n", encoding="utf-8")
    _write(npm, "@s/scoped/1.0/index.js", "eval('1')")
    (npm / "bare" / "3.0").mkdir(parents=True)                       # a version without files
    with labels.open("a", encoding="utf-8") as f:
        f.write("@s/scoped,1.0,1\nbare,3.0,0\n")
    out = jobs.describe_job(spark, "npm", str(npm), str(tmp_path / "ds"), labels_csv=str(labels))
    got = {r["textual_description"] for r in out.collect()}
    assert "start entry q/2.0, evaluate code at run-time, end of entry" in got
    assert "start entry missing/1, no javascript file, end of entry" in got
    assert ("start entry p3/1.0, import process module, use operating system module call, "
            "modify startup behavior, end of entry") in got
    sizes = {r[0]: r[1] for r in out.groupBy("split").count().collect()}
    assert "start entry @s/scoped/1.0, evaluate code at run-time, end of entry" in got
    assert "start entry bare/3.0, no notable behavior, end of entry" in got
    assert sizes == {"train": 12, "validation": 2, "test": 2}

    pypi = tmp_path / "pypi"
    _write(pypi, "pa/1.0/src/pa/__init__.py", "import subprocess\nsubprocess.run('x')\n")
    _write(pypi, "pb/2.0/pb-2.0.tar.gz", _tgz([("pb-2.0/pb/__init__.py", b"import requests\n")]))
    _write(pypi, "pc-extra/release-3.0-final/pc-3.0.zip", _zip([("pc/__init__.py", b"import sys\n")]))   # under a fallback root
    _write(pypi, "foo@1.0/x.py", "eval('x')\n")                       # a layout of npm only
    lab2 = tmp_path / "lv2.csv"
    lab2.write_text("package,version,label\n" + "pa,1.0,1\npb,2.0,0\npa,1.0,0\npb,2.0,1\npc,3.0,1\nfoo,1.0,0\n" * 5,
                    encoding="utf-8")
    out2 = jobs.describe_job(spark, "pypi", str(pypi), str(tmp_path / "ds2"), labels_csv=str(lab2))
    got2 = {r["textual_description"] for r in out2.collect()}
    assert got2 == {"start entry pa/1.0/pa/__init__.py, import process module, use process module call, end of entry",
                    "start entry pb/2.0/pb-2.0/pb/__init__.py, import network module, end of entry",
                    "start entry pc/3.0/pc/__init__.py, import system module, end of entry",
                    "start entry foo/1.0, no source found, end of entry"}

    rb = tmp_path / "rb"
    _write(rb, "mal/g1/1.0/g1.gemspec", "require 'open-uri'\n`id`\n")
    _write(rb, "ben/g2/2.0/g2.src/lib/g2.rb", "puts 'hi'\n")
    _write(rb, "ben/g3/1.0/README", "x")
    _write(rb, "mal/g4/0.1/g4.gemspec", "system('x')\n")
    _write(rb, "ben/g5/0.2/lib/a.rb", "require 'net/http'\n")
    _write(rb, "ben/g6/1.0/g6.gem", _gem([("lib/g6.rb", b"require 'open3'\n")]))
    _write(rb, "ben/g6/1.0/other.rb", "eval('x')\n")                 # the gem goes first
    _write(rb, "ben/g7/1.0/g7.gem", b"not a gem")
    _write(rb, "ben/g7/1.0/lib/a.rb", "eval('x')\n")                 # a broken gem falls back
    (rb / "mal" / "g8" / "1.0").mkdir(parents=True)
    for i in range(8):
        _write(rb, f"mal/m{i}/1.{i}/lib/m.rb", "eval('x')\n")
        _write(rb, f"ben/b{i}/1.{i}/lib/b.rb", "puts 1\n")
    out3 = jobs.describe_job(spark, "rubygems", None, str(tmp_path / "ds3"),
                             mal_dir=str(rb / "mal"), ben_dir=str(rb / "ben"))
    got3 = {r["textual_description"] for r in out3.collect()}
    assert "start entry g1/1.0/g1.gemspec, import network module, use operating system module call, end of entry" in got3
    assert "start entry g2/2.0/lib/g2.rb, no notable behavior, end of entry" in got3
    assert "start entry g3/1.0, no ruby file, end of entry" in got3
    assert "start entry g6/1.0/lib/g6.rb, import process module, end of entry" in got3
    assert "start entry g7/1.0/lib/a.rb, evaluate code at run-time, end of entry" in got3
    assert "start entry g8/1.0, no ruby file, end of entry" in got3

    ds = tmp_path / "ds"
    model, scored, metrics = jobs.train_job(spark, str(ds / "split=train"), str(ds / "split=validation"),
                                            str(ds / "split=test"), str(tmp_path / "m"), kind="logistic")
    assert {r["split"] for r in metrics.collect()} == {"validation", "test"}
    doc = json.loads(spark.read.json(str(tmp_path / "m" / "metrics")).first()["metrics"])
    assert set(doc) == {"val", "test"} and set(doc["val"]) == {"accuracy", "precision", "recall", "f1"}
    preds = spark.read.option("header", True).csv(str(tmp_path / "m" / "preds_test"))
    assert preds.columns == ["text", "label", "pred"] and preds.count() == 2
    again, _, _ = jobs.train_job(spark, str(ds / "split=train"), str(ds / "split=validation"), str(ds / "split=test"),
                                 str(tmp_path / "m2"), predict_only=True, model_dir=str(tmp_path / "m" / "model"), kind="logistic")
    assert again is not None
    bayes, first, _ = jobs.train_job(spark, str(ds / "split=train"), str(ds / "split=validation"), str(ds / "split=test"), str(tmp_path / "m3"))
    loaded, second, _ = jobs.train_job(spark, str(ds / "split=train"), str(ds / "split=validation"), str(ds / "split=test"),
                                       str(tmp_path / "m4"), predict_only=True, model_dir=str(tmp_path / "m3" / "model"))
    assert loaded == bayes and sorted(map(tuple, first.collect())) == sorted(map(tuple, second.collect()))


def test_ruby_label_job_and_ingest(spark, tmp_path):
    from pkgsift.sources import tree
    rb = tmp_path / "rb"
    _write(rb, "mal/g1/1.0/g1.gemspec", "x")
    _write(rb, "mal/g1/1.1/x.src/lib/a.rb", "x")
    _write(rb, "ben/g2/2.0/README", "x")
    (rb / "ben" / "g3" / "1.0").mkdir(parents=True)                   # a version without files
    out = jobs.ruby_label_job(spark, str(rb / "mal"), str(rb / "ben"), str(tmp_path / "o"), require_ruby=False)
    assert sorted(tuple(r) for r in out.collect()) == [("g1", "1.0", 1), ("g1", "1.1", 1), ("g2", "2.0", 0), ("g3", "1.0", 0)]
    only_rb = jobs.ruby_label_job(spark, str(rb / "mal"), str(rb / "missing"), str(tmp_path / "o2"),
                                  require_ruby=True)
    assert [tuple(r) for r in only_rb.collect()] == [("g1", "1.1", 1)]
    tree.ingest(spark, str(rb / "mal"), "rubygems", str(tmp_path / "sf"))
    ing = spark.read.parquet(str(tmp_path / "sf"))
    assert sorted(r["path"] for r in ing.collect()) == ["g1/1.0/g1.gemspec", "g1/1.1/x.src/lib/a.rb"]
    assert ing.where("ecosystem = 'rubygems'").count() == 2
