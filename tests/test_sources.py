import io
import tarfile
import zipfile

from pyspark.sql import functions as F

from conftest import rows
from pkgsift.plans import describe as D
from pkgsift.sources import archives as A
from pkgsift.sources import tree as TR


def _tar_bytes(members, mode="w:gz"):
    buf = io.BytesIO()
    with tarfile.open(fileobj=buf, mode=mode) as tf:
        for name, data in members:
            ti = tarfile.TarInfo(name)
            ti.size = len(data)
            tf.addfile(ti, io.BytesIO(data))
        link = tarfile.TarInfo("evil-link")
        link.type = tarfile.SYMTYPE
        link.linkname = "/etc/passwd"
        tf.addfile(link)
    return buf.getvalue()


def _zip_bytes(members):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as zf:
        for name, data in members:
            zf.writestr(name, data)
    return buf.getvalue()


def _tree(tmp_path):
    root = tmp_path / "pypi"
    (root / "pkg-a" / "1.0" / "src" / "pkg_a").mkdir(parents=True)
    (root / "pkg-a" / "1.0" / "src" / "pkg_a" / "__init__.py").write_text("import os\nos.system('x')\n")
    (root / "pkg-b" / "2.0").mkdir(parents=True)
    (root / "pkg-b" / "2.0" / "pkg_b-2.0.tar.gz").write_bytes(
        _tar_bytes([("pkg_b-2.0/pkg_b/__init__.py", b"import socket\n"), ("../x.py", b"eval(1)\n")]))
    (root / "pkg-b" / "2.0" / "pkg_b-2.0.zip").write_bytes(_zip_bytes([("z.py", b"import sys\n")]))
    (root / "pkg-c" / "3.0").mkdir(parents=True)
    (root / "pkg-c" / "3.0" / "bad.zip").write_bytes(b"not a zip")
    (root / "pkg-c" / "3.0" / "bin.py").write_bytes(b"print('\xff\xfe ok')\n")
    return root


def test_list_and_read_tree(spark, tmp_path):
    root = _tree(tmp_path)
    listing = rows(TR.list_tree(spark, str(root)).orderBy("path"), "path")
    assert ("pkg-a/1.0/src/pkg_a/__init__.py",) in listing and len(listing) == 5
    body = dict(rows(TR.read_tree(spark, str(root), glob="*.py"), "path", "content"))
    assert body["pkg-c/3.0/bin.py"] == "print(' ok')\n"     # invalid bytes dropped


def test_expand_archives_safely(spark, tmp_path):
    root = _tree(tmp_path)
    members = A.expand_archives(TR.archives(spark, str(root)).drop("size"))
    got = sorted(rows(members.where("error IS NULL AND member IS NOT NULL"), "path", "member"))
    assert got == [("pkg-b/2.0/pkg_b-2.0.tar.gz", "../x.py"),
                   ("pkg-b/2.0/pkg_b-2.0.tar.gz", "pkg_b-2.0/pkg_b/__init__.py"),
                   ("pkg-b/2.0/pkg_b-2.0.zip", "z.py")]            # the symlink is skipped
    bad = rows(members.where("error IS NOT NULL"), "path")
    assert bad == [("pkg-c/3.0/bad.zip",)]
    assert sorted(rows(members.where("error IS NULL AND member IS NULL"), "path")) == [
        ("pkg-b/2.0/pkg_b-2.0.tar.gz",), ("pkg-b/2.0/pkg_b-2.0.zip",)]   # read to their ends


def test_padding_hides_no_member(spark):
    """No limit on members, sizes or ratios (a reader without them cannot be led astray)."""
    big = b"x = 1\n" * 3_000_000                                          # 18 MB, compresses 300:1
    files = [("a.py", b"import os\n"), ("b.py", big), *((f"n{k}.txt", b"") for k in range(21_000)), ("c.py", b"eval(1)\n"), ("./.hidden.py", b"y")]
    inner = _tar_bytes(files)
    gem = io.BytesIO()
    with tarfile.open(fileobj=gem, mode="w") as tf:
        ti = tarfile.TarInfo("data.tar.gz")
        ti.size = len(inner)
        tf.addfile(ti, io.BytesIO(inner))
    df = spark.createDataFrame([("p/1/x.tar.gz", bytearray(inner)), ("p/1/x.zip", bytearray(_zip_bytes(files))), ("p/1/x.gem", bytearray(gem.getvalue()))],
                               "path string, bytes binary")
    got = rows(A.expand_archives(df, (".py",)).where("member IS NOT NULL"), "path", "member", "size")
    assert sorted(got) == sorted((p, m, s) for p in ("p/1/x.gem", "p/1/x.tar.gz", "p/1/x.zip")
                                 for m, s in (("a.py", 10), ("b.py", len(big)), ("c.py", 8), (".hidden.py", 1)))


def test_gem_data_tar(spark, tmp_path):
    inner = _tar_bytes([("lib/g.rb", b"require 'open3'\n")])
    gem = io.BytesIO()
    with tarfile.open(fileobj=gem, mode="w") as tf:
        for name, data in [("metadata.gz", b"x"), ("data.tar.gz", inner)]:
            ti = tarfile.TarInfo(name)
            ti.size = len(data)
            tf.addfile(ti, io.BytesIO(data))
    df = spark.createDataFrame([("g/1.0/g-1.0.gem", bytearray(gem.getvalue()))], "path string, bytes binary")
    assert rows(A.expand_archives(df).where("error IS NULL"), "member") == [("lib/g.rb",), (None,)]


def test_pypi_archive_fallback_sentence(spark, tmp_path):
    root = _tree(tmp_path)
    files = TR.keyed_files(TR.read_tree(spark, str(root)))
    labels = spark.createDataFrame([("pkg-a", "1.0", 1), ("pkg-b", "2.0", 0), ("pkg-c", "3.0", 0)],
                                   "package string, version string, label int")
    got = dict(rows(D.pypi_descriptions(
        labels, files, expand=lambda chosen: A.expand_archives_at(spark, str(root), chosen, (".py",))), "package", "textual_description"))
    assert got["pkg-a"] == ("start entry pkg-a/1.0/pkg_a/__init__.py, import operating system module, "
                            "use operating system module call, end of entry")
    # first archive by kind order (.tar.gz before .zip); tier 1 inside it; the member path is the id
    assert got["pkg-b"] == ("start entry pkg-b/2.0/pkg_b-2.0/pkg_b/__init__.py, import network module, "
                            "end of entry")
    assert got["pkg-c"] == "start entry pkg-c/3.0/bin.py, no notable behavior, end of entry"


def test_expand_archives_at_matches_two_step(spark, tmp_path):
    root = _tree(tmp_path)
    one = sorted(rows(A.expand_archives_at(spark, str(root)), "path", "member", "error"), key=str)
    two = sorted(rows(A.expand_archives(TR.archives(spark, str(root)).drop("size")), "path", "member", "error"), key=str)
    assert [r[:2] for r in one] == [r[:2] for r in two] and len(one) == 6


def test_csv_sink_keeps_blanks_quotes_and_newlines(spark, tmp_path):
    from pkgsift.sources.review_csv import read_csv_strings
    from pkgsift.sources.sinks import write_table
    rows_in = [("  lead", "0"), ("trail  ", "1"), ('say "hi",\nbye', "1"), ("", "0")]
    write_table(spark.createDataFrame(rows_in, "text string, label string"), str(tmp_path / "t"), fmt="csv")
    back = {r.label + "|" + (r.text if r.text is not None else "<null>") for r in
            read_csv_strings(spark, str(tmp_path / "t")).collect()}
    # an empty field reads back as missing, as pandas reads it
    assert back == {"0|  lead", "1|trail  ", '1|say "hi",\nbye', "0|<null>"}
