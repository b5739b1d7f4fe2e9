import pytest
from pyspark.sql import functions as F

from conftest import rows
from pkgsift.functions.tags import normalize_tag, tag_label
from pkgsift.operators import labels as L
from pkgsift.sources.review_csv import read_review_info, resolve_review_columns


def test_normalize_tag_unicode_blanks(spark):
    tags = [" Mal ware\t", "Un-Reviewed\n", " benign　", "1", "True", "False_Positive",
            "Confirmed-Malware", "weird"]
    df = spark.createDataFrame([(t,) for t in tags], "t string")
    got = [r[0] for r in df.select(normalize_tag(F.col("t"))).collect()]
    assert got == ["malware", "unreviewed", "benign", "1", "true", "falsepositive",
                   "confirmedmalware", "weird"]


@pytest.mark.parametrize("policy,expect", [
    ("drop", [1, 0, None, 0, 0]),
    ("benign", [1, 0, 0, 0, 0]),
    ("malicious", [1, 0, 1, 0, 0]),
    ("separate", [1, 0, None, 0, 0]),
])
def test_tag_label_policies(spark, policy, expect):
    df = spark.createDataFrame([("malware",), ("clean",), ("pendingreview",), ("1",), ("x",)], "t string")
    assert [r[0] for r in df.select(tag_label(F.col("t"), policy)).collect()] == expect


def test_numeric_labels_opt_in(spark):
    df = spark.createDataFrame([("1",), ("true",), ("0",)], "t string")
    assert [r[0] for r in df.select(tag_label(F.col("t"), "drop", True)).collect()] == [1, 1, 0]


def test_unknown_policy_rejected():
    with pytest.raises(ValueError):
        tag_label(F.col("t"), "keep")


def test_build_labels_dedup_conflict_and_max(spark):
    info = spark.createDataFrame([
        ("a", "1.0", "malware"), ("a", "1.0", "malware"), ("a", "1.0", "benign"),
        ("a", "2.0", "clean"), ("b", "1.0", "unreviewed"), ("c", None, "malware"),
        (" d ", "1.10", " False Positive "),
    ], "package string, version string, threat string")
    t = L.build_labels(info, policy="separate")
    assert sorted(rows(t.versions)) == [("a", "1.0", 0), ("a", "1.0", 1), ("a", "2.0", 0), ("d", "1.10", 0)]
    assert sorted(rows(t.packages)) == [("a", 1), ("d", 0)]
    assert rows(t.unreviewed) == [("b", "1.0")]
    assert sorted(rows(L.conflicting_versions(t.versions))) == [("a", "1.0")]
    rep = {r["level"]: r for r in t.report.collect()}
    assert rep["version"]["rows"] == 4 and rep["version"]["positives"] == 1
    assert rep["package"]["pos_ratio"] == 0.5


def test_empty_report_is_null_ratio(spark):
    info = spark.createDataFrame([], "package string, version string, threat string")
    t = L.build_labels(info)
    rep = {r["level"]: r for r in t.report.collect()}
    assert rep["version"]["rows"] == 0 and rep["version"]["pos_ratio"] is None


def test_csv_reader_quotes_na_and_versions(spark, tmp_path):
    p = tmp_path / "info.csv"
    p.write_text('name,version,threat_type,extra\n'
                 'null,1.10,malware,"x, y"\n'
                 'NA,2.0,"say ""hi""",z\n'
                 '"multi\nline",1.0,NA,w\n'
                 'pkg,1.0,,q\n', encoding="utf-8")
    df = read_review_info(spark, str(p))
    got = rows(df)
    assert ("null", "1.10", "malware") in got          # names kept, 1.10 stays a string
    assert ("NA", "2.0", 'say "hi"') in got
    assert ("multi\nline", "1.0", None) in got          # NA token → null threat
    assert ("pkg", "1.0", None) in got
    assert rows(read_review_info(spark, str(p), pandas_na=True).where("package IS NULL")) != []


def test_column_aliases_and_missing(spark):
    df = spark.createDataFrame([("p", "1", "malware")], "project string, release string, status string")
    assert rows(resolve_review_columns(df, "pypi")) == [("p", "1", "malware")]
    with pytest.raises(ValueError):
        resolve_review_columns(df, "npm")


def test_directory_version_labels(spark):
    listing = spark.createDataFrame([
        ("g1/1.0/g1.gemspec",), ("g1/1.0/lib/a.rb",), ("g2/2.0/x.src/lib/b.rb",),
        ("g2/2.0/top.gemspec",), ("g3/1.0/README",), ("loose.txt",)], "rel_path string")
    got = sorted(rows(L.directory_version_labels(listing, 1)))
    assert got == [("g1", "1.0", 1), ("g2", "2.0", 1), ("g3", "1.0", 1)]
    # inside g2's *.src root there is no gemspec: the top-level one is outside the root
    assert sorted(rows(L.directory_version_labels(listing, 1, require_gemspec=True))) == [("g1", "1.0", 1)]
    assert sorted(rows(L.directory_version_labels(listing, 0, require_ruby=True))) == [
        ("g1", "1.0", 0), ("g2", "2.0", 0)]
    both = L.ruby_version_labels(listing, listing)
    assert both.count() == 6
