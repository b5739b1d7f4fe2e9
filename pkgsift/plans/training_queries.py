"""Registered queries of the training side: token batches, leakage-free split,
record-aligned CSV, generation, saved detectors, the metrics document (R2-R4, E7, A1, S4, E6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pkgsift.functions import prompts as PR
from pkgsift.operators import batches as BA
from pkgsift.operators import split as SP
from pkgsift.plans import detector as DT
from pkgsift.sources import csv_records as CR
from pkgsift.sources import fixtures as FX
from pkgsift.sources import sinks as SK

BATCH, MAX_LENGTH, WIDTH, PAD = 16, 4096, 64, 0


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = FX.spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang"), "doc_id")
    return docs.join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").where("text is not null")


def token_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R4 on character ids of training prompts: batches of like length, truncated, padded and masked."""
    rows = _labelled(spark, sf_dir).select("doc_id", PR.char_ids(PR.build_prompt(F.col("text"), F.col("toxic"))).alias("ids"))
    template = F.array(*[F.lit(ord(c)) for c in PR.RESPONSE_MARKER])
    dealt = BA.token_batches(rows, "doc_id", "ids", template, BATCH, MAX_LENGTH, PAD, WIDTH)
    return dealt.select("doc_id", "batch", F.size("input_ids").alias("width"),
                        F.size(F.filter("attention_mask", lambda x: x == 1)).alias("n_tokens"),
                        F.size(F.filter("labels", lambda x: x != PR.IGNORE_INDEX)).alias("n_loss"),
                        F.md5(F.array_join("input_ids", ",")).alias("ids_md5"), F.md5(F.array_join("labels", ",")).alias("labels_md5"))


_TOKEN_BATCHES = f"""
WITH p AS (
  SELECT d.doc_id, {_q(PR.PROMPT_HEAD)} || d.text || {_q(PR.PROMPT_TAIL)} || CAST(l.toxic AS VARCHAR) AS prompt
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE d.text IS NOT NULL),
i AS (SELECT doc_id, list_transform(string_split(prompt, ''), lambda c: CAST(unicode(c) AS INTEGER))[1:{MAX_LENGTH}] AS ids FROM p),
n AS (SELECT *, len(ids) AS n, len(ids) // {WIDTH} AS bucket FROM i),
o AS (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY md5('42|' || doc_id), doc_id) - 1 AS place FROM n),
f AS (SELECT bucket, coalesce(sum(ceil(count(*) / {BATCH})) OVER (ORDER BY bucket ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first
      FROM n GROUP BY bucket),
b AS (SELECT o.*, CAST(first + place // {BATCH} AS BIGINT) AS batch FROM o JOIN f USING (bucket)),
t AS (SELECT list_transform(string_split({_q(PR.RESPONSE_MARKER)}, ''), lambda c: CAST(unicode(c) AS INTEGER)) AS templ),
s AS (SELECT b.*, max(n) OVER (PARTITION BY batch) AS width,
             list_max(list_filter(range(1, n - len(templ) + 2), lambda k: ids[k:k + len(templ) - 1] = templ)) AS start FROM b, t)
SELECT doc_id, batch, CAST(width AS INTEGER) AS width, CAST(n AS INTEGER) AS n_tokens,
       CAST(CASE WHEN start IS NULL THEN 0 ELSE n - start + 1 END AS INTEGER) AS n_loss,
       md5(array_to_string(list_concat(ids, list_transform(range(width - n), lambda x: {PAD})), ',')) AS ids_md5,
       md5(array_to_string(list_concat(list_transform(ids, lambda x, k: CASE WHEN start IS NULL OR k < start THEN {PR.IGNORE_INDEX} ELSE x END),
                                       list_transform(range(width - n), lambda x: {PR.IGNORE_INDEX})), ',')) AS labels_md5
FROM s"""


def _grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twelve neighbouring documents are a package; equal texts link packages."""
    return _labelled(spark, sf_dir).select(
        "doc_id", F.concat(F.lit("pkg-"), F.floor(F.col("doc_id") / F.lit(12.0)).cast("string")).alias("package"),
        F.md5("text").alias("sentence"), F.col("toxic").cast("int").alias("label"))


def leakage_free_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E7, Q19 option: no package and no sentence stands on two sides; sizes by the exact rule."""
    return SP.leakage_free_split(_grouped(spark, sf_dir), "package", ("sentence",)).select("doc_id", "package", "label", "split")


_LEAKAGE_FREE = r"""
WITH RECURSIVE d AS (
  SELECT d.doc_id, 'pkg-' || CAST(CAST(floor(d.doc_id / 12.0) AS BIGINT) AS VARCHAR) AS package, md5(d.text) AS s, CAST(l.toxic AS INTEGER) AS label
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE d.text IS NOT NULL),
e AS (SELECT DISTINCT a.package AS u, b.package AS v FROM d a JOIN d b USING (s)),
r AS (SELECT u, v FROM e UNION SELECT r.u, e.v FROM r JOIN e ON r.v = e.u),
g AS (SELECT u AS package, 'g' || min(v) AS grp FROM r GROUP BY u),
units AS (SELECT grp, count(*) AS n, max(label) AS label, md5('42|' || grp) AS o FROM d JOIN g USING (package) GROUP BY grp),
cls AS (SELECT label, sum(n) AS n_c FROM units GROUP BY label),
tot AS (SELECT sum(n_c) AS n, CAST(ceil(CAST(0.1 AS DOUBLE) * sum(n_c)) AS BIGINT) AS n_test FROM cls),
t0 AS (SELECT label, n_c, n, n_test, (n_test * n_c) // n AS fl, (n_test * n_c) % n AS rem FROM cls, tot),
t1 AS (SELECT *, fl + CASE WHEN row_number() OVER (ORDER BY rem DESC, label) <= n_test - sum(fl) OVER () THEN 1 ELSE 0 END AS t FROM t0),
v0 AS (SELECT *, n_c - t AS r, n - n_test AS m, CAST(ceil(CAST(0.1 AS DOUBLE) / (1.0 - CAST(0.1 AS DOUBLE)) * (n - n_test)) AS BIGINT) AS n_val FROM t1),
v1 AS (SELECT *, (n_val * r) // m AS vfl, (n_val * r) % m AS vrem FROM v0),
q AS (SELECT label, t, vfl + CASE WHEN row_number() OVER (ORDER BY vrem DESC, label) <= n_val - sum(vfl) OVER () THEN 1 ELSE 0 END AS v FROM v1),
small AS (SELECT u.*, q.t, q.v, coalesce(sum(u.n) OVER w, 0) AS before FROM units u JOIN q USING (label)
          WHERE u.n * 4 <= greatest(least(q.t, q.v), 4)
          WINDOW w AS (PARTITION BY u.label ORDER BY u.o, u.grp ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
a AS (SELECT *, before + n <= t AS in_test FROM small),
b AS (SELECT *, coalesce(sum(CASE WHEN in_test THEN n END) OVER (PARTITION BY label), 0) AS ut FROM a),
c AS (SELECT *, NOT in_test AND before - ut + n <= v AS in_val FROM b),
f AS (SELECT *, coalesce(sum(CASE WHEN in_val THEN n END) OVER (PARTITION BY label), 0) AS uv,
             NOT in_test AND NOT in_val AND n = 1 AS single FROM c),
h AS (SELECT *, coalesce(sum(CASE WHEN single THEN 1 ELSE 0 END) OVER (PARTITION BY label ORDER BY o, grp ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place FROM f),
s AS (SELECT grp, CASE WHEN in_test THEN 'test' WHEN in_val THEN 'validation' WHEN single AND place < t - ut THEN 'test'
                       WHEN single AND place < t - ut + v - uv THEN 'validation' END AS split FROM h)
SELECT d.doc_id, d.package, d.label, coalesce(s.split, 'train') AS split FROM d JOIN g USING (package) LEFT JOIN s USING (grp)"""


def csv_parallel_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1, A4: documents written as quoted CSV, with quotes and line ends inside fields, read by byte ranges."""
    out = SK.scratch_folder(spark, "parallel-csv")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    text = F.concat(F.lit('say "'), F.col("text"), F.lit('",\n"x'))
    SK.write_table(docs.select("doc_id", text.alias("text"), F.col("lang").alias("la ng")), out, "csv")
    rows = CR.read_csv_parallel(spark, out)
    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.md5("text").alias("text_md5"), F.col("la ng").alias("lang"))


_CSV_PARALLEL = """SELECT doc_id, md5('say "' || text || '",' || chr(10) || '"x') AS text_md5, lang FROM documents"""


def _fixed_generator():
    """A stand-in for a language model: echoes its prompt and answers 1 if the text speaks of a URL."""
    def answer(prompts):
        import numpy as np

        return np.array([f"{p} {int('use URL' in p)} 0 1" for p in prompts], object)

    return answer


def generator_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2 with a generative model behind ``predict_batch_udf``: prompts out, completions parsed, over validation and test."""
    from pkgsift.plans import catalog

    held = catalog.queries()["stratified_split"](spark, sf_dir).where("split <> 'train'")
    scored = [DT.score_with_generator(held.where(F.col("split") == name), _fixed_generator, batch_size=64, text_col="textual_description")
              .withColumn("split", F.lit(name)) for name in ("validation", "test")]
    return scored[0].unionByName(scored[1])


def saved_detector_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A detector fitted, saved, loaded again and applied."""
    from pkgsift.plans import catalog

    split = catalog.queries()["stratified_split"](spark, sf_dir).select(
        F.col("textual_description").alias("text"), F.col("label").cast("string").alias("label"), "split").where("text is not null")
    path = SK.scratch_folder(spark, "detector")
    DT.save_detector(DT.fit_detector(split.where("split = 'train'")), path, spark)
    model = DT.load_detector(path)
    return model.transform(split.where("split <> 'train'")).select("text", "label", "split", F.col("_pred").cast("int").cast("string").alias("pred"))


def metrics_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics per language written as one JSON document and read back."""
    from pkgsift.operators.metrics import detection_metrics

    rows = _labelled(spark, sf_dir).select("lang", F.col("toxic").cast("string").alias("label"), F.col("quality").cast("string").alias("pred"))
    out = SK.scratch_folder(spark, "metrics")
    SK.write_metrics_json(detection_metrics(rows, group_cols=["lang"]), out, "lang")
    kinds = "map<string, struct<accuracy: double, precision: double, recall: double, f1: double>>"
    return (spark.read.schema("metrics string").json(out).select(F.explode(F.from_json("metrics", kinds)).alias("lang", "m"))
            .select("lang", "m.accuracy", "m.precision", "m.recall", "m.f1"))


def label_table_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rank of every row in the written label file: malicious first, then package and version."""
    from pkgsift.operators import labels as L
    from pkgsift.sources import review_csv as RC

    tables = L.build_labels(RC.resolve_review_columns(FX.package_info(spark, sf_dir), "npm"), "drop")
    out = SK.scratch_folder(spark, "ordered-labels")
    SK.write_label_tables(tables, out)
    # files are named in the order of their partitions, rows stand in the files' order
    lines = CR.records(spark, f"{out}/labels_version").select("file", "block", "seq", F.from_csv("record", "package string, version string, label string", CR.CSV_OPTIONS).alias("r"))
    rows = lines.select("file", "block", "seq", "r.*").where("label <> 'label'")
    # a file is what one task wrote: places inside files, and one row per file for the rows before it
    before = Window.orderBy("_f").rowsBetween(Window.unboundedPreceding, -1)
    first = rows.groupBy(F.col("file").alias("_f")).agg(F.count("*").alias("n")).withColumn("off", F.coalesce(F.sum("n").over(before), F.lit(0)))
    own = F.row_number().over(Window.partitionBy("file").orderBy("block", "seq")) - 1
    return (rows.withColumn("own", own).join(first, F.col("file") == F.col("_f"))
            .select("package", "version", F.col("label").cast("int").alias("label"), (F.col("off") + F.col("own")).cast("long").alias("rank")))


def archive_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members of damaged archives, each with whether it could be read."""
    from pkgsift.sources import archives as AR

    found = AR.expand_archives(FX.damaged_archives(spark, sf_dir), (".py",)).where("member is not null")
    return found.select("package", "version", "member", F.col("error").isNull().alias("ok"), F.md5("content").alias("digest"))


_SALVAGE = f"""WITH {FX.CODE_FILES_SQL},
f AS (SELECT package, version, package || '-' || version || '/' || path AS member, content,
             row_number() OVER (PARTITION BY package, version ORDER BY path) AS k, count(*) OVER (PARTITION BY package, version) AS n
      FROM code_files WHERE ecosystem = 'pypi' AND content IS NOT NULL),
g AS (SELECT *, NOT (version = '1.2' AND k = n AND length(content) > 1) AS ok FROM f WHERE NOT (version = '1.0' AND k = 2))
SELECT package, version, member, ok, CASE WHEN ok THEN md5(content) END AS digest FROM g"""


def queries() -> dict:
    return {f.__name__: f for f in (token_batches, leakage_free_split, csv_parallel_read, generator_scores, saved_detector_scores, metrics_document, label_table_order, archive_salvage)}


def oracles(found: dict[str, str]) -> dict[str, str]:
    """SQL of these queries; some build on that of others."""
    prompts = found["stratified_split"]
    return {
        "token_batches": _TOKEN_BATCHES, "leakage_free_split": _LEAKAGE_FREE, "csv_parallel_read": _CSV_PARALLEL, "archive_salvage": _SALVAGE,
        "generator_scores": f"""WITH s AS ({prompts}) SELECT textual_description AS text, CAST(label AS VARCHAR) AS label,
CASE WHEN contains(textual_description, 'use URL') THEN '1' ELSE '0' END AS pred, split FROM s WHERE split <> 'train'""",
        "saved_detector_scores": found["detector_scores"],
        "metrics_document": f"SELECT lang, accuracy, precision, recall, f1 FROM ({found['detection_metrics']})",
        "label_table_order": f"""SELECT package, version, label, row_number() OVER (ORDER BY label DESC, package, version) - 1 AS rank
FROM ({found['label_versions_drop']})"""}
