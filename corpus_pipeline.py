"""Corpus pipeline: five operators of ``pkgsift.llm`` applied to ``documents``.

Quality rules and toxicity drop what they reject, the n-gram join leaves one
document of each near-duplicate group, mixing repeats documents towards the
source targets, and BPE encodes and decodes what is left.  Every stage but the
last returns the columns of ``documents``; each result is written as Parquet to
the shared folder and read again by the next stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pkgsift.llm import bpe, mixing, ngram_join, quality_rules, toxicity
from pkgsift.llm.common import read, table, tidy
from pkgsift.llm.queries import vocabulary
from pkgsift.session import ship_package


#: Words whose ids a worker keeps: workers serve all stages, so this one's share is small.
CACHE_WORDS = 120_000


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rules are learned from the labels of the documents that are still there."""
    tidy(spark)
    return quality_rules.keep_good(docs, quality_rules.learn(docs, read(spark, sf_dir, "labels")))


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tidy(spark)
    ship_package(spark)
    return toxicity.keep_clean(docs, toxicity.learn(docs, read(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least id of each component stays, once if its row is
    repeated; documents without words and rows without an id stay as they are.
    Where an id names several texts, each text is judged by its own component."""
    tidy(spark)
    ship_package(spark)
    found = table(ngram_join.ngram_components(docs, n=5, percent=80, with_keys=True), "components")
    repeated = found.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")
    gone = found.where("doc_id <> component_id").select("doc_id").distinct()
    if repeated.isEmpty():
        return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    # rows of repeated ids go by (id, set); one set of a component stays
    repeated = table(repeated, "repeated")
    kept = docs.join(gone.union(repeated).distinct(), "doc_id", "left_anti").select(*docs.columns)
    stays = (found.where("doc_id = component_id and s1 is not null").join(repeated, "doc_id", "left_semi")
             .groupBy("component").agg(F.min(F.struct("doc_id", "s1", "s2")).alias("m")).select("m.*"))
    again = docs.join(repeated, "doc_id", "left_semi").withColumn("_row", F.xxhash64("doc_id", "text"))
    signed = ngram_join.signatures(again.select("_row", "text").distinct()
                                   .select(F.col("_row").alias("doc_id"), F.col("text").cast("binary").alias("text")), 5)
    again = again.join(signed.select(F.col("doc_id").alias("_row"), "s1", "s2").distinct(), "_row")
    one = again.join(stays, ["doc_id", "s1", "s2"], "left_semi").dropDuplicates(["doc_id", "s1", "s2"])
    empty = again.where("s1 is null")
    return kept.unionByName(one.select(*docs.columns)).unionByName(empty.select(*docs.columns))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tidy(spark)
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tidy(spark)
    ship_package(spark)
    return bpe.encode_documents(docs, vocabulary(), keep_ids=False, cache_words=CACHE_WORDS)


STAGES = [
    ("quality rules", quality),
    ("toxicity", toxic),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources to target weights", mixture),
    ("BPE encoding and decoding", tokens),
]

#: No SQL: rules and tagger are learned, and texts are tokenized.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``: doc_id, n_tokens, ids_sha256, decoded_sha256
    of every document of the final mixture, repeats included."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = table(stage(spark, docs, sf_dir), name.split()[0])
    return STAGES[-1][1](spark, docs, sf_dir)
