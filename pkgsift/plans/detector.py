"""Learn / score stage.

The reference fine-tunes a large language model on one GPU host.  Here the
same task – a binary detector over the behaviour sentences – counts the
sentence's comma-separated behaviour phrases.  The phrases come from fixed
dictionaries, so they are the whole vocabulary.  Two models:

* ``bayes`` (default): multinomial naive Bayes with add-one counts.  One
  aggregate over the training rows gives a weight per phrase; a score is the sum
  of a row's weights, an expression without a join.
* ``logistic``: a ``pyspark.ml`` pipeline with a logistic regression.

A caller who has a generative model can score through ``score_with_generator``
instead: the model is wrapped in an Arrow-batched ``predict_batch_udf`` and its
completions are parsed as the reference does.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, RegexTokenizer, SQLTransformer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pkgsift.functions import evidence as EV
from pkgsift.functions import phrases as PH
from pkgsift.functions import prompts as PR
from pkgsift.operators.metrics import detection_metrics
from pkgsift.sources.review_csv import label_digit


def _vocabulary() -> list[str]:
    imports = {f"import {v}" for d in (PH.NPM_IMPORTS, PH.PYPI_IMPORTS, PH.RUBY_REQUIRES) for v in d.values()}
    calls = {p for _, p in (*PH.PYPI_CALLS, *PH.RUBY_CALLS) if p}
    fixed = {PH.OS_CALL, PH.PROC_CALL, PH.EVAL_PHRASE, PH.URL_PHRASE, PH.STARTUP_PHRASE, "use base64 string", EV.NO_BEHAVIOR,
             "no javascript file", "no source found", "no python file", "no ruby file"}
    return sorted(imports | calls | fixed)


#: Every phrase a sentence can hold.
VOCABULARY = _vocabulary()


def body_phrases(text: Column) -> Column:
    """A sentence's phrases without "start entry {pkg}/{id}" and "end of entry":
    ids of single rows are no features."""
    parts = F.split(text, ", ")
    return F.slice(parts, 2, F.greatest(F.size(parts) - 2, F.lit(0)))


@dataclass(frozen=True)
class BayesDetector:
    """Log odds of label 1: a prior and a weight per phrase."""

    prior: float
    weights: tuple[tuple[str, float], ...]

    def score(self, text: Column) -> Column:
        table = F.create_map(*[F.lit(x) for pair in self.weights for x in pair])
        known = F.filter(F.transform(body_phrases(text), lambda p: F.try_element_at(table, p)), lambda w: w.isNotNull())
        return F.round(F.lit(self.prior) + F.aggregate(known, F.lit(0.0), lambda a, w: a + w), 9)

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn("_pred", (self.score(F.col("text")) > 0).cast("double"))


def fit_bayes(train: DataFrame, text_col: str = "text", label_col: str = "label") -> BayesDetector:
    """Counts per phrase of the dictionaries and label, add-one smoothed."""
    y = F.col(label_col).cast("int")
    rows = train.select(y.alias("y"), body_phrases(F.col(text_col)).alias("ps")).where("y in (0, 1)")
    docs = rows.agg(F.count_if(F.col("y") == 1), F.count_if(F.col("y") == 0)).first()
    found = {r["p"]: (r["n1"], r["n0"]) for r in rows.select("y", F.explode("ps").alias("p")).where(F.col("p").isin(VOCABULARY))
             .groupBy("p").agg(F.count_if(F.col("y") == 1).alias("n1"), F.count_if(F.col("y") == 0).alias("n0")).collect()}
    total = [sum(n[k] for n in found.values()) + len(VOCABULARY) for k in (0, 1)]
    counts = {p: found.get(p, (0, 0)) for p in VOCABULARY}
    weights = tuple((p, math.log((n1 + 1) / total[0]) - math.log((n0 + 1) / total[1])) for p, (n1, n0) in counts.items())
    return BayesDetector(math.log((docs[0] + 1) / (docs[1] + 1)), weights)


def detector_pipeline(text_col: str = "text", reg: float = 0.01, max_iter: int = 50) -> Pipeline:
    """Behaviour-phrase bag → logistic regression."""
    bag = CountVectorizerModel.from_vocabulary(VOCABULARY, inputCol="_body", outputCol="_features")
    return Pipeline(stages=[
        RegexTokenizer(inputCol=text_col, outputCol="_phrases", pattern=", ", toLowercase=False),
        SQLTransformer(statement="SELECT *, slice(_phrases, 2, greatest(size(_phrases) - 2, 0)) "
                                 "AS _body FROM __THIS__"),
        bag,
        LogisticRegression(featuresCol="_features", labelCol="_y", predictionCol="_pred",
                           probabilityCol="_prob", rawPredictionCol="_raw",
                           regParam=reg, maxIter=max_iter),
    ])


def fit_detector(train: DataFrame, text_col: str = "text", label_col: str = "label",
                 kind: str = "bayes", **kw) -> BayesDetector | PipelineModel:
    """Fit on the training split (label "0"/"1" strings or ints)."""
    if kind == "bayes":
        return fit_bayes(train, text_col, label_col)
    if kind != "logistic":
        raise ValueError("kind must be 'bayes' or 'logistic'")
    data = train.select(F.col(text_col).alias("text"), F.col(label_col).cast("double").alias("_y"))
    return detector_pipeline("text", **kw).fit(data)


def score(model: PipelineModel, df: DataFrame, text_col: str = "text",
          label_col: str = "label") -> DataFrame:
    """R2: (text, label, pred) with string labels, as the reference writes them."""
    data = df.select(F.col(text_col).alias("text"), F.col(label_col).cast("string").alias("label"))
    out = model.transform(data)
    return out.select("text", "label", F.col("_pred").cast("int").cast("string").alias("pred"))


def score_with_generator(df: DataFrame, make_predict_fn: Callable, batch_size: int = 4,
                         text_col: str = "text", label_col: str = "label") -> DataFrame:
    """R2 with a caller-supplied generative model.

    ``make_predict_fn`` follows ``pyspark.ml.functions.predict_batch_udf``:
    it returns a function from a numpy array of prompts to a numpy array of
    generated texts.  Prompts are rendered without the label (G12).
    """
    from pyspark.ml.functions import predict_batch_udf
    from pyspark.sql.types import StringType

    gen = predict_batch_udf(make_predict_fn, return_type=StringType(), batch_size=batch_size)
    prompts = df.select(F.col(text_col).alias("text"), F.col(label_col).cast("string").alias("label"),
                        PR.build_prompt(F.col(text_col)).alias("_prompt"))
    return prompts.select("text", "label", PR.prediction(gen("_prompt")).alias("pred"))


def save_detector(model: BayesDetector | PipelineModel, path: str, spark: SparkSession | None = None) -> None:
    if isinstance(model, BayesDetector):
        spark = spark or SparkSession.active()
        rows = [(None, model.prior), *model.weights]
        spark.createDataFrame(rows, "phrase string, weight double").write.mode("overwrite").parquet(f"{path}/bayes")
    else:
        model.write().overwrite().save(f"{path}/logistic")


def load_detector(path: str, kind: str = "bayes") -> BayesDetector | PipelineModel:
    """Predict-only mode starts from a saved model."""
    if kind == "logistic":
        return PipelineModel.load(f"{path}/logistic")
    rows = SparkSession.active().read.parquet(f"{path}/bayes").collect()  # one row per phrase of the dictionaries
    weights = tuple(sorted((r["phrase"], r["weight"]) for r in rows if r["phrase"] is not None))
    return BayesDetector(next(r["weight"] for r in rows if r["phrase"] is None), weights)


def train_and_evaluate(split_df: DataFrame, text_col: str = "textual_description",
                       label_col: str = "label", **kw):
    """L3 end to end on a split table → (model, predictions on validation + test,
    metrics per split).  Labels go through the B8 rule (first 0/1 character)."""
    data = (split_df.select(F.col(text_col).alias("text"),
                            label_digit(F.col(label_col)).alias("label"), "split")
            .where(F.col("label").isNotNull() & F.col("text").isNotNull()))
    train = data.where(F.col("split") == "train").persist()
    model = fit_detector(train, **kw)  # several passes over the training rows
    train.unpersist()
    held = data.where(F.col("split").isin("validation", "test"))
    scored = model.transform(held).select(
        "text", "label", "split", F.col("_pred").cast("int").cast("string").alias("pred"))
    return model, scored, detection_metrics(scored, group_cols=["split"])
