"""Detection metrics (D7): accuracy and binary precision / recall / F1.

Positive class "1"; a zero denominator gives 0 (scikit-learn's
``zero_division=0``).  One aggregation pass with partial aggregation, per
group when ``group_cols`` is given.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _ratio(num: Column, den: Column) -> Column:
    return F.when(den > 0, num.cast("double") / den.cast("double")).otherwise(F.lit(0.0))


def detection_metrics(pred: DataFrame, label_col: str = "label", pred_col: str = "pred",
                      group_cols=(), positive: str = "1") -> DataFrame:
    """(group..., n, accuracy, precision, recall, f1) from string labels and predictions."""
    y = F.col(label_col).cast("string")
    p = F.col(pred_col).cast("string")
    counts = pred.groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(y == p).alias("_ok"),
        F.count_if((p == positive) & (y == positive)).alias("_tp"),
        F.count_if((p == positive) & (y != positive)).alias("_fp"),
        F.count_if((p != positive) & (y == positive)).alias("_fn"))
    tp, fp, fn = F.col("_tp"), F.col("_fp"), F.col("_fn")
    return counts.select(
        *group_cols, "n",
        _ratio(F.col("_ok"), F.col("n")).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"))
