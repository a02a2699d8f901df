"""Ranking metrics as exact distributed aggregations over distinct scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.timeline import along

SLOTS = 4096


def _by_score(df: DataFrame, label: str, score: str) -> DataFrame:
    """Positives and rows per distinct score, combined map-side."""
    positive = F.col(label).cast("double")
    return df.groupBy(F.col(score).alias("threshold")).agg(
        F.sum(positive).alias("pos"), F.count(F.lit(1)).cast("double").alias("n")
    )


def _slot(threshold: Column) -> Column:
    return F.floor(threshold * SLOTS)


def pr_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """Precision, recall and F1 when everything at or above each score counts as positive.

    Scores lie in [0, 1]; the running sums go downwards from the highest score.
    """
    points = _by_score(df, label, score).withColumn("__down", -F.col("threshold"))
    swept = along(
        points,
        [],
        ["__down"],
        _slot(F.col("__down")),
        running={"tp": F.col("pos"), "predicted": F.col("n")},
    )
    total = points.agg(F.sum("pos").alias("positives")).first()["positives"]
    rated = swept.withColumn("positives", F.lit(total).cast("double"))
    f1 = F.try_divide(2 * F.col("tp"), F.col("predicted") + F.col("positives"))
    return rated.select(
        "threshold",
        "pos",
        "tp",
        "predicted",
        "positives",
        F.try_divide("tp", "predicted").alias("precision"),
        F.try_divide("tp", "positives").alias("recall"),
        F.coalesce(f1, F.lit(0.0)).alias("f1"),
    )


def best_threshold(curve: DataFrame) -> DataFrame:
    """The point with the greatest F1; among equals the lowest threshold."""
    point = F.struct("threshold", "f1", "precision", "recall")
    rank = F.struct(F.round("f1", 12), -F.col("threshold"))
    return curve.agg(F.max_by(point, rank).alias("best")).select("best.*")


def average_precision(curve: DataFrame) -> DataFrame:
    """Sum of precision weighted by the gain in recall."""
    gain = F.try_divide("pos", "positives")
    return curve.agg(F.sum(gain * F.col("precision")).alias("average_precision"))


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Chance that a positive scores above a negative, ties counting half."""
    points = _by_score(df, label, score).withColumn("neg", F.col("n") - F.col("pos"))
    swept = along(
        points, [], ["threshold"], _slot(F.col("threshold")), running={"neg_so_far": F.col("neg")}
    )
    below = F.col("neg_so_far") - F.col("neg")
    wins = F.sum(F.col("pos") * (below + F.col("neg") / 2))
    return swept.agg(
        F.try_divide(wins, F.sum("pos") * F.sum("neg")).alias("roc_auc"),
        F.sum("pos").cast("bigint").alias("positives"),
        F.sum("neg").cast("bigint").alias("negatives"),
    )
