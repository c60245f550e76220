"""Exact ranking metrics: ROC and precision-recall.

All of them come from one table with a row per distinct score and running
totals of positives and negatives from the highest score down. Scores are cut
into ranges of about equal size, so that the running totals are windows over
ranges, never over the whole table.
"""

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnrisk.schemas import LABEL

ROWS_PER_RANGE = 1_000_000
MAX_RANGES = 20_000
# Fixed value: points of the ROC curve.
ROC_POINTS = 100


def score_counts(scored: DataFrame, score: str, label: str = LABEL) -> DataFrame:
    """Labelled rows counted per distinct score: (score, pos, neg)."""
    known = scored.filter(F.col(label).isNotNull() & F.col(score).isNotNull())
    return known.groupBy(F.col(score).cast("double").alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg")
    )


def _cuts(counts: DataFrame, rows_per_range: int) -> list[float]:
    """Scores that cut the rows into ranges of about the given size; few rows have no cut.

    The cuts are quantiles of the distinct scores: a score shared by many rows
    is one row here, and crowded regions get narrower ranges.
    """
    parts = min(MAX_RANGES, math.ceil(counts.count() / rows_per_range))
    if parts < 2:
        return []
    probabilities = [i / parts for i in range(1, parts)]
    quantiles = counts.approxQuantile("score", probabilities, 0.25 / parts)
    return sorted({q for q in quantiles if math.isfinite(q)})


def _with_range(counts: DataFrame, cuts: list[float]) -> DataFrame:
    """Number the score ranges upward as ``part``."""
    return Bucketizer(
        # Any cut will do; the transformer wants one.
        splits=[-math.inf, *(cuts or [0.5]), math.inf],
        inputCol="score",
        outputCol="part",
        handleInvalid="keep",
    ).transform(counts)


def _totals_by_range(ranged: DataFrame) -> DataFrame:
    """Totals within each range, added to the totals of the ranges above it."""
    # One row per range, at most MAX_RANGES of them.
    from_top = Window.orderBy(F.desc("part"))
    above = from_top.rowsBetween(Window.unboundedPreceding, -1)
    whole = from_top.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    starts = (
        ranged.groupBy("part")
        .agg(F.sum("pos").alias("part_pos"), F.sum("neg").alias("part_neg"))
        .select(
            "part",
            F.coalesce(F.sum("part_pos").over(above), F.lit(0)).alias("pos_above"),
            F.coalesce(F.sum("part_neg").over(above), F.lit(0)).alias("neg_above"),
            F.sum("part_pos").over(whole).alias("positives"),
            F.sum("part_neg").over(whole).alias("negatives"),
        )
    )
    down = Window.partitionBy("part").orderBy(F.desc("score")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return ranged.join(F.broadcast(starts), "part").select(
        "score",
        "pos",
        "neg",
        (F.col("pos_above") + F.sum("pos").over(down)).alias("tp"),
        (F.col("neg_above") + F.sum("neg").over(down)).alias("fp"),
        "positives",
        "negatives",
    )


def running_totals(counts: DataFrame, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Per distinct score: pos, neg, and with all higher scores tp, fp; also positives, negatives.

    ``counts`` are ``score_counts``. They are counted first to choose the
    ranges, so pass them stored or persisted.
    """
    return _totals_by_range(_with_range(counts, _cuts(counts, rows_per_range)))


def outcomes_at(counts: DataFrame, threshold: float) -> DataFrame:
    """One row: tp, fp, fn, tn when scores from the threshold on are flagged."""
    flagged = F.col("score") >= threshold

    def rows(column: str, where: Column) -> Column:
        return F.coalesce(F.sum(F.when(where, F.col(column))), F.lit(0))

    return counts.agg(
        rows("pos", flagged).alias("tp"),
        rows("neg", flagged).alias("fp"),
        rows("pos", ~flagged).alias("fn"),
        rows("neg", ~flagged).alias("tn"),
    )


def area_columns() -> list[Column]:
    """Aggregates over running totals: roc_auc, average_precision (steps), pr_auc (trapezoids).

    Null where a class is missing. The trapezoid curve starts at recall 0 with
    the first point's precision.
    """
    pos, neg, tp, fp = (F.col(c).cast("double") for c in ("pos", "neg", "tp", "fp"))
    positives, negatives = F.col("positives"), F.col("negatives")
    precision = F.try_divide(tp, tp + fp)
    higher = (tp - pos) + (fp - neg)
    precision_before = F.when(higher > 0, F.try_divide(tp - pos, higher)).otherwise(precision)
    recall_step = F.try_divide(pos, positives)
    area = F.try_divide(neg, negatives) * F.try_divide(tp - pos / 2, positives)
    return [
        F.sum(area).alias("roc_auc"),
        F.sum(recall_step * precision).alias("average_precision"),
        F.sum(recall_step * (precision + precision_before) / 2).alias("pr_auc"),
    ]


def area_metrics(totals: DataFrame) -> DataFrame:
    """One row with the three areas."""
    return totals.agg(*area_columns())


def roc_curve(totals: DataFrame, points: int = ROC_POINTS) -> DataFrame:
    """The ROC curve at evenly spaced false-positive rates: (point, fpr, tpr, threshold).

    ``tpr`` is the best true-positive rate at no more than that false-positive
    rate and ``threshold`` the score that reaches it; both are 0 and null where
    even the highest score has too many false positives.
    """
    last = points - 1
    # The first grid point whose rate is not below fp / negatives, in whole numbers.
    point = F.ceil(F.col("fp") * last / F.col("negatives"))
    reached = (
        totals.filter((F.col("negatives") > 0) & (F.col("positives") > 0))
        .groupBy(point.cast("bigint").alias("point"))
        .agg(
            F.max(F.col("tp") / F.col("positives")).alias("best"),
            F.min("score").alias("lowest"),
        )
    )
    # One row per grid point from here on.
    upto = Window.orderBy("point").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    grid = totals.sparkSession.range(points).withColumnRenamed("id", "point")
    return grid.join(F.broadcast(reached), "point", "left").select(
        "point",
        (F.col("point") / last).alias("fpr"),
        F.coalesce(F.max("best").over(upto), F.lit(0.0)).alias("tpr"),
        F.min("lowest").over(upto).alias("threshold"),
    )
