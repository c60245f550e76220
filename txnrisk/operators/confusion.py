"""Metrics of a yes/no prediction, all from one pass that counts the four outcomes."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnrisk.schemas import LABEL


def outcome_counts(predicted: DataFrame, prediction: str, label: str = LABEL) -> DataFrame:
    """One row: tp, fp, fn, tn."""
    is_fraud, flagged = F.col(label) == 1, F.col(prediction) == 1
    return predicted.filter(F.col(label).isNotNull()).agg(
        F.count_if(is_fraud & flagged).alias("tp"),
        F.count_if(~is_fraud & flagged).alias("fp"),
        F.count_if(is_fraud & ~flagged).alias("fn"),
        F.count_if(~is_fraud & ~flagged).alias("tn"),
    )


def accuracy(counts: DataFrame) -> DataFrame:
    right, rows = F.col("tp") + F.col("tn"), F.expr("tp + fp + fn + tn")
    return counts.select(F.try_divide(right, rows).alias("accuracy"))


def _ratio(part: Column, whole: Column) -> Column:
    """0 where the whole is 0."""
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def classification_report(counts: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support of both classes, then accuracy and the averages.

    The accuracy row holds its value as ``f1_score`` and no precision or recall.
    """
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    rows = tp + fp + fn + tn

    def line(name: str, hit: Column, wrong: Column, missed: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class"),
            _ratio(hit, hit + wrong).alias("precision"),
            _ratio(hit, hit + missed).alias("recall"),
            _ratio(2 * hit, 2 * hit + wrong + missed).alias("f1_score"),
            (hit + missed).alias("support"),
        )

    def average(name: str, weights: tuple[Column, Column]) -> Column:
        def mean(field: str) -> Column:
            pair = (F.col("legit")[field], F.col("fraud")[field])
            total = weights[0] * pair[0] + weights[1] * pair[1]
            return _ratio(total, weights[0] + weights[1]).alias(field)

        fields = [mean(f) for f in ("precision", "recall", "f1_score")]
        return F.struct(F.lit(name).alias("class"), *fields, rows.alias("support"))

    none = F.lit(None).cast("double")
    overall = F.struct(
        F.lit("accuracy").alias("class"),
        none.alias("precision"),
        none.alias("recall"),
        _ratio(tp + tn, rows).alias("f1_score"),
        rows.alias("support"),
    )
    return (
        counts.withColumns(
            {"legit": line("Legitimate", tn, fn, fp), "fraud": line("Fraud", tp, fp, fn)}
        )
        .select(
            F.inline(
                F.array(
                    F.col("legit"),
                    F.col("fraud"),
                    overall,
                    average("macro avg", (F.lit(1), F.lit(1))),
                    average("weighted avg", (tn + fp, tp + fn)),
                )
            )
        )
    )
