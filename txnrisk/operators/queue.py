"""Alerts for the review queue."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnrisk.functions import scoring
from txnrisk.operators import sieve
from txnrisk.schemas import QUEUE_COLUMNS


def high_risk(scored: DataFrame, threshold: float = scoring.HIGH_RISK) -> DataFrame:
    return scored.filter(F.col("fraud_probability") >= threshold)


def existing(df: DataFrame, columns: list[str]) -> DataFrame:
    """The listed columns that the frame has, in the list's order."""
    return df.select([c for c in columns if c in df.columns])


def alerts(scored: DataFrame, threshold: float = scoring.HIGH_RISK) -> DataFrame:
    """High-risk rows in the queue's columns, order and types, labelled by their prediction.

    The probability itself is not queued.
    """
    typed = high_risk(scored, threshold).withColumns(
        {
            "prediction": F.col("prediction").cast("double"),
            "merchant_mcc": F.col("merchant_mcc").cast("bigint"),
            "is_fraud": F.col("prediction").cast("bigint"),
        }
    )
    return existing(typed, QUEUE_COLUMNS)


def one_per_id(alerts: DataFrame) -> DataFrame:
    """Of the rows of each id, the first in the order of all columns."""
    order = [F.col(c).asc_nulls_last() for c in alerts.columns]
    per_id = Window.partitionBy("transaction_id").orderBy(*order)
    numbered = alerts.withColumn("row_num", F.row_number().over(per_id))
    return numbered.filter("row_num = 1").select(alerts.columns)


def not_queued(new: DataFrame, queue: DataFrame, words: int | None = None) -> DataFrame:
    """Alerts whose id is not in the queue yet, so that a repeated run adds nothing.

    With ``words``, the size of a Bloom filter of the new ids (``sieve.words_for``),
    only the queue's rows that pass it are shuffled. Stored alerts are best then,
    as they are read twice.
    """
    queued = queue.select("transaction_id")
    if words:
        made = sieve.sieve(new, "transaction_id", words)
        queued = queued.filter(sieve.passes(F.col("transaction_id"), made, words))
    return new.join(queued, "transaction_id", "left_anti").select(new.columns)
