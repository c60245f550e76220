"""Counts, filters and samples shown to people."""

from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from txnrisk.functions import display
from txnrisk.schemas import ALERT_SAMPLE_COLUMNS, CLASSES, LABEL

# Rows scored when none waits for a label, of a layer's sample, of the alerts' sample.
FIRST_ROWS = 2500
SAMPLE_ROWS = 100
ALERT_ROWS = 5


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("row_count"))


def stored_counts(spark: SparkSession, layers: dict[str, list[str]], by: str | None = None) -> DataFrame:
    """Rows of Parquet folders without reading any: (layer, n), counted from the files' footers.

    Spark pushes the count into its newer Parquet reader, so a file costs the
    reading of its footer. ``by`` is a column that the folders are partitioned
    by. The reader is chosen by settings, so the frames belong to a session of
    their own, with the same context and settings otherwise.
    """
    own = spark.newSession()
    for row in spark.sql("SET").collect():
        if row["key"].startswith("spark.sql.") and own.conf.isModifiable(row["key"]):
            own.conf.set(row["key"], row["value"])
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    counted = []
    for name, folders in layers.items():
        for folder in folders:
            rows = own.read.parquet(folder)
            grouped = rows.groupBy(by) if by else rows.groupBy()
            counts = grouped.agg(F.count("*").alias("n"))
            counted.append(counts.select(F.lit(name).alias("layer"), *([by] if by else []), "n"))
    # A few rows for each folder.
    return reduce(DataFrame.unionAll, counted).groupBy("layer", *([by] if by else [])).agg(F.sum("n").alias("n"))


def layer_counts(layers: dict[str, DataFrame]) -> DataFrame:
    """Rows of each layer, in one row with one column per layer."""
    counted = [
        df.agg(F.lit(name).alias("layer"), F.count("*").alias("n")) for name, df in layers.items()
    ]
    return reduce(DataFrame.unionByName, counted).agg(
        *[F.sum(F.when(F.col("layer") == name, F.col("n"))).alias(name) for name in layers]
    )


def ingestion_summary(raw: DataFrame) -> DataFrame:
    """Total, distinct payment methods (null is one of them), labelled, unlabelled."""
    per_method = raw.groupBy("payment_method").agg(
        F.count("*").alias("n"), F.count(LABEL).alias("labeled")
    )
    total, labeled = (F.coalesce(F.sum(c), F.lit(0)) for c in ("n", "labeled"))
    return per_method.agg(
        total.alias("total"),
        F.count("*").alias("payment_methods"),
        labeled.alias("labeled"),
        (total - labeled).alias("unlabeled"),
    )


def class_distribution(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Rows per label that occurs; the two classes are always listed, without rows as 0."""
    found = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))
    classes = df.sparkSession.range(len(CLASSES)).select(
        F.col("id").cast("bigint").alias(label), F.lit(0).cast("bigint").alias("n")
    )
    return found.unionByName(classes).groupBy(label).agg(F.sum("n").alias("n"))


def labeled(df: DataFrame) -> DataFrame:
    return df.filter(F.col(LABEL).isNotNull())


def unlabeled(df: DataFrame) -> DataFrame:
    return df.filter(F.col(LABEL).isNull())


def unlabeled_or_first(df: DataFrame, n: int = FIRST_ROWS) -> DataFrame:
    """Unlabelled rows or, when there are none, the first ``n`` rows by id.

    One job tells which, and how far those rows reach.
    """
    found = _reach(df, max(1, n), "transaction_id", F.col(LABEL).isNull())
    return unlabeled(df) if found["leading"] else first_rows(_up_to(df, "transaction_id", found), n, ["transaction_id"])


def first_rows(df: DataFrame, n: int, leading: list[str] | None = None) -> DataFrame:
    """The first ``n`` rows by the leading columns, then by all others.

    Each task keeps its own first ``n``; the table is never sorted as a whole.
    """
    order = list(leading or []) + [c for c in df.columns if c not in (leading or [])]
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in order]).limit(n)


def layer_sample(df: DataFrame, n: int = SAMPLE_ROWS) -> DataFrame:
    """The first rows by the first column, then by all others.

    The first column alone tells how far the sample can reach; only rows up to
    there are then read and compared whole. Pass a stored frame, in which that
    limit is pushed down to the files.
    """
    key = df.columns[0]
    return first_rows(_up_to(df, key, _reach(df, n, key)), n)


def _reach(df: DataFrame, n: int, key: str, leading: Column | None = None) -> Row:
    """The last of the first ``n`` keys, how many of them are null, and whether a leading row is among them.

    Leading rows come before all others.
    """
    leads = F.lit(False) if leading is None else leading
    keys = df.select(F.col(key).alias("key"), leads.alias("leading"))
    order = [F.col("key").asc_nulls_last()] if leading is None else [F.desc("leading"), F.col("key").asc_nulls_last()]
    return keys.orderBy(*order).limit(n).agg(
        F.max("key").alias("last"), F.count_if(F.col("key").isNull()).alias("nulls"), F.bool_or("leading").alias("leading")
    ).first()


def _up_to(df: DataFrame, key: str, found: Row) -> DataFrame:
    """The rows that a reach can hold."""
    wanted = F.lit(False) if found["last"] is None else F.col(key) <= F.lit(found["last"])
    if found["nulls"]:
        wanted = wanted | F.col(key).isNull()
    return df.filter(wanted)


def alert_sample(queue: DataFrame, n: int = ALERT_ROWS) -> DataFrame:
    return first_rows(queue.select(ALERT_SAMPLE_COLUMNS), n)


def filter_queue(
    queue: DataFrame, countries: list[str] | None = None, min_amount: float = 0.0
) -> DataFrame:
    """Alerts of some payer countries (none given: all) from an amount on (0: all)."""
    conditions: list[Column] = []
    if countries:
        conditions.append(F.col("payor_country").isin(*countries))
    if min_amount > 0:
        conditions.append(F.col("amount") >= min_amount)
    return reduce(DataFrame.filter, conditions, queue)


def country_options(queue: DataFrame) -> DataFrame:
    return queue.select("payor_country").dropna().distinct()


def alerts_by_country(queue: DataFrame) -> DataFrame:
    """Alerts per payer country, most first."""
    counts = queue.dropna(subset=["payor_country"]).groupBy("payor_country")
    return counts.agg(F.count("*").alias("alerts")).orderBy(F.desc("alerts"), "payor_country")


def alerts_by_method(queue: DataFrame) -> DataFrame:
    """Alerts per payment method and their share of all alerts."""
    counts = queue.groupBy("payment_method").agg(F.count("*").alias("alerts"))
    total = counts.agg(F.sum("alerts").alias("total")).scalar()
    return counts.withColumn("share", F.col("alerts") / total)


def formatted_queue(queue: DataFrame) -> DataFrame:
    """The queue with its amount and risk scores as display text."""
    return queue.withColumns(
        {
            "amount": display.money("amount"),
            "payor_risk_score": display.percent("payor_risk_score"),
            "payee_risk_score": display.percent("payee_risk_score"),
        }
    )
