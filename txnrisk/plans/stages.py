"""The four stages, from input files to the review queue.

Each stage reads stored tables and writes stored tables, so a stage can be run
again alone, and a lost executor costs only recomputation from the last table.
Errors are raised, never swallowed.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnrisk.functions import scoring
from txnrisk.operators import (
    clean,
    confusion,
    curves,
    enrich,
    model,
    quality,
    queue,
    report,
    split,
)
from txnrisk.operators.joins import LIMITS, Limits
from txnrisk.schemas import (
    GOLD_COLUMNS,
    LABEL,
    PAYEE_COLUMNS,
    PAYER_COLUMNS,
    QUEUE_COLUMNS,
    RAW_COLUMNS,
    text_schema,
    typed_schema,
)
from txnrisk.sources import files, models
from txnrisk.sources.tables import Table, append_new, in_few_files, materialize
from txnrisk.sources.versions import Versioned

LABEL_STATE = "label_state"
# Failures of these are only warned of: repeated lookup keys, odd labels, unreadable values.
WARNINGS = (
    "unique_dim_payers_payor_id",
    "unique_dim_payees_payee_id",
    "accepted_values_stg_transactions_is_fraud",
    "readable_raw_transactions_timestamp",
    "readable_raw_transactions_amount",
    "readable_raw_transactions_merchant_mcc",
    "readable_raw_transactions_is_fraud",
)
RAW_SCHEMA = text_schema([*RAW_COLUMNS, files.CORRUPT_TEXT, clean.STATE])
GOLD_SCHEMA = typed_schema([*GOLD_COLUMNS, LABEL_STATE])
STAGES = ("ingestion", "transform", "training", "inference")


@dataclass(frozen=True)
class Layers:
    """Where the layers of one deployment are stored."""

    raw: Table
    dim_payers: Table
    dim_payees: Table
    invalid: Table
    gold: Table
    queue: Table
    quality: Table
    metrics: Table
    roc_curve: Table
    class_report: Table
    model: str
    second_model: str | None = None
    # Without a table, silver is a view and is computed again by each reader.
    silver: Table | None = None

    @classmethod
    def under(cls, root: str, **changes) -> Layers:
        """All layers as Parquet folders with versions, below one root."""
        names = {
            "raw": "raw_transactions",
            "dim_payers": "dim_payers",
            "dim_payees": "dim_payees",
            "silver": "stg_transactions",
            "invalid": "invalid_transactions",
            "gold": "enriched_transactions",
            "queue": "review_queue",
            "quality": "quality_report",
            "metrics": "model_metrics",
            "roc_curve": "roc_curve",
            "class_report": "classification_report",
        }
        tables = {field: Versioned(f"{root}/{name}") for field, name in names.items()}
        return cls(**{**tables, "model": f"{root}/models/fraud_model", **changes})


@dataclass(frozen=True)
class Settings:
    """Inputs and choices of a run."""

    # A path, or several of which the first that exists is read.
    logs: str | tuple[str, ...]
    payers: str | None = None
    payees: str | None = None
    csv_null_tokens: tuple[str, ...] = ()
    # Names of the lines' further fields to keep; None finds them by a pass over the lines.
    further_fields: tuple[str, ...] | None = None
    # Quality tests that may fail without stopping the run.
    accepted_failures: tuple[str, ...] = ()
    threshold: float = scoring.HIGH_RISK
    # Score the first rows of gold when no row is waiting for a label.
    score_first_when_none_wait: bool = False
    replace_queue: bool = False
    # Codes by hash for a category with too many values to list; without it training refuses such data.
    hash_width: int | None = None
    # A name for this run's alerts: a queue that has them already takes none.
    batch: str | None = None
    limits: Limits = LIMITS


def _raw_schema(table: Table) -> T.StructType:
    """The raw layer's columns. Further fields are a VARIANT in Parquet, else JSON text."""
    kind = T.VariantType() if table.format == "parquet" else T.StringType()
    return T.StructType([*RAW_SCHEMA, T.StructField(files.EXTRA, kind)])


def read_raw(spark: SparkSession, layers: Layers) -> DataFrame:
    """The readable rows of the raw layer, as text, with their stored record state."""
    raw = layers.raw.read(spark, _raw_schema(layers.raw))
    return files.readable(raw).select(*RAW_COLUMNS, clean.STATE)


def read_further(spark: SparkSession, layers: Layers) -> DataFrame:
    """The raw rows that came with further fields: transaction_id and ``extra_fields``."""
    raw = files.readable(layers.raw.read(spark, _raw_schema(layers.raw)))
    return raw.select("transaction_id", files.EXTRA).filter(F.col(files.EXTRA).isNotNull())


def read_corrupt(spark: SparkSession, layers: Layers) -> DataFrame:
    """The input lines that held no JSON object."""
    return files.corrupt(layers.raw.read(spark, _raw_schema(layers.raw)))


def read_lookups(spark: SparkSession, layers: Layers) -> tuple[DataFrame, DataFrame]:
    return (
        layers.dim_payers.read(spark, typed_schema(PAYER_COLUMNS)),
        layers.dim_payees.read(spark, typed_schema(PAYEE_COLUMNS)),
    )


def read_gold(spark: SparkSession, layers: Layers) -> DataFrame:
    return layers.gold.read(spark, GOLD_SCHEMA).select(GOLD_COLUMNS)


def _read_gold_half(spark: SparkSession, layers: Layers, state: str) -> DataFrame:
    """Only the stored half with or without labels is listed and read."""
    gold = layers.gold.read(spark, GOLD_SCHEMA)
    half = report.labeled(gold) if state == "labeled" else report.unlabeled(gold)
    if LABEL_STATE in gold.columns:
        half = half.filter(F.col(LABEL_STATE) == state)
    return half.select(GOLD_COLUMNS)


def labeled_gold(spark: SparkSession, layers: Layers) -> DataFrame:
    return _read_gold_half(spark, layers, "labeled")


def unlabeled_gold(spark: SparkSession, layers: Layers) -> DataFrame:
    return _read_gold_half(spark, layers, "unlabeled")


def ingest(spark: SparkSession, layers: Layers, settings: Settings) -> DataFrame:
    """Files to the raw layer and the two lookups; the ingestion summary as result.

    Valid, quarantined and corrupt lines go to their own directories of the raw
    table in one pass. Another one before it finds the names of further fields,
    unless the settings name them.
    """
    paths = (settings.logs,) if isinstance(settings.logs, str) else settings.logs
    path = files.first_existing(spark, *paths)
    named = settings.further_fields
    further = files.further_fields(spark, path) if named is None else list(named)
    lines = files.read_lines(spark, path, further)
    if layers.raw.format != "parquet":
        lines = lines.withColumn(files.EXTRA, F.to_json(files.EXTRA))
    layers.raw.replace(lines, partition_by=clean.STATE)
    for path, columns, target in (
        (settings.payers, PAYER_COLUMNS, layers.dim_payers),
        (settings.payees, PAYEE_COLUMNS, layers.dim_payees),
    ):
        target.replace(files.read_lookup(spark, path, columns, settings.csv_null_tokens))
    return report.ingestion_summary(clean.typed(read_raw(spark, layers)))


def transform(spark: SparkSession, layers: Layers, settings: Settings) -> DataFrame:
    """Raw to silver, quarantine and gold; the quality report as result.

    Raises ``QualityError`` after the tables are written if a test fails that
    is not accepted. Repeated lookup keys, labels that are no class and values
    that could not be read are warnings; the report counts them.
    """
    raw = read_raw(spark, layers)
    payers, payees = read_lookups(spark, layers)
    silver = materialize(clean.latest(raw), "stg_transactions", layers.silver)
    started = F.lit(datetime.now(timezone.utc))
    layers.invalid.replace(in_few_files(clean.quarantine(raw, started)))
    gold = enrich.enrich(silver, payers, payees, settings.limits, keys_from=raw)
    state = F.when(F.col(LABEL).isNull(), "unlabeled").otherwise("labeled")
    layers.gold.replace(gold.withColumn(LABEL_STATE, state), partition_by=LABEL_STATE)
    tests = quality.quality_report(silver, read_gold(spark, layers))
    others = [
        quality.lookup_report(payers, payees),
        quality.label_test(silver, "stg_transactions"),
        quality.reading_tests(clean.parse_losses(raw), "raw_transactions"),
    ]
    layers.quality.replace(reduce(DataFrame.unionByName, others, tests).coalesce(1))
    results = layers.quality.read(spark)
    quality.require_passed(results, (*settings.accepted_failures, *WARNINGS))
    return results


def _train(spark: SparkSession, layers: Layers, settings: Settings) -> PipelineModel:
    fit_rows, test_rows = split.split_frames(labeled_gold(spark, layers))
    fitted = model.fit(fit_rows, hash_width=settings.hash_width)
    models.save_model(fitted, layers.model, layers.second_model)
    counts = curves.score_counts(model.score(fitted, test_rows), "fraud_probability").persist()
    try:
        totals = curves.running_totals(counts)
        outcomes = curves.outcomes_at(counts, settings.threshold)
        # A row or a hundred each.
        layers.metrics.replace(model.evaluate(totals, settings.threshold).coalesce(1))
        layers.roc_curve.replace(curves.roc_curve(totals).coalesce(1))
        layers.class_report.replace(confusion.classification_report(outcomes).coalesce(1))
    finally:
        counts.unpersist()
    return fitted


def train(spark: SparkSession, layers: Layers, settings: Settings) -> DataFrame:
    """Fit on 80 % of the labelled rows of each class, test on the rest; the metrics as result.

    The ROC curve and the classification report are stored next to the metrics.
    """
    _train(spark, layers, settings)
    return layers.metrics.read(spark)


def load_or_train(spark: SparkSession, layers: Layers, settings: Settings) -> PipelineModel:
    if models.model_exists(spark, layers.model, layers.second_model):
        return models.load_model(spark, layers.model, layers.second_model)
    return _train(spark, layers, settings)


def infer(spark: SparkSession, layers: Layers, settings: Settings) -> DataFrame:
    """Score the unlabelled rows and queue the risky ones; a sample of the queue as result."""
    fitted = load_or_train(spark, layers, settings)
    waiting = unlabeled_gold(spark, layers)
    if settings.score_first_when_none_wait and waiting.isEmpty():
        waiting = report.first_rows(
            read_gold(spark, layers), report.FIRST_ROWS, ["transaction_id"]
        )
    alerts = queue.alerts(model.score(fitted, waiting, settings.threshold), settings.threshold)
    if settings.replace_queue:
        layers.queue.replace(in_few_files(alerts))
    else:
        append_new(alerts, layers.queue, settings.batch)
    return report.alert_sample(layers.queue.read(spark, typed_schema(QUEUE_COLUMNS)))


def run(
    spark: SparkSession, layers: Layers, settings: Settings, stages: tuple[str, ...] = STAGES
) -> dict[str, DataFrame]:
    """Run the named stages in order; the first error stops the run."""
    steps = {"ingestion": ingest, "transform": transform, "training": train, "inference": infer}
    unknown = set(stages) - set(steps)
    if unknown:
        raise ValueError(f"unknown stages: {', '.join(sorted(unknown))}")
    return {name: steps[name](spark, layers, settings) for name in STAGES if name in stages}
