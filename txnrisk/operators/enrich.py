"""Silver rows to gold rows: payer and payee attributes added."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnrisk.functions import parsing
from txnrisk.operators.joins import LIMITS, Limits, lookup_join, measured_bytes
from txnrisk.schemas import GOLD_COLUMNS, PAYEE_COLUMNS, PAYER_COLUMNS

# What stands in for an attribute that is not known.
DEFAULTS = {
    "payor_country": "UNKNOWN",
    "payor_risk_score": 0.0,
    "payee_country": "UNKNOWN",
    "payee_risk_score": 0.0,
    "payee_category": "General",
}


def payer_lookup(payers: DataFrame) -> DataFrame:
    score = parsing.to_double(payers, "payor_risk_score")
    return payers.withColumn("payor_risk_score", score).select(PAYER_COLUMNS)


def payee_lookup(payees: DataFrame) -> DataFrame:
    score = parsing.to_double(payees, "payee_risk_score")
    return payees.withColumn("payee_risk_score", score).select(PAYEE_COLUMNS)


def enrich(
    silver: DataFrame,
    payers: DataFrame,
    payees: DataFrame,
    limits: Limits = LIMITS,
    keys_from: DataFrame | None = None,
) -> DataFrame:
    """Both lookups joined, gaps filled, 19 columns. Names stay null when unknown."""
    payers, payees = payer_lookup(payers), payee_lookup(payees)
    payer_bytes, payee_bytes = measured_bytes(payers, payees)
    counted = silver if keys_from is None else keys_from
    joined = silver
    for lookup, key, size in ((payers, "payor_id", payer_bytes), (payees, "payee_id", payee_bytes)):
        joined = lookup_join(joined, lookup, key, "transaction_id", size, limits, counted)
    return joined.fillna(DEFAULTS).select(GOLD_COLUMNS)
