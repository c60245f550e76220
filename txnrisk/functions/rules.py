"""Validity rules of a raw transaction."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Reason codes of the quarantine.
MISSING_ID = "MISSING_TRANSACTION_ID"
BAD_AMOUNT = "INVALID_AMOUNT"
OTHER = "OTHER_ANOMALY"
# Ours: the state of a row that breaks no rule, and of a line that is no JSON object.
VALID = "VALID"
CORRUPT = "CORRUPT_LINE"


def has_id() -> Column:
    """The id is there and not just spaces."""
    return F.col("transaction_id").isNotNull() & (F.trim("transaction_id") != "")


def bad_amount(amount: Column) -> Column:
    return amount.isNull() | (amount <= 0)


def is_broken(amount: Column) -> Column:
    return ~has_id() | bad_amount(amount)


def quarantine_reason(amount: Column) -> Column:
    return F.when(~has_id(), MISSING_ID).when(bad_amount(amount), BAD_AMOUNT).otherwise(OTHER)


def record_state(amount: Column) -> Column:
    """``VALID``, or why the row goes to quarantine. The amount is a number."""
    return F.when(is_broken(amount), quarantine_reason(amount)).otherwise(VALID)
