"""Raw transactions to silver rows and quarantined rows."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from txnrisk.functions import parsing, rules
from txnrisk.schemas import RAW_COLUMNS

STATE = "record_state"


def typed(raw: DataFrame) -> DataFrame:
    """Cast amount, merchant code, label and time; leave the other columns alone."""
    return raw.withColumns(_readings(raw))


def _readings(raw: DataFrame) -> dict[str, Column]:
    return {
        "timestamp": parsing.to_time(raw, "timestamp"),
        "amount": parsing.to_double(raw, "amount"),
        "merchant_mcc": parsing.to_long(raw, "merchant_mcc"),
        "is_fraud": parsing.to_label(raw, "is_fraud"),
    }


def with_state(raw: DataFrame) -> DataFrame:
    """Add the validity state, by which the raw table is stored in directories.

    Raw columns may be text; they stay as they arrived.
    """
    # The rules ask for the amount several times: a column of its own is read once for all of them.
    read = raw.withColumn("_amount", parsing.to_double(raw, "amount"))
    return read.withColumn(STATE, rules.record_state(F.col("_amount"))).drop("_amount")


def with_valid_id(raw: DataFrame) -> DataFrame:
    """Rows whose id is not null and not blank. The amount is not looked at.

    Of a raw table stored by state, only the matching directories are read.
    """
    if STATE in raw.columns:
        return raw.filter(F.col(STATE).isin(rules.VALID, rules.BAD_AMOUNT))
    return raw.filter(rules.has_id())


def newest_first() -> list[Column]:
    """Order of the rows of one id: latest time, then every other column.

    Rows that tie on all of it are equal, so the row kept never depends on
    how the data is partitioned.
    """
    leading = ["payee_id", "device_id", "ip_address"]
    named = {"transaction_id", "timestamp", "amount", *leading}
    rest = [c for c in RAW_COLUMNS if c not in named]
    return [
        F.col("timestamp").desc_nulls_last(),
        F.col("amount").desc_nulls_last(),
        *[F.col(c).asc_nulls_last() for c in leading + rest],
    ]


def ranked(raw: DataFrame, keep: int) -> DataFrame:
    """The latest ``keep`` rows of each id, numbered from the latest on as ``row_num``.

    Spark turns the bound on ``row_num`` into a group limit that runs before
    the shuffle as well, so a heavily repeated id leaves each task as ``keep``
    rows at most.
    """
    per_id = Window.partitionBy("transaction_id").orderBy(*newest_first())
    numbered = raw.withColumn("row_num", F.row_number().over(per_id))
    return numbered.filter(F.col("row_num") <= keep)


def latest(raw: DataFrame) -> DataFrame:
    """One typed row per valid id, the latest. Blank ids are gone before the shuffle."""
    return ranked(typed(with_valid_id(raw)), keep=1).select(RAW_COLUMNS)


def quarantine(raw: DataFrame, quarantined_at: Column | None = None) -> DataFrame:
    """Rows without an id or with a bad amount, as they arrived, with a reason code.

    A row with an id and a bad amount is both here and in silver.
    """
    at = F.current_timestamp() if quarantined_at is None else quarantined_at
    if STATE in raw.columns:
        broken, reason = F.col(STATE) != rules.VALID, F.col(STATE)
    else:
        amount = parsing.to_double(raw, "amount")
        broken, reason = rules.is_broken(amount), rules.quarantine_reason(amount)
    return raw.filter(broken).select(
        *RAW_COLUMNS, at.alias("quarantined_at"), reason.alias("quarantine_reason")
    )


def parse_losses(raw: DataFrame) -> DataFrame:
    """Values of each typed column that were there and could not be read: (column, lost)."""
    lost = [
        F.count_if(_there(raw, name) & value.isNull()).alias(name)
        for name, value in _readings(raw).items()
    ]
    names = list(_readings(raw))
    return raw.agg(*lost).unpivot([], names, "column", "lost")


def _there(raw: DataFrame, name: str) -> Column:
    """Neither null nor, in text, blank."""
    is_text = isinstance(raw.schema[name].dataType, StringType)
    return F.trim(name) != "" if is_text else F.col(name).isNotNull()
