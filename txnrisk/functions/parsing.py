"""Turn loosely typed input columns into the types of the silver layer.

Unreadable text becomes null, so one bad value never fails a job.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.StringType)


# A plain decimal number, with an exponent or not. Casts alone would also take ``12d`` and ``0x1p4``.
NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def _number(df: DataFrame, name: str) -> Column:
    value = F.col(name).try_cast("double")
    return F.when(F.col(name).rlike(NUMBER), value) if _is_text(df, name) else value


def to_double(df: DataFrame, name: str) -> Column:
    """Number or decimal text to double. NaN and infinite values count as missing."""
    value = F.col(name).try_cast("double")
    finite = F.abs(value) < float("inf")
    # The pattern costs more than the cast, so that it is asked once.
    return F.when(finite & F.col(name).rlike(NUMBER) if _is_text(df, name) else finite, value)


def to_long(df: DataFrame, name: str) -> Column:
    """Number or text to bigint; text such as ``5411.0`` is read through double."""
    value = F.col(name).try_cast("bigint")
    if _is_text(df, name):
        value = F.coalesce(value, _number(df, name).try_cast("bigint"))
    return value


def to_label(df: DataFrame, name: str) -> Column:
    """As ``to_long``; JSON ``true`` and ``false`` become 1 and 0."""
    value = to_long(df, name)
    if _is_text(df, name):
        truth = F.lower(F.trim(F.col(name)))
        value = F.when(truth == "true", F.lit(1)).when(truth == "false", F.lit(0)).otherwise(value)
    return value.cast("bigint")


def to_time(df: DataFrame, name: str) -> Column:
    """Text to timestamp; columns that are already times keep their type."""
    return F.try_to_timestamp(F.col(name)) if _is_text(df, name) else F.col(name)
