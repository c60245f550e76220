"""Dictionaries of a column's values that never reach the driver, and codes without one.

``ranks`` numbers the values by falling frequency. They are sorted by range and
stored; a value's position is its place in its range plus what lies before the
range, which a row for each range tells.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnrisk.operators.joins import LIMITS, Limits, frequent_keys, split_key_left_join
from txnrisk.plans.workdir import new_folder

#: A row's number in its partition, in the ids that Spark gives.
_ROW = (1 << 33) - 1


def ranks(rows: DataFrame, column: str, path: str | None = None) -> DataFrame:
    """(value, n, position): values by falling count, ties by value; null is no value.

    The sorted values are stored below ``path``, by default a new folder of the
    application.
    """
    spark = rows.sparkSession
    path = path or new_folder(spark, "dictionary")
    counts = rows.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    order = [F.desc("n"), "value"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = (
        counts.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("at", F.monotonically_increasing_id())
    )
    placed.write.parquet(path)
    stored = spark.read.schema(placed.schema).parquet(path)
    part = F.shiftrightunsigned("at", 33).alias("part")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = stored.groupBy(part).agg(F.count("*").alias("values"))
    starts = sizes.select("part", F.coalesce(F.sum("values").over(before), F.lit(0)).alias("start"))
    place = F.col("at").bitwiseAND(F.lit(_ROW)) + F.col("start")
    # One row for each range.
    numbered = stored.withColumn("part", part).join(F.broadcast(starts), "part")
    return numbered.select("value", "n", place.alias("position"))


def encoded(
    rows: DataFrame, column: str, dictionary: DataFrame, spread_by: str, limits: Limits = LIMITS
) -> DataFrame:
    """The rows with ``<column>_position``; a value that the dictionary lacks, and null, have null.

    A frequent value's rows are spread over several tasks by ``spread_by``.
    """
    name = f"{column}_position"
    known = dictionary.select(F.col("value").alias(column), F.col("position").alias(name))
    frequent = frequent_keys(rows, column, limits)
    joined = split_key_left_join(rows, known, column, spread_by, frequent, limits.shares)
    return joined.select(*rows.columns, name)


def hashed(column: str, width: int) -> Column:
    """One of ``width`` codes for a value, without a dictionary; null stays null."""
    code = F.pmod(F.xxhash64(column), F.lit(width).cast("bigint"))
    return F.when(F.col(column).isNotNull(), code)
