"""A Bloom filter of one column's values, to drop rows of another table before they are shuffled.

The filter is an array of longs that one aggregation makes and a scalar subquery
hands to the scan it prunes. A value that was put in always passes; others pass
at a rate that grows with the number of values for each bit, so a filter that is
too small for its values costs time and never rows.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HASHES = 2
#: Bits for each value: about one foreign value in 70 passes.
BITS = 16
#: 8 MB, the most that is sent to the tasks of a scan.
MOST_WORDS = 1 << 20


def words_for(values: int) -> int:
    """A power of two of longs with ``BITS`` bits a value, within ``MOST_WORDS``."""
    return min(MOST_WORDS, 1 << max(0, (values * BITS - 1) // 64).bit_length())


def _spots(column: Column, words: int) -> list[Column]:
    """The bits of a value; null has none, as it equals nothing."""
    bits = F.lit(words * 64).cast("bigint")
    return [F.pmod(F.xxhash64(column, F.lit(i)), bits) for i in range(HASHES)]


def sieve(values: DataFrame, column: str, words: int) -> DataFrame:
    """One row with the filter of a column as ``sieve``, an array of ``words`` longs."""
    spot = F.explode(F.array(*_spots(F.col(column), words))).alias("spot")
    marks = values.filter(F.col(column).isNotNull()).select(spot)
    mask = F.expr("shiftleft(1L, CAST(spot % 64 AS INT))")
    taken = marks.groupBy(F.shiftright("spot", 6).alias("word")).agg(F.bit_or(mask).alias("mask"))
    empty = values.sparkSession.range(words).select(F.col("id").alias("word"), F.lit(0).cast("bigint").alias("mask"))
    whole = taken.unionByName(empty).groupBy("word").agg(F.bit_or("mask").alias("mask"))
    listed = F.sort_array(F.collect_list(F.struct("word", "mask")))
    return whole.agg(F.transform(listed, lambda x: x["mask"]).alias("sieve"))


def passes(column: Column, made: DataFrame, words: int) -> Column:
    """Whether a value may be among those of the filter."""
    array = made.scalar()
    hits = [
        F.getbit(F.get(array, F.shiftright(spot, 6).cast("int")), F.pmod(spot, F.lit(64)).cast("int")) == 1
        for spot in _spots(column, words)
    ]
    return reduce(Column.__and__, hits)
