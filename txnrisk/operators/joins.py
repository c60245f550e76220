"""LEFT joins of a large table to a lookup table of any size.

A lookup whose measured size is within ``Limits.broadcast_bytes`` is broadcast. A
larger one is shuffled, and keys that hold too many rows are split over
several tasks first, so that no single key decides how long the join takes.
"""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Limits:
    """When a lookup is broadcast, and how many rows of one key may meet in one task.

    A key's share is 1/``shares`` of all rows, but at least ``smallest_share`` rows.
    """

    broadcast_bytes: int = 64 * 1024 * 1024
    shares: int = 50_000
    smallest_share: int = 1_000_000


LIMITS = Limits()


def _row_bytes(df: DataFrame) -> Column:
    """Bytes of one row: text at its length, other types and overhead at 16 a column."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    parts = [F.coalesce(F.octet_length(F.col(c)), F.lit(0)) for c in texts]
    return reduce(Column.__add__, parts, F.lit(16 * len(df.columns))).cast("bigint")


def measured_bytes(*lookups: DataFrame) -> list[int]:
    """Size of each lookup, counted in one job that returns one number per lookup."""
    sized = [
        df.agg(F.lit(i).alias("i"), F.coalesce(F.sum(_row_bytes(df)), F.lit(0)).alias("bytes"))
        for i, df in enumerate(lookups)
    ]
    rows = reduce(DataFrame.unionAll, sized).collect()
    return [row["bytes"] for row in sorted(rows, key=lambda row: row["i"])]


def frequent_keys(rows: DataFrame, key: str, limits: Limits = LIMITS) -> DataFrame:
    """Keys that hold more than a share of the rows: (key, pieces).

    At most ``limits.shares`` keys can. Counts are added up before the shuffle.
    """
    counts = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    share = F.greatest(
        F.lit(float(limits.smallest_share)),
        counts.agg((F.coalesce(F.sum("n"), F.lit(0)) / limits.shares).alias("share")).scalar(),
    )
    return counts.filter(F.col("n") > share).select(key, F.ceil(F.col("n") / share).alias("pieces"))


def split_key_left_join(
    facts: DataFrame,
    lookup: DataFrame,
    key: str,
    spread_by: str,
    frequent: DataFrame,
    null_pieces: int = LIMITS.shares,
) -> DataFrame:
    """LEFT shuffle join in which each frequent key is spread over its ``pieces``.

    ``frequent`` only decides where rows travel, never which rows match. Its
    length is bounded by ``frequent_keys``, so it is safe to broadcast. Null
    keys match nothing and are spread as well.
    """
    pieces = F.when(F.col(key).isNull(), F.lit(null_pieces)).otherwise(
        F.coalesce(F.col("pieces"), F.lit(1))
    )
    spread = F.broadcast(frequent)
    first = F.lit(0).cast("bigint")
    left = (
        facts.join(spread, key, "left")
        .withColumn("_piece", F.pmod(F.xxhash64(spread_by), pieces))
        .drop("pieces")
    )
    right = (
        lookup.join(spread, key, "left")
        .withColumn("_piece", F.explode(F.sequence(first, F.coalesce("pieces", first + 1) - 1)))
        .drop("pieces")
    )
    return left.join(right, [key, "_piece"], "left").drop("_piece")


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    key: str,
    spread_by: str,
    lookup_bytes: int,
    limits: Limits = LIMITS,
    keys_from: DataFrame | None = None,
) -> DataFrame:
    """LEFT join by broadcast when the lookup fits, else by a split-key shuffle.

    ``keys_from`` is where key frequencies are counted: any table with about
    the same keys that is cheap to read, by default the facts themselves.
    """
    if lookup_bytes <= limits.broadcast_bytes:
        return facts.join(F.broadcast(lookup), key, "left")
    frequent = frequent_keys(facts if keys_from is None else keys_from, key, limits)
    return split_key_left_join(facts, lookup, key, spread_by, frequent, limits.shares)
