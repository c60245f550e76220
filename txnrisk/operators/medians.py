"""Exact medians of numeric columns by narrowing histograms.

Each pass counts the values of what is left of a column's range in ``BINS``
bins, with each bin's least and greatest value; the bin in which the wanted rank
lies is the next range. A range of one value ends it. All columns share a pass:
one aggregation with at most 2 * columns * ``BINS`` rows, added up before the
shuffle. Whatever the rows, no more reaches the driver, and no value is sorted.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BINS = 4096


@dataclass
class _Search:
    """Where the value of one rank (from 0) of one column lies, as far as it is known."""

    column: str
    rank: int
    least: float
    greatest: float
    below: int = 0

    def _bin(self) -> Column:
        """The bin of a value in the range. Halves first, so that no difference overflows."""
        half, low, high = F.col(self.column) / 2, self.least / 2, self.greatest / 2
        if low == high:
            # The smallest doubles: the least is a bin, the others are one.
            return (F.col(self.column) > F.lit(self.least)).cast("int")
        share = (half - F.lit(low)) / F.lit(high - low)
        return F.least(F.floor(share * BINS), F.lit(BINS - 1)).cast("int")

    def entry(self, number: int) -> Column:
        value = F.col(self.column)
        inside = value.between(F.lit(self.least), F.lit(self.greatest))
        return F.when(inside, F.struct(F.lit(number).alias("search"), self._bin().alias("bin"), value.alias("value")))

    def narrow(self, bins: list) -> None:
        for found in sorted(bins, key=lambda row: row.bin):
            if self.rank < self.below + found.n:
                self.least, self.greatest = found.least, found.greatest
                return
            self.below += found.n
        raise AssertionError(f"rank {self.rank} of {self.column} is beyond its values")


def _known(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns as doubles; NaN is missing."""
    return df.select([F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in columns])


def medians(df: DataFrame, columns: list[str]) -> dict[str, tuple[int, float | None]]:
    """Each column's number of values and exact median: of an even number, the middle two's mean.

    Null and NaN are no values; a column without any has the median None.
    Infinite values count as the greatest and least doubles.
    """
    known = _known(df, columns)
    sizes = [
        part
        for c in columns
        for part in (F.count(c).alias(f"n_{c}"), F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}"))
    ]
    whole = known.agg(*sizes).first()
    most = 1.7976931348623157e308
    searches = [
        _Search(c, rank, max(whole[f"min_{c}"], -most), min(whole[f"max_{c}"], most))
        for c in columns
        if whole[f"n_{c}"]
        for rank in sorted({(whole[f"n_{c}"] - 1) // 2, whole[f"n_{c}"] // 2})
    ]
    clipped = known.select(
        [F.when(F.col(c).isNotNull(), F.greatest(F.lit(-most), F.least(F.lit(most), F.col(c)))).alias(c) for c in columns]
    )
    while open_ := [s for s in searches if s.least < s.greatest]:
        # The middle two ranks of a column mostly share their range, which is then counted once.
        ranges = {(s.column, s.least, s.greatest): s for s in open_}
        places = {key: i for i, key in enumerate(ranges)}
        entries = F.array_compact(F.array(*[s.entry(i) for i, s in enumerate(ranges.values())]))
        rows = clipped.select(F.inline(entries)).groupBy("search", "bin")
        found = rows.agg(F.count("*").alias("n"), F.min("value").alias("least"), F.max("value").alias("greatest"))
        bins: dict[int, list] = {}
        for row in found.collect():
            bins.setdefault(row.search, []).append(row)
        for search in open_:
            search.narrow(bins[places[search.column, search.least, search.greatest]])
    result = {}
    for c in columns:
        own = [s.least for s in searches if s.column == c]
        result[c] = (whole[f"n_{c}"], reduce(lambda a, b: a / 2 + b / 2, own) if own else None)
    return result


def table(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, n, median), a row for each column."""
    rows = [(c, n, median) for c, (n, median) in medians(df, columns).items()]
    return df.sparkSession.createDataFrame(rows, "column string, n long, median double")
