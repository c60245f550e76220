"""Train and test parts of the labelled rows."""

import math
from fractions import Fraction
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnrisk.schemas import LABEL

# The share that is trained on, and the seed.
TRAIN_SHARE = Fraction(4, 5)
SEED = 42
# Rows that a counting bucket should hold at most, on average.
BUCKET_ROWS = 100_000


def random_split(
    df: DataFrame, key: str = "transaction_id", seed: int = SEED, share: Fraction = TRAIN_SHARE
) -> tuple[DataFrame, DataFrame]:
    """80/20 at random, whatever the label: by a hash of seed and id.

    The parts do not depend on partitioning, and every row is in one of them.
    Rows without an id are kept for training.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key)))
    place = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    cut = share.numerator * 2**32 // share.denominator
    in_train = F.coalesce(place < cut, F.lit(True))
    return df.filter(in_train), df.filter(~in_train)


def bucket_digits(rows: int) -> int:
    """First hex digits of the hash that make a counting bucket of about ``BUCKET_ROWS`` rows."""
    return max(2, math.ceil(math.log(max(1, rows / BUCKET_ROWS), 16)))


def _hash_cutoffs(hashed: DataFrame, label: str, share: Fraction) -> DataFrame:
    """Per label the largest hash that still goes to training: (label, cutoff).

    Rows are first counted per leading hash digits. The running total of those
    counts tells in which bucket the share is reached, and only that bucket's
    hashes are ordered one by one.
    """
    so_far = Window.partitionBy(label).orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    whole = Window.partitionBy(label)
    buckets = (
        hashed.groupBy(label, "bucket")
        .agg(F.count("*").alias("n"))
        .withColumn("upto", F.sum("n").over(so_far))
        .withColumn(
            "wanted",
            F.floor(F.sum("n").over(whole) * share.numerator / share.denominator),
        )
        .withColumn("before", F.col("upto") - F.col("n"))
    )
    # One bucket per label: the last one that training takes anything from.
    edge = buckets.filter((F.col("before") < F.col("wanted")) & (F.col("wanted") <= F.col("upto")))
    in_edge = hashed.join(
        F.broadcast(edge.select(label, "bucket", "before", "wanted")), [label, "bucket"]
    )
    per_hash = in_edge.groupBy(label, "hash").agg(
        F.count("*").alias("n"),
        F.first("before").alias("before"),
        F.first("wanted").alias("wanted"),
    )
    by_hash = Window.partitionBy(label).orderBy("hash").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    taken = per_hash.withColumn("upto", F.col("before") + F.sum("n").over(by_hash))
    last = taken.filter(F.col("upto") <= F.col("wanted")).groupBy(label).agg(
        F.max("hash").alias("last_hash")
    )
    # When the edge bucket's first hash is already too much, training ends before that bucket.
    return (
        edge.select(label, "bucket")
        .join(last, label, "left")
        .select(label, F.coalesce("last_hash", "bucket").alias("cutoff"))
    )


def _is_train(df: DataFrame, label: str, key: str, share: Fraction) -> Column:
    """Whether a row goes to training: its hash is up to its label's cutoff.

    The cutoffs, one per class, are fetched here, so that the parts are plain
    filters afterwards and never work out the cutoffs again.
    """
    digits = bucket_digits(df.count())
    hashed = df.select(label, F.md5(key).alias("hash")).withColumn(
        "bucket", F.substring("hash", 1, digits)
    )
    cutoffs = _hash_cutoffs(hashed, label, share).collect()
    upto_cutoff = [
        (F.col(label) == row[label]) & (F.md5(key) <= row["cutoff"]) for row in cutoffs
    ]
    return reduce(Column.__or__, upto_cutoff, F.lit(False))


def stratified_split(
    df: DataFrame,
    label: str = LABEL,
    key: str = "transaction_id",
    share: Fraction = TRAIN_SHARE,
) -> DataFrame:
    """Add ``split``: ``train`` for exactly the given share of each label, else ``test``.

    Rows are taken in the order of their id's hash, so the parts depend on the
    ids alone: not on partitioning, order or a previous run. Rows with the same
    id stay on one side. Whole labels never meet in one task. Counts the input
    and reads its ids and labels twice at once: pass a stored frame.
    """
    in_train = _is_train(df, label, key, share)
    return df.withColumn("split", F.when(in_train, "train").otherwise("test"))


def split_frames(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Train and test rows of ``stratified_split``, without the marker column."""
    marked = stratified_split(df)
    return tuple(
        marked.filter(F.col("split") == part).drop("split") for part in ("train", "test")
    )
