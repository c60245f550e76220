"""SimHash near-duplicates by covering locality-sensitive hashing.

A fingerprint has a bit where more than half of a text's word-shingle hashes
have it. To find all pairs that differ in at most ``radius`` bits, each of the
64 bit positions gets a vector over GF(2) of ``radius + 1`` components. Each
non-zero vector v of that space makes one table, whose mask keeps the positions
with <position, v> = 1. At most ``radius`` positions span less than the space,
so some v is orthogonal to them all: its mask skips every bit in which a pair
differs, and the pair has one key in that table. No pair is missed.

Defined results: a null, empty or blank text has fingerprint 0 and is linked
like any other; rows with a null id get a fingerprint and the smallest id of
their group, null if it has none; repeated rows repeat their result; an empty
table gives an empty result; only ``doc_id`` and ``text`` are looked at.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnrisk.llm import links
from txnrisk.llm.tables import for_tasks, fresh, steps, stored, with_text

SEED = 42
BITS = 64
#: Shingles whose hashes are in memory at once.
SHINGLES = 1 << 16


def fingerprint(text: str, words: int) -> int:
    """Unsigned; words are split at ASCII white space and lower-cased in A-Z."""
    parts = text.encode().lower().split()
    if not parts:
        return 0
    count, ones = max(1, len(parts) - words + 1), np.zeros(BITS, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, count, SHINGLES):
        piece = parts[at : at + SHINGLES + words - 1]
        shingles = zip(*(piece[i:] for i in range(min(words, len(parts)))), strict=False)
        hashes = np.array([digest(b" ".join(s), SEED) for s in shingles], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > count, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int) -> DataFrame:
    """doc_id and ``print``, the 64 bits as a long."""
    for_tasks(docs.sparkSession)

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            found = np.array(
                [fingerprint(t, words) for t in batch.column("text").to_pylist()], dtype=np.uint64
            )
            yield pa.record_batch(
                {"doc_id": batch.column("doc_id"), "print": pa.array(found.view(np.int64))}
            )

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, print long"
    return with_text(docs).mapInArrow(prints, schema)


def masks(radius: int) -> list[int]:
    """One mask of kept bit positions for each table, unsigned."""
    vectors = 2 ** (radius + 1)
    at = [1 + i % (vectors - 1) for i in range(BITS)]
    return [
        sum(1 << i for i in range(BITS) if (at[i] & v).bit_count() % 2) for v in range(1, vectors)
    ]


def _signed(bits: int) -> int:
    return bits - (1 << BITS) if bits >> (BITS - 1) else bits


def keys(radius: int) -> Column:
    """Table and masked fingerprint, one for each table."""
    return F.array(
        *[
            F.struct(
                F.lit(table).cast("short").alias("tab"),
                F.col("print").bitwiseAND(F.lit(_signed(mask))).alias("masked"),
            )
            for table, mask in enumerate(masks(radius))
        ]
    )


def _near(radius: int):
    def pairs(block: dict[str, np.ndarray]) -> links.Edges:
        prints = block["print"].view(np.uint64)
        return links.forest(
            prints.view(np.int64),
            lambda i, j: np.bitwise_count(prints[i, None] ^ prints[None, j]) <= radius,
        )

    return pairs


def linked_prints(prints: DataFrame, radius: int) -> DataFrame:
    """``node`` and ``root`` of distinct fingerprints that have links, by reachability.

    Each bucket gives a spanning forest of its links, not all pairs.
    """
    rows = prints.select("print", F.explode(keys(radius)).alias("k")).select("print", "k.*")
    # A bucket whose smallest and largest fingerprints are one has no pair.
    sizes = rows.groupBy("tab", "masked").agg(F.count("*").alias("n")).filter("n > 1")
    blocks = links.in_blocks(rows, stored(sizes, "buckets"), ["tab", "masked"], "print")
    edges = links.found(blocks, ["tab", "masked"], ["print"], _near(radius), "u long, v long")
    return links.components(edges)


def _grouped(docs: DataFrame, words: int, radius: int) -> tuple[DataFrame, DataFrame]:
    """The rows' fingerprints, and for each fingerprint its group's root and smallest id."""
    prints = stored(fingerprints(docs, words), "prints")
    firsts = stored(prints.groupBy("print").agg(F.min("doc_id").alias("first")), "firsts")
    roots = linked_prints(firsts, radius).withColumnRenamed("node", "print")
    rooted = firsts.join(roots, "print", "left").withColumn("root", F.coalesce("root", "print"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    by_print = rooted.join(smallest, "root").select("print", "root", "component_id")
    return prints, stored(by_print, "groups")


def groups(docs: DataFrame, words: int = 4, radius: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, the smallest id reachable."""
    prints, by_print = _grouped(docs, words, radius)
    return prints.join(by_print, "print").select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _first_by_text(rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Of the rows of each key the first by text, which each task finds before the shuffle."""
    number = fresh(rows, "number")
    order = Window.partitionBy(key).orderBy(F.col("text").asc_nulls_last())
    numbered = rows.withColumn(number, F.row_number().over(order))
    return numbered.filter(F.col(number) == 1).select(columns)


def one_of_each(docs: DataFrame, words: int = 4, radius: int = 4) -> DataFrame:
    """All columns of one row of each group: the row whose id is the group's smallest.

    Of a group's rows that share that id, or have none where no row has one, the
    first by text stays. Rows of one id with different texts can be of different groups.
    """
    prints, by_print = _grouped(docs, words, radius)
    leaders = by_print.select(F.col("component_id").alias("doc_id")).dropna().distinct()
    named = docs.join(leaders, "doc_id", "left_semi").select(docs.columns)
    # Ids do not tell the group of rows without one, and of those whose id has several fingerprints.
    ends = prints.groupBy("doc_id").agg(F.min("print").alias("low"), F.max("print").alias("high"))
    several = stored(ends.filter("doc_id is not null and low <> high").select("doc_id"), "several")
    nameless = docs.filter("doc_id is null")
    shared = several.take(1)
    if not shared and not nameless.take(1):
        return _first_by_text(named, "doc_id", docs.columns)
    odd = nameless
    if shared:
        odd = odd.unionByName(named.join(several, "doc_id", "left_semi").select(docs.columns))
        named = named.join(several, "doc_id", "left_anti").select(docs.columns)
    kept = _first_by_text(named, "doc_id", docs.columns)
    row, root = fresh(docs, "row"), fresh(docs, "root")
    rows = odd.select(F.struct(*docs.columns).alias("doc_id"), "text")
    roots = by_print.select("print", F.col("root").alias(root), "component_id")
    rooted = fingerprints(rows, words).withColumnRenamed("doc_id", row).join(roots, "print")
    first = rooted.filter(F.col(f"{row}.doc_id").eqNullSafe(F.col("component_id")))
    spread = first.select(root, f"{row}.*")
    return kept.unionByName(_first_by_text(spread, root, docs.columns))
