"""Documents cut into sequences of power-of-two lengths.

A document of n ids becomes n // longest sequences of the longest length, then
one for each binary digit of the rest, in falling order. Every sequence has ids
of one document and a length that is a power of two, so none is padded and
none crosses documents. Sequences of one length make a bucket, from which
batches of equal length are drawn: ``write`` stores each bucket in a folder, in
files of a good size whatever the number of tasks, and ``read`` numbers the
sequences as they lie there.

Defined results: a null or empty text has the end id only, one sequence of
length 1; rows are cut one by one, so repeated rows give sequences of their
own; null ids stay null; an empty table gives none; only ``doc_id`` and
``text`` are looked at.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnrisk.llm.bytes_bpe import END_ID, default_path, encoder
from txnrisk.llm.tables import for_tasks, steps, with_text
from txnrisk.plans.workdir import new_folder

LONGEST = 1024


def cut(n: int, longest: int) -> list[int]:
    """The lengths of a document's pieces."""
    rest = n % longest
    digits = [1 << b for b in range(longest.bit_length() - 1, -1, -1) if rest >> b & 1]
    return [longest] * (n // longest) + digits


def sequences(docs: DataFrame, tokenizer: str | None = None, longest: int = LONGEST) -> DataFrame:
    """doc_id, start, length, ``ids`` (little-endian unsigned 32-bit), doc_tokens: the pieces in document order.

    ``longest`` is a power of two. Nothing is shuffled.
    """
    if longest & (longest - 1):
        raise ValueError("the longest length must be a power of two")
    for_tasks(docs.sparkSession)
    tokenizer = tokenizer or default_path()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(tokenizer)
        for batch in steps(batches):
            flat, borders = tool.encode(batch.column("text"))
            ids = np.insert(flat, borders[1:], END_ID).astype("<u4").tobytes()
            totals = np.diff(borders) + 1
            lengths = [cut(n, longest) for n in totals.tolist()]
            counts = np.array([len(x) for x in lengths])
            length = np.concatenate(lengths).astype(np.int64)
            ends = np.cumsum(length)
            begins = ends - length
            owner = np.repeat(np.arange(len(counts)), counts)
            cuts = zip((4 * begins).tolist(), (4 * ends).tolist(), strict=True)
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id").take(pa.array(owner)),
                    "start": begins - (np.cumsum(totals) - totals)[owner],
                    "length": length,
                    "ids": pa.array([ids[a:b] for a, b in cuts], pa.binary()),
                    "doc_tokens": totals[owner],
                }
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, start long, length long, ids binary, doc_tokens long"
    return with_text(docs).mapInArrow(pieces, schema)


def write(packed: DataFrame, path: str) -> None:
    """One folder for each length.

    The sequences are shuffled by length; Spark cuts the large lengths, so that
    none is one task's, and a task has few lengths and writes few files. Ids leave
    half of their bytes zero, which zstd packs best.
    """
    dealt = packed.hint("rebalance", "length")
    dealt.write.partitionBy("length").option("compression", "zstd").parquet(path)


def read(spark: SparkSession, path: str, id_type: str = "long") -> DataFrame:
    """The stored sequences with ``sequence_id`` and ``offset``, which is 0: a piece is a sequence.

    A file has one length. The number tells a sequence's place in the files, so
    it is unique within one run; store the result to use it twice.
    """
    schema = f"doc_id {id_type}, start long, ids binary, doc_tokens long, length long"
    found = spark.read.schema(schema).parquet(path).select("doc_id", "start", "length", "ids", "doc_tokens")
    return found.withColumns({"sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")})


def bucketed(docs: DataFrame, tokenizer: str | None = None, longest: int = LONGEST) -> DataFrame:
    """The documents' sequences, written to buckets in a new shared folder and read back."""
    spark, path = docs.sparkSession, new_folder(docs.sparkSession, "llm-buckets")
    write(sequences(docs, tokenizer, longest), path)
    return read(spark, path, docs.schema["doc_id"].dataType.simpleString())


def digest(packed: DataFrame) -> DataFrame:
    """A checksum instead of the ids."""
    return packed.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )
