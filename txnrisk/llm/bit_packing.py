"""Token ids of a corpus in one global order, packed at a fixed width.

The file format is a table of blocks. A block is a run of whole documents:

* ``shard``, ``block``: place of the block; shards are ranges of doc_id, in order,
* ``start``: number of ids in all blocks before it,
* ``n_ids``, ``width``: its ids, and the bits of each,
* ``doc_ids``, ``lengths``: its documents and how many ids each has,
* ``payload``: the ids, least significant bit first, without gaps.

Id i of the corpus lies in the block with start <= i < start + n_ids, at bit
(i - start) * width, so any range is read by itself: Parquet skips the other
blocks by ``start``. Ids need as many bits as the vocabulary's largest id.

Defined results: documents lie in ascending order of id, nulls first, then of
text; a null text is empty and has the end id only; repeated rows are stored each;
an empty table gives no blocks; only ``doc_id`` and ``text`` are looked at.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnrisk.llm.bytes_bpe import END_ID, default_path, encoder
from txnrisk.llm.tables import for_tasks, steps, with_text
from txnrisk.plans.workdir import new_folder

#: A block ends with the document that brings it to so many ids.
BLOCK_IDS = 1 << 18


def width_of(n_ids: int) -> int:
    """Bits that hold every id below ``n_ids``."""
    return max(1, (n_ids - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """The lowest ``width`` bits of each id, end to end."""
    if width in (8, 16, 32):
        return ids.astype(f"<u{width // 8}").tobytes()
    bits = np.unpackbits(
        ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, count=width, bitorder="little"
    )
    return np.packbits(bits.reshape(-1), bitorder="little").tobytes()


def unpack(payload: bytes, width: int, start: int, n: int) -> np.ndarray:
    """``n`` ids from the ``start``-th on, reading only the bytes that hold them."""
    if width in (8, 16, 32):
        size = width // 8
        return np.frombuffer(payload, f"<u{size}", n, start * size).astype("<u4")
    first, last = start * width // 8, -(-(start + n) * width // 8)
    raw = np.frombuffer(payload, np.uint8, last - first, first)
    skip = start * width - first * 8
    bits = np.unpackbits(raw, bitorder="little")[skip : skip + n * width].reshape(n, width)
    whole = np.zeros((n, 32), dtype=np.uint8)
    whole[:, :width] = bits
    return np.packbits(whole, axis=1, bitorder="little").view("<u4").reshape(n)


def _in_order(docs: DataFrame, shards: int) -> DataFrame:
    """Ranges of doc_id, sorted; rows that share an id can still go to several ranges."""
    order = ["doc_id", "text_hash", "salt"]
    salted = with_text(docs).withColumns(
        {"text_hash": F.xxhash64("text"), "salt": F.rand(17)}
    )
    dealt = salted.repartitionByRange(shards, *order)
    return dealt.sortWithinPartitions(*order).select("doc_id", "text")


def write(docs: DataFrame, path: str, tokenizer: str | None = None, shards: int | None = None) -> None:
    """Encode all documents and write the blocks, as Parquet below ``path``.

    Two tables come about: ``blocks``, whose ``start`` counts from the shard's
    begin, and ``shards`` with the number of ids before each shard. The second
    has one row for each shard. A lost task writes its shard again, whole.
    """
    spark = docs.sparkSession
    for_tasks(spark)
    tokenizer = tokenizer or default_path()
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tool = encoder(tokenizer)
        width = width_of(tool.n_ids)
        shard, number, start = TaskContext.get().partitionId(), 0, 0
        ids, names, lengths = [], [], []

        def block() -> pa.RecordBatch:
            flat = np.concatenate(ids)
            return pa.record_batch(
                {
                    "shard": pa.array([shard], pa.int32()),
                    "block": pa.array([number], pa.int64()),
                    "start": pa.array([start], pa.int64()),
                    "n_ids": pa.array([len(flat)], pa.int64()),
                    "width": pa.array([width], pa.int32()),
                    "doc_ids": pa.array([sum(names, [])], pa.list_(kind)),
                    "lengths": pa.array([np.concatenate(lengths)], pa.list_(pa.int64())),
                    "payload": pa.array([pack(flat, width)], pa.binary()),
                }
            )

        for batch in steps(batches):
            kind = batch.column("doc_id").type
            flat, borders = tool.encode(batch.column("text"))
            ids.append(np.insert(flat, borders[1:], END_ID).astype("<u4"))
            names.append(batch.column("doc_id").to_pylist())
            lengths.append(np.diff(borders) + 1)
            if (n := sum(map(len, ids))) >= BLOCK_IDS:
                yield block()
                number, start = number + 1, start + n
                ids, names, lengths = [], [], []
        if ids:
            yield block()

    schema = (
        "shard int, block long, start long, n_ids long, width int,"
        f" doc_ids array<{id_type}>, lengths array<long>, payload binary"
    )
    made = _in_order(docs, shards).mapInArrow(blocks, schema)
    made.write.parquet(f"{path}/blocks")
    # One row for each shard: a running total over them is small.
    totals = spark.read.schema(schema).parquet(f"{path}/blocks").groupBy("shard").agg(
        F.sum("n_ids").alias("n")
    )
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    base.write.parquet(f"{path}/shards")


def read_blocks(spark, path: str) -> DataFrame:
    """All blocks, with ``start`` counted from the begin of the corpus."""
    blocks = spark.read.parquet(f"{path}/blocks")
    base = spark.read.parquet(f"{path}/shards")
    return blocks.join(F.broadcast(base), "shard").withColumn(
        "start", F.col("start") + F.col("base")
    ).drop("base")


def read_documents(spark, path: str) -> DataFrame:
    """doc_id, start and ``ids``, the document's ids as little-endian unsigned 32-bit integers."""
    blocks = read_blocks(spark, path)
    for_tasks(spark)
    id_type = blocks.schema["doc_ids"].dataType.elementType.simpleString()

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind = batch.schema.field("doc_ids").type.value_type
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                ids = unpack(row["payload"], row["width"], 0, row["n_ids"]).astype("<u4")
                borders = np.concatenate([[0], np.cumsum(row["lengths"])])
                raw = ids.tobytes()
                yield pa.record_batch(
                    {
                        "doc_id": pa.array(row["doc_ids"], kind),
                        "start": pa.array(borders[:-1] + row["start"]),
                        "ids": pa.array(
                            [raw[4 * a : 4 * b] for a, b in zip(borders, borders[1:], strict=False)],
                            pa.binary(),
                        ),
                    }
                )

    wanted = ["doc_ids", "lengths", "payload", "width", "n_ids", "start"]
    schema = f"doc_id {id_type}, start long, ids binary"
    return blocks.select(wanted).mapInArrow(documents, schema)


def read_range(spark, path: str, start: int, n: int) -> np.ndarray:
    """``n`` ids of the corpus from the ``start``-th on; only the blocks that hold them are read."""
    end = start + n
    hit = read_blocks(spark, path).filter((F.col("start") < end) & (F.col("start") + F.col("n_ids") > start))
    rows = hit.orderBy("start").select("start", "n_ids", "width", "payload").toLocalIterator()
    parts = []
    for row in rows:
        first, last = max(start, row.start), min(end, row.start + row.n_ids)
        parts.append(unpack(row.payload, row.width, first - row.start, last - first))
    return np.concatenate(parts) if parts else np.zeros(0, dtype="<u4")


def round_trip(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Write the documents to a new shared folder and read them back."""
    path = new_folder(docs.sparkSession, "llm-ids")
    write(docs, path, tokenizer)
    return read_documents(docs.sparkSession, path)


def digest(documents: DataFrame) -> DataFrame:
    """Length and checksum instead of the ids."""
    return documents.select(
        "doc_id",
        "start",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )
