"""What the operators share: stored intermediate tables and task-side batches of text."""

import os
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnrisk.plans.workdir import new_folder

#: Text that one step of a Python task works on at once.
STEP_BYTES = 4 << 20


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def for_tasks(spark: SparkSession) -> None:
    """Let Python tasks on this machine import the package; a cluster has it installed."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The frame written below the shared folder and read back, which ends its lineage."""
    path = new_folder(df.sparkSession, f"llm-{purpose}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_text(docs: DataFrame) -> DataFrame:
    """Id and text alone; a null text is empty."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


def steps(
    batches: Iterator[pa.RecordBatch], column: str = "text", most: int = STEP_BYTES
) -> Iterator[pa.RecordBatch]:
    """The same rows in slices whose texts come to ``most`` bytes or are a single row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        start = size = 0
        for i, n in enumerate(pc.binary_length(batch.column(column)).fill_null(0).to_pylist()):
            if size and size + n > most:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n
        yield batch.slice(start)
        # Arrow keeps what is free; a worker that waits for its next task need not hold it.
        pa.default_memory_pool().release_unused()


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
