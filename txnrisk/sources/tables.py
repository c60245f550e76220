"""Stored tables. The format is a parameter, so a connector works like Parquet."""

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from txnrisk.operators.queue import not_queued, one_per_id
from txnrisk.operators.sieve import words_for
from txnrisk.plans.workdir import new_folder
from txnrisk.sources.files import path_exists

# Formats whose folders a schema can be given for; the others know their columns.
FILE_FORMATS = ("parquet", "orc", "json", "csv", "avro")
#: Directories that a task writes to at once; with more values of the column it sorts the rest by them.
WRITERS = 8
#: Rows that a bucket should hold at most, on average.
BUCKET_ROWS = 1_000_000


@contextmanager
def unsorted_writes(spark: SparkSession) -> Iterator[None]:
    """Rows go to their directories as they come. Spark would sort all of them by directory first."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name, None)
    spark.conf.set(name, WRITERS)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def buckets_for(rows: int, least: int = 8) -> int:
    """Buckets of about ``BUCKET_ROWS`` rows at most, so that a task's share stays as it is when a table grows."""
    return max(least, -(-rows // BUCKET_ROWS))


@dataclass(frozen=True)
class Table:
    """A table at a path, in the catalog (``name``) or behind a connector (``options``).

    A catalog table can be stored in ``buckets`` by the hash of a column and
    sorted by it there. Joins, windows and groups by that column, and joins of
    two tables with as many buckets, then shuffle and sort nothing.
    """

    path: str | None = None
    name: str | None = None
    format: str = "parquet"
    options: dict[str, str] = field(default_factory=dict)
    bucket_by: str | None = None
    buckets: int = 0

    def exists(self, spark: SparkSession) -> bool:
        """Connectors without path or name count as existing."""
        if self.name:
            return spark.catalog.tableExists(self.name)
        return path_exists(spark, self.path) if self.path else True

    def read(self, spark: SparkSession, schema: StructType | None = None) -> DataFrame:
        """The table. With a schema, a folder of files has these columns, even without any row."""
        if self.name:
            return spark.table(self.name)
        reader = spark.read.format(self.format).options(**self.options)
        if schema is not None and self.path and self.format in FILE_FORMATS:
            reader = reader.schema(schema)
        return reader.load(self.path)

    def __post_init__(self):
        if self.bucket_by and not (self.name and self.buckets > 0):
            raise ValueError("buckets need a catalog table and their number")

    def write(self, df: DataFrame, mode: str, partition_by: str | None = None) -> None:
        if self.bucket_by:
            # One file a bucket instead of one for each task and bucket.
            df = df.repartition(self.buckets, self.bucket_by)
        writer = df.write.format(self.format).options(**self.options).mode(mode)
        if partition_by and (self.path or self.name):
            writer = writer.partitionBy(partition_by)
        if not self.name:
            with unsorted_writes(df.sparkSession):
                return writer.save(self.path)
        if self.bucket_by:
            writer = writer.bucketBy(self.buckets, self.bucket_by).sortBy(self.bucket_by)
        writer.saveAsTable(self.name)

    def replace(self, df: DataFrame, partition_by: str | None = None) -> None:
        self.write(df, "overwrite", partition_by)

    def append(self, df: DataFrame) -> None:
        self.write(df, "append")

    def append_checked(
        self, make: Callable[[DataFrame | None], DataFrame], schema: StructType, batch: str | None = None
    ) -> None:
        """Append what ``make`` makes of the present rows, None where there is no table yet.

        Nothing watches for other writers here, and batches are not remembered.
        """
        spark = SparkSession.active()
        self.append(make(self.read(spark, schema) if self.exists(spark) else None))


def in_few_files(df: DataFrame) -> DataFrame:
    """For a small result of many tasks: AQE merges it into files of a good size first."""
    return df.hint("rebalance")


def materialize(df: DataFrame, name: str, table: Table | None = None) -> DataFrame:
    """Give a model a name: stored in ``table`` and read back, or as a view when none is given."""
    if table is not None:
        table.replace(df)
        df = table.read(df.sparkSession, df.schema)
    df.createOrReplaceTempView(name)
    return df


def append_new(alerts: DataFrame, queue: Table, batch: str | None = None) -> None:
    """Append the alerts that are not queued yet, one for each id.

    The alerts are stored first: they are counted, sieved and joined, and what
    made them runs once. A Bloom filter of their ids keeps most of the queue from
    being shuffled. Where the queue has versions, a ``batch`` that is in it adds
    nothing, and runs that append at the same time see each other's rows.
    """
    spark = alerts.sparkSession
    staged = Table(new_folder(spark, "alerts"))
    staged.replace(in_few_files(one_per_id(alerts)))
    new = staged.read(spark, alerts.schema)
    words = words_for(new.count())

    def missing(queued: DataFrame | None) -> DataFrame:
        return in_few_files(new if queued is None else not_queued(new, queued, words))

    queue.append_checked(missing, new.schema, batch)
