"""A Spark session with the settings these jobs expect."""

import os

from pyspark.sql import SparkSession


def builder(
    app: str = "txnrisk",
    shuffle_partitions: int | None = None,
    split_size: str | None = None,
    ui: bool = False,
) -> SparkSession.Builder:
    """AQE on, so that shuffle partitions are merged or split by their real size.

    For large inputs give ``shuffle_partitions``, about one per 200 MB of
    shuffled data (AQE merges what turns out small), and ``split_size``, the
    input bytes of one scan task: at ``512m`` 100 TB are 200,000 tasks. The
    ingestion writes one file per task and record state, so up to four times as
    many files; those of the rare states are small. Compact these folders, or
    give larger splits, where the store minds.
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": str(ui).lower(),
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if split_size:
        settings["spark.sql.files.maxPartitionBytes"] = split_size
    return SparkSession.builder.appName(app).config(map=settings)


def share_code(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package; a cluster has it installed."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
