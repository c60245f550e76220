"""Folders for data that one run writes and reads back."""

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as named by the cluster in ``spark.checkpoint.dir``.

    Where the setting is missing, a local session gets a temporary folder; a
    cluster has to name one.
    """
    folder = spark.conf.get(SETTING, None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"{SETTING} must name a folder that all executors can reach")
    return tempfile.gettempdir()


def own_folder(spark: SparkSession) -> str:
    """The folder of this application below the shared one."""
    return os.path.join(shared_folder(spark), f"txnrisk-{spark.sparkContext.applicationId}")


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path that nothing else uses, in the application's folder."""
    return os.path.join(own_folder(spark), f"{purpose}-{uuid.uuid4().hex}")


def remove_folders(spark: SparkSession) -> None:
    """Delete what this application has stored there. Results that read it are gone too."""
    place = spark._jvm.org.apache.hadoop.fs.Path(own_folder(spark))
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
