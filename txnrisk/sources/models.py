"""Saving and loading fitted models."""

import logging

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from txnrisk.sources.files import first_existing, path_exists

log = logging.getLogger(__name__)


def save_model(model: PipelineModel, path: str, second: str | None = None) -> str:
    """Overwrite the model at the path, or at the second path if the first cannot be written."""
    try:
        model.write().overwrite().save(path)
        return path
    except Exception:
        if second is None:
            raise
        log.warning("model not saved at %s, trying %s", path, second, exc_info=True)
    model.write().overwrite().save(second)
    return second


def model_exists(spark: SparkSession, path: str, second: str | None = None) -> bool:
    return any(path_exists(spark, f"{p}/metadata") for p in (path, second) if p)


def load_model(spark: SparkSession, path: str, second: str | None = None) -> PipelineModel:
    """Load from the path or, if there is nothing, from the second path."""
    found = first_existing(spark, *[f"{p}/metadata" for p in (path, second) if p])
    return PipelineModel.load(found.removesuffix("/metadata"))
