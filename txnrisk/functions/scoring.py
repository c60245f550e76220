"""From a model's probability vector to an alert."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: transactions at or above this probability are reviewed.
HIGH_RISK = 0.5


def fraud_probability(vector: str = "probability") -> Column:
    """Probability of class 1; 0.0 where the vector is missing or too short."""
    values = F.when(F.col(vector).isNotNull(), vector_to_array(F.col(vector)))
    return F.coalesce(F.get(values, F.lit(1)), F.lit(0.0))


def predicted(score: str = "fraud_probability", threshold: float = HIGH_RISK) -> Column:
    """1.0 at or above the threshold, else 0.0."""
    return (F.col(score) >= threshold).cast("double")
