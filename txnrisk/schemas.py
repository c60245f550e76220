"""Column names, order and types of every layer."""

from pyspark.sql import types as T

# The layers' columns in their published order.
RAW_COLUMNS = [
    "transaction_id",
    "timestamp",
    "payor_id",
    "payee_id",
    "amount",
    "currency",
    "payment_method",
    "status",
    "merchant_mcc",
    "device_id",
    "ip_address",
    "is_fraud",
]
PAYER_COLUMNS = ["payor_id", "payor_name", "payor_country", "payor_risk_score"]
PAYEE_COLUMNS = ["payee_id", "payee_name", "payee_country", "payee_risk_score", "payee_category"]
GOLD_COLUMNS = [
    "transaction_id",
    "timestamp",
    "amount",
    "currency",
    "payment_method",
    "status",
    "merchant_mcc",
    "device_id",
    "ip_address",
    "payor_id",
    "payor_name",
    "payor_country",
    "payor_risk_score",
    "payee_id",
    "payee_name",
    "payee_country",
    "payee_risk_score",
    "payee_category",
    "is_fraud",
]
QUEUE_COLUMNS = [
    "transaction_id",
    "amount",
    "currency",
    "device_id",
    "ip_address",
    "merchant_mcc",
    "payee_id",
    "payment_method",
    "payor_id",
    "status",
    "timestamp",
    "payor_name",
    "payor_country",
    "payor_risk_score",
    "payee_name",
    "payee_country",
    "payee_risk_score",
    "payee_category",
    "is_fraud",
    "prediction",
]
ALERT_SAMPLE_COLUMNS = ["transaction_id", "payor_name", "payee_name", "amount", "prediction"]

# Model inputs.
CATEGORICAL_FEATURES = [
    "payment_method",
    "currency",
    "payor_country",
    "payee_country",
    "payee_category",
]
NUMERIC_FEATURES = ["amount", "payor_risk_score", "payee_risk_score", "merchant_mcc"]
LABEL = "is_fraud"
CLASSES = (0, 1)

DOUBLE_COLUMNS = ["amount", "payor_risk_score", "payee_risk_score"]

_TYPES = {
    "timestamp": T.TimestampType(),
    "amount": T.DoubleType(),
    "payor_risk_score": T.DoubleType(),
    "payee_risk_score": T.DoubleType(),
    "prediction": T.DoubleType(),
    "merchant_mcc": T.LongType(),
    "is_fraud": T.LongType(),
}


def typed_schema(columns: list[str]) -> T.StructType:
    """The schema of a cleaned layer."""
    return T.StructType([T.StructField(c, _TYPES.get(c, T.StringType())) for c in columns])


def text_schema(columns: list[str]) -> T.StructType:
    """The same columns as they arrive in text files, before any parsing."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])
