"""Small frames for tests: rows given as dicts, the rest filled in."""

import datetime

from txnrisk.schemas import RAW_COLUMNS, typed_schema

DAY = datetime.datetime(2026, 1, 1)
DEFAULT = {
    "timestamp": DAY,
    "payor_id": "C1",
    "payee_id": "S1",
    "amount": 10.0,
    "currency": "USD",
    "payment_method": "card",
    "status": "ok",
    "merchant_mcc": 5411,
    "device_id": "d",
    "ip_address": "10.0.0.1",
    "is_fraud": None,
}


def raw(spark, *rows):
    full = [{"transaction_id": None, **DEFAULT, **row} for row in rows]
    return spark.createDataFrame(
        [tuple(row[c] for c in RAW_COLUMNS) for row in full], typed_schema(RAW_COLUMNS)
    )


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
