"""Transactions, payers and payees derived from the order tables used for testing.

They have null, blank and repeated ids, bad amounts, join misses, and labelled
and unlabelled rows in proportion to the tables they come from.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _text(name: str) -> Column:
    return F.col(name).cast("string")


def raw_transactions(spark: SparkSession, folder: str) -> DataFrame:
    """One transaction per line item."""
    lines = table(spark, folder, "lineitem")
    orders = table(spark, folder, "orders")
    parts = table(spark, folder, "part")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey).join(
        parts, lines.l_partkey == parts.p_partkey
    )
    kind = (F.col("l_partkey") + F.col("l_suppkey")) % 211
    price = F.col("l_extendedprice")
    own_id = F.concat(F.lit("T"), _text("l_orderkey"), F.lit("-"), _text("l_linenumber"))
    risky = (price > 50000) & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    number = F.col("l_linenumber") % 3
    return joined.select(
        F.when(kind == 0, F.lit(None))
        .when(kind == 1, F.lit("   "))
        .when(kind == 2, F.lit(""))
        .otherwise(own_id)
        .alias("transaction_id"),
        F.col("l_shipdate").alias("timestamp"),
        F.concat(F.lit("C"), _text("o_custkey")).alias("payor_id"),
        F.concat(F.lit("S"), _text("l_suppkey")).alias("payee_id"),
        F.when(kind == 3, F.lit(None))
        .when(kind == 4, F.lit(0.0))
        .when(kind == 5, -price)
        .otherwise(price)
        .alias("amount"),
        F.when(number == 0, "USD").when(number == 1, "EUR").otherwise("GBP").alias("currency"),
        F.col("o_orderpriority").alias("payment_method"),
        F.col("l_linestatus").alias("status"),
        (F.lit(5000) + F.col("p_size")).cast("bigint").alias("merchant_mcc"),
        F.concat(F.lit("dev-"), (F.col("l_partkey") % 500).cast("string")).alias("device_id"),
        F.concat_ws(
            ".",
            F.lit("10.0"),
            (F.col("l_suppkey") % 256).cast("string"),
            (F.col("l_partkey") % 256).cast("string"),
        ).alias("ip_address"),
        F.when(F.col("l_returnflag") == "N", F.lit(None))
        .when(risky == (F.col("l_partkey") % 20 != 0), F.lit(1))
        .otherwise(F.lit(0))
        .cast("bigint")
        .alias("is_fraud"),
    )


def _risk(balance: str) -> Column:
    return (F.lit(10000) - F.col(balance)) / 11000


def payers(spark: SparkSession, folder: str) -> DataFrame:
    """One payer per customer, save every fiftieth."""
    customers = table(spark, folder, "customer").filter("c_custkey % 50 <> 0")
    nations = table(spark, folder, "nation")
    joined = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    key = F.col("c_custkey")
    return joined.select(
        F.concat(F.lit("C"), _text("c_custkey")).alias("payor_id"),
        F.col("c_name").alias("payor_name"),
        F.when(key % 51 != 0, F.col("n_name")).alias("payor_country"),
        F.when(key % 53 != 0, _risk("c_acctbal")).alias("payor_risk_score"),
    )


def payees(spark: SparkSession, folder: str) -> DataFrame:
    """One payee per supplier, save every tenth."""
    suppliers = table(spark, folder, "supplier").filter("s_suppkey % 10 <> 0")
    nations = table(spark, folder, "nation")
    joined = suppliers.join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
    key, kind = F.col("s_suppkey"), F.col("s_suppkey") % 4
    return joined.select(
        F.concat(F.lit("S"), _text("s_suppkey")).alias("payee_id"),
        F.col("s_name").alias("payee_name"),
        F.when(key % 11 != 0, F.col("n_name")).alias("payee_country"),
        F.when(key % 13 != 0, _risk("s_acctbal")).alias("payee_risk_score"),
        F.when(kind == 0, "Retail").when(kind == 1, "Travel").when(kind == 2, "Gaming").alias(
            "payee_category"
        ),
    )
