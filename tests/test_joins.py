import frames
from pyspark.sql import functions as F

from txnrisk.operators import enrich, joins


def facts(spark, rows=30000):
    """A third of the rows have one key, a tenth have none, some match nothing."""
    i = F.col("id")
    key = F.when(i % 3 == 0, "hot").when(i % 10 != 1, F.concat(F.lit("k"), i % 500))
    return spark.range(0, rows, 1, 8).select(
        F.concat(F.lit("T"), i).alias("transaction_id"), key.alias("key")
    )


def lookup(spark):
    """Keys k0 to k399 and the hot key twice, and a null key that must match nothing."""
    keys = [(f"k{i}", i) for i in range(400)] + [("hot", 1000), ("hot", 1001), (None, 7)]
    return spark.createDataFrame(keys, "key string, value int")


def same_rows(a, b):
    assert a.columns == b.columns
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_split_keys_give_the_plain_left_join(spark):
    left, right = facts(spark), lookup(spark)
    frequent = joins.frequent_keys(left, "key", joins.Limits(shares=100, smallest_share=200))
    assert {r.key for r in frequent.collect()} == {"hot"}
    pieces = frequent.first().pieces
    assert pieces > 10
    joined = joins.split_key_left_join(left, right, "key", "transaction_id", frequent)
    plain = left.join(right, "key", "left").select(joined.columns)
    assert same_rows(joined, plain)
    assert joined.count() == 30000 + 10000


def test_no_task_gets_more_than_a_share_of_one_key(spark):
    left = facts(spark)
    frequent = joins.frequent_keys(left, "key", joins.Limits(shares=100, smallest_share=200))
    pieces = frequent.first().pieces
    piece = F.pmod(F.xxhash64("transaction_id"), F.lit(pieces))
    largest = left.filter("key = 'hot'").groupBy(piece).count().agg(F.max("count")).first()[0]
    assert largest < 2 * 30000 / 100


def test_few_rows_have_no_frequent_keys(spark):
    assert joins.frequent_keys(facts(spark), "key").isEmpty()


def test_measured_size_decides(spark):
    left, right = facts(spark), lookup(spark)
    (size,) = joins.measured_bytes(right)
    text = sum(len(f"k{i}") for i in range(400)) + 2 * len("hot")
    assert size == text + 403 * 32
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = joins.lookup_join(left, right, "key", "transaction_id", size, joins.Limits(size))
        large = joins.lookup_join(left, right, "key", "transaction_id", size, joins.Limits(size - 1))
        assert "SortMergeJoin" not in frames.plan_of(small)
        assert "SortMergeJoin" in frames.plan_of(large)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert same_rows(small, large.select(small.columns))


def test_empty_lookup(spark):
    right = lookup(spark).limit(0)
    assert joins.measured_bytes(right) == [0]
    joined = joins.lookup_join(facts(spark), right, "key", "transaction_id", 0)
    assert joined.filter("value IS NULL").count() == 30000


def test_repeated_lookup_keys_multiply_rows_and_gaps_are_filled(spark):
    silver = frames.raw(
        spark,
        {"transaction_id": "A"},
        {"transaction_id": "B", "payor_id": "C2", "payee_id": None},
    )
    payers = spark.createDataFrame(
        [("C1", "n1", None, "0.5"), ("C1", "n2", "NA", "x")],
        "payor_id string, payor_name string, payor_country string, payor_risk_score string",
    )
    payees = spark.createDataFrame(
        [("S1", "m", "X", 0.25, None)],
        "payee_id string, payee_name string, payee_country string, payee_risk_score double,"
        " payee_category string",
    )
    for limits in (joins.LIMITS, joins.Limits(broadcast_bytes=0, smallest_share=1)):
        rows = enrich.enrich(silver, payers, payees, limits).collect()
        got = {
            (r.transaction_id, r.payor_name, r.payor_country, r.payor_risk_score, r.payee_category)
            for r in rows
        }
        assert got == {
            ("A", "n1", "UNKNOWN", 0.5, "General"),
            ("A", "n2", "NA", 0.0, "General"),
            ("B", None, "UNKNOWN", 0.0, "General"),
        }
        assert len(rows) == 3
