from datetime import timedelta
from random import Random

import frames
from pyspark.sql import functions as F

from txnrisk.functions import parsing
from txnrisk.operators import clean
from txnrisk.schemas import RAW_COLUMNS, text_schema


def kept(df):
    return {(r.transaction_id, r.amount, r.payee_id) for r in df.collect()}


def test_odd_numbers_are_missing(spark):
    texts = ["12", " 1.5 ", "-.5", "1e3", "5.", "12d", "12f", "0x1p4", "1e999", "Infinity", "NaN", "1,5", "", "n/a"]
    rows = spark.createDataFrame([(t, t, t, t) for t in texts], "timestamp string, amount string, merchant_mcc string, is_fraud string")
    found = {r.t: r.amount for r in clean.typed(rows.withColumn("t", F.col("amount"))).collect()}
    known = {"12": 12.0, " 1.5 ": 1.5, "-.5": -0.5, "1e3": 1000.0, "5.": 5.0}
    assert found == {t: known.get(t) for t in texts}
    floats = spark.createDataFrame([(x,) for x in (float("inf"), float("nan"), 1.0)], "amount double")
    assert [r[0] for r in floats.select(parsing.to_double(floats, "amount")).collect()] == [None, None, 1.0]


def test_blank_ids_are_dropped_and_a_tab_is_an_id(spark):
    raw = frames.raw(spark, *[{"transaction_id": i} for i in (None, "", "   ", "\t", "T1")])
    assert {r.transaction_id for r in clean.latest(raw).collect()} == {"\t", "T1"}
    assert {r.transaction_id for r in clean.quarantine(raw).collect()} == {None, "", "   "}


def test_latest_row_wins_even_with_a_bad_amount(spark):
    raw = frames.raw(
        spark,
        {"transaction_id": "A", "amount": 5.0},
        {"transaction_id": "A", "amount": None, "timestamp": frames.DAY + timedelta(1)},
        {"transaction_id": "B", "amount": 7.0},
        {"transaction_id": "B", "amount": 9.0, "timestamp": None},
    )
    assert kept(clean.latest(raw)) == {("A", None, "S1"), ("B", 7.0, "S1")}


def test_ties_are_broken_the_same_way_on_any_partitioning(spark):
    rows = [
        {"transaction_id": "A", "amount": a, "payee_id": p, "status": s}
        for a in (1.0, 3.0, None)
        for p in ("S2", "S1", None)
        for s in ("x", "y")
    ]
    raw = frames.raw(spark, *rows)
    results = [clean.latest(raw.repartition(n, F.rand(n))).collect() for n in (1, 3, 7)]
    assert results[0] == results[1] == results[2]
    assert (results[0][0].amount, results[0][0].payee_id, results[0][0].status) == (3.0, "S1", "x")


def test_one_id_with_a_third_of_all_rows(spark):
    day = F.timestamp_add("second", F.col("id"), F.lit(frames.DAY))
    rows = spark.range(0, 30000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("T"), F.col("id"))).alias(
            "transaction_id"
        ),
        day.alias("timestamp"),
        F.col("id").cast("double").alias("amount"),
    )
    missing = [c for c in RAW_COLUMNS if c not in rows.columns]
    types = frames.raw(spark).schema
    raw = rows.withColumns({c: F.lit(None).cast(types[c].dataType) for c in missing})
    result = clean.latest(raw)
    assert result.count() == 20001
    assert result.filter("transaction_id = 'hot'").first().amount == 29997.0
    # The limit per id comes before the shuffle, so the hot id leaves each task as one row.
    plan = frames.plan_of(result)
    assert "WindowGroupLimit" in plan.split("Exchange hashpartitioning", 1)[1]


def test_reasons(spark):
    raw = frames.raw(
        spark,
        {"transaction_id": None, "amount": -1.0},
        {"transaction_id": "A", "amount": 0.0},
        {"transaction_id": "B", "amount": None},
        {"transaction_id": "C", "amount": 0.01},
    )
    reasons = {(r.transaction_id, r.quarantine_reason) for r in clean.quarantine(raw).collect()}
    assert reasons == {
        (None, "MISSING_TRANSACTION_ID"),
        ("A", "INVALID_AMOUNT"),
        ("B", "INVALID_AMOUNT"),
    }


def test_stored_state_gives_the_same_rows(spark):
    raw = frames.raw(
        spark,
        {"transaction_id": " "},
        {"transaction_id": "A", "amount": -1.0},
        {"transaction_id": "B"},
    )
    stated = clean.with_state(raw)
    assert kept(clean.latest(stated)) == kept(clean.latest(raw))
    assert kept(clean.quarantine(stated)) == kept(clean.quarantine(raw))


def test_casts_of_odd_text(spark):
    def row(i, amount, mcc, label, time="2026-01-02T03:04:05"):
        return (i, time, None, None, amount, None, None, None, mcc, None, None, label)

    raw = spark.createDataFrame(
        [
            row("a", "12.5", "5411", "1"),
            row("b", "NaN", "5411.0", "true"),
            row("c", "x", "x", "False", "yesterday"),
            row("d", "1e3", "", "0.0", None),
            row("e", None, None, None),
        ],
        text_schema(RAW_COLUMNS),
    )
    got = {
        r.transaction_id: (r.amount, r.merchant_mcc, r.is_fraud, r.timestamp is None)
        for r in clean.typed(raw).collect()
    }
    assert got == {
        "a": (12.5, 5411, 1, False),
        "b": (None, 5411, 1, False),
        "c": (None, None, 0, True),
        "d": (1000.0, None, 0, True),
        "e": (None, None, None, False),
    }


def test_nan_amounts_are_quarantined_before_and_after_typing(spark):
    raw = frames.raw(spark, {"transaction_id": "A", "amount": float("nan")})
    assert clean.quarantine(raw).count() == 1
    assert clean.quarantine(clean.typed(raw)).count() == 1


def test_random_rows_match_a_plain_sort(spark):
    random = Random(7)

    def pick(*values):
        return random.choice([None, *values])

    rows = [
        {
            "transaction_id": pick("", " ", *(f"T{i}" for i in range(40))),
            "timestamp": pick(*(frames.DAY + timedelta(i) for i in range(3))),
            "amount": pick(-1.0, 0.0, 1.0, 2.0),
            "payee_id": pick("S1", "S2"),
            "device_id": pick("d1", "d2"),
            "is_fraud": pick(0, 1),
            "currency": pick("EUR", "USD"),
        }
        for _ in range(3000)
    ]

    def position(row):
        """Newest, then largest amount, then the other columns; nulls last everywhere."""
        time, amount = row["timestamp"], row["amount"]
        rest = [row[c] for c in ("payee_id", "device_id", "currency", "is_fraud")]
        return (
            (time is None, -time.timestamp() if time else 0),
            (amount is None, -amount if amount is not None else 0),
            *[(value is None, value if value is not None else 0) for value in rest],
        )

    groups = {}
    for row in rows:
        if row["transaction_id"] and row["transaction_id"].strip(" "):
            groups.setdefault(row["transaction_id"], []).append(row)
    compared = ["timestamp", "amount", "payee_id", "device_id", "currency", "is_fraud"]
    expected = {
        i: tuple(min(group, key=position)[c] for c in compared) for i, group in groups.items()
    }
    silver = clean.latest(frames.raw(spark, *rows).repartition(5)).collect()
    assert {r.transaction_id: tuple(r[c] for c in compared) for r in silver} == expected
    assert len(silver) == len(expected)
    bad = [r for r in rows if not (r["transaction_id"] or "").strip(" ") or (r["amount"] or 0) <= 0]
    assert clean.quarantine(frames.raw(spark, *rows)).count() == len(bad)


def test_the_amount_is_read_once_for_all_rules(spark):
    """The pattern that a number has to fit is asked once a row, whatever the rules ask of the amount."""
    lines = spark.createDataFrame(
        [("a", "1.5"), ("b", "12d"), ("c", "-3"), (None, "2"), ("e", "1e999"), ("f", None), ("g", " 7 ")],
        "transaction_id string, amount string",
    )
    states = clean.with_state(lines)
    bad, good = "INVALID_AMOUNT", "VALID"
    assert [r[clean.STATE] for r in states.collect()] == [good, bad, bad, "MISSING_TRANSACTION_ID", bad, bad, good]
    assert states.columns == ["transaction_id", "amount", clean.STATE]
    plan = states.selectExpr(clean.STATE)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RLIKE") == 1
