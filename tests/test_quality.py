import frames
import pytest

from txnrisk.operators import quality, report


def test_key_tests_count_values_and_rows(spark):
    df = frames.raw(
        spark,
        *[{"transaction_id": i, "amount": None} for i in ("A", "A", "A", "B", "B", "C", None, None)],
    )
    got = {
        r.test: (r.failures, r.passed)
        for r in quality.key_tests(df, "t", "transaction_id", ["transaction_id", "amount"]).collect()
    }
    assert got == {
        "unique_t_transaction_id": (2, False),
        "not_null_t_transaction_id": (2, False),
        "not_null_t_amount": (8, False),
    }
    assert quality.surplus_rows(df, "transaction_id").first()[0] == 5
    assert quality.null_rows(df, "transaction_id").first()[0] == 2


def test_empty_tables_pass(spark):
    empty = frames.raw(spark)
    results = quality.quality_report(empty, empty).collect()
    assert len(results) == 5 and all(r.passed and r.failures == 0 for r in results)


def test_failures_raise_unless_accepted(spark):
    df = frames.raw(spark, {"transaction_id": "A"}, {"transaction_id": "A"})
    results = quality.key_tests(df, "t", "transaction_id")
    with pytest.raises(quality.QualityError, match="unique_t_transaction_id: 1"):
        quality.require_passed(results)
    quality.require_passed(results, ("unique_t_transaction_id",))


def test_one_key_shuffle_per_table(spark):
    df = frames.raw(spark, {"transaction_id": "A"})
    plan = frames.plan_of(quality.key_tests(df, "t", "transaction_id", ["transaction_id", "amount"]))
    assert plan.count("Exchange hashpartitioning") == 1


def test_summary_counts_a_null_method_as_one_value(spark):
    df = frames.raw(
        spark,
        {"payment_method": None, "is_fraud": 0},
        {"payment_method": None, "is_fraud": 1},
        {"payment_method": "card"},
    )
    assert tuple(report.ingestion_summary(df).first()) == (3, 2, 2, 1)
    assert tuple(report.ingestion_summary(df.limit(0)).first()) == (0, 0, 0, 0)


def test_absent_class_counts_zero(spark):
    df = frames.raw(spark, {"is_fraud": 0}, {"is_fraud": None})
    assert {tuple(r) for r in report.class_distribution(df).collect()} == {(0, 1), (1, 0)}


def test_filters_without_choice_keep_everything(spark):
    df = frames.raw(spark, {"amount": -5.0}, {"amount": None})
    assert report.filter_queue(df).count() == 2
    assert report.filter_queue(df, [], 0.0).count() == 2
    assert report.filter_queue(df, None, 1.0).count() == 0


def test_waiting_rows_win_over_first_rows(spark):
    df = frames.raw(
        spark,
        *[{"transaction_id": f"T{i}", "is_fraud": 0} for i in range(5)],
        {"transaction_id": "X"},
    )
    assert [r.transaction_id for r in report.unlabeled_or_first(df, 2).collect()] == ["X"]
    labeled = report.labeled(df)
    got = [r.transaction_id for r in report.unlabeled_or_first(labeled, 2).collect()]
    assert got == ["T0", "T1"]


def test_display(spark):
    df = spark.createDataFrame(
        [(1234.5, 0.1234, 12.5), (-5.0, 0.85975, None), (None, 0.0, 0.005)],
        "amount double, payor_risk_score double, payee_risk_score double",
    )
    assert [tuple(r) for r in report.formatted_queue(df).collect()] == [
        ("$1,234.50", "12.34%", "1250.00%"),
        ("$-5.00", f"{0.85975:.2%}", None),
        (None, "0.00%", "0.50%"),
    ]


def test_every_label_is_counted_and_odd_ones_fail_their_test(spark):
    df = frames.raw(spark, *[{"is_fraud": x} for x in (1, 1, 7, None)])
    assert {tuple(r) for r in report.class_distribution(df).collect()} == {(0, 0), (1, 2), (7, 1)}
    assert tuple(quality.label_test(df, "t").first()) == ("accepted_values_t_is_fraud", 1, False)
    assert quality.label_test(df.filter("is_fraud = 1"), "t").first().passed


def test_first_rows_are_reached_by_id_alone(spark):
    """Only rows up to the last id that is needed are compared whole, with ties and null ids."""
    rows = [("C", 1), ("A", 2), ("A", 1), (None, 3), ("B", 5), ("B", 4)]
    df = spark.createDataFrame(rows, "transaction_id string, is_fraud long")
    for n in (1, 3, 4, 6, 9):
        got = [tuple(r) for r in report.unlabeled_or_first(df, n).collect()]
        assert got == sorted(rows, key=lambda r: (r[0] is None, r))[:n]
    plan = report.unlabeled_or_first(df, 3)._jdf.queryExecution().optimizedPlan().toString()
    assert "<= B" in plan
