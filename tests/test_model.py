import frames
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnrisk.functions import scoring
from txnrisk.operators import confusion, curves, model, queue, report, split
from txnrisk.plans.catalog import Views
from txnrisk.schemas import LABEL
from txnrisk.sources import models

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def gold(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("gold") / "t")
    Views(spark, FOLDER).gold.write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def fitted(gold):
    train, _ = split.split_frames(report.labeled(gold))
    return model.fit(train)


def test_probability_of_a_vector(spark):
    schema = T.StructType([T.StructField("probability", VectorUDT())])
    rows = [(Vectors.dense([0.3, 0.7]),), (Vectors.sparse(2, [0], [1.0]),), (Vectors.dense([1.0]),), (None,)]
    df = spark.createDataFrame(rows, schema)
    got = [r[0] for r in df.select(scoring.fraud_probability()).collect()]
    assert got == [0.7, 0.0, 0.0, 0.0]


def test_exactly_the_threshold_is_fraud(spark):
    df = spark.createDataFrame([(0.5,), (0.4999999,)], "fraud_probability double")
    assert [r[0] for r in df.select(scoring.predicted()).collect()] == [1.0, 0.0]


def test_forest_settings(fitted):
    forest = fitted.stages[-1]
    assert forest.getNumTrees == 50 and forest.getMaxDepth() == 8
    assert [type(s).__name__ for s in fitted.stages] == [
        "StringIndexerModel",
        "OneHotEncoderModel",
        "SQLTransformer",
        "VectorAssembler",
        "StandardScalerModel",
        "RandomForestClassificationModel",
    ]


def test_metrics_are_those_of_a_useful_model(fitted, gold):
    _, test = split.split_frames(report.labeled(gold))
    scored = model.score(fitted, test).persist()
    counts = curves.score_counts(scored, "fraud_probability")
    metrics = model.evaluate(curves.running_totals(counts)).first()
    outcomes = confusion.outcome_counts(scored, "prediction")
    assert metrics.accuracy == confusion.accuracy(outcomes).first().accuracy
    assert metrics.alerts == outcomes.selectExpr("tp + fp").first()[0]
    # The labels are a rule with five percent noise, so a useful forest is far above chance.
    assert 0.8 < metrics.roc_auc <= 1 and 0.6 < metrics.average_precision <= 1
    assert 0.8 < metrics.accuracy <= 1
    assert metrics.test_rows == test.count()
    assert 0 < metrics.alerts < metrics.test_rows


def test_scores_unseen_and_missing_values(fitted, gold):
    odd = gold.limit(5).withColumns(
        {
            "payment_method": F.lit("never seen"),
            "payee_country": F.lit(None).cast("string"),
            "amount": F.lit(None).cast("double"),
            "merchant_mcc": F.lit(None).cast("bigint"),
        }
    )
    rows = model.score(fitted, odd).collect()
    assert len(rows) == 5
    assert all(0 <= r.fraud_probability <= 1 for r in rows)
    assert rows[0].asDict().keys() == {*gold.columns, "fraud_probability", "prediction"}


def test_unknown_category_is_all_zeros(spark):
    frame = spark.createDataFrame(
        [("a", "x", "p", "q", "r", 1.0, 1.0, 1.0, 1), ("b", "y", "p2", "q2", "r2", 2.0, 3.0, 4.0, 5)],
        "payment_method string, currency string, payor_country string, payee_country string,"
        " payee_category string, amount double, payor_risk_score double, payee_risk_score double,"
        " merchant_mcc bigint",
    )
    from pyspark.ml import Pipeline

    stages = Pipeline(stages=model.feature_stages()).fit(frame)
    odd = frame.limit(1).withColumn("payment_method", F.lit("new"))
    row = stages.transform(odd).first()
    assert list(row.payment_method_hot) == [0.0, 0.0]
    assert list(row.currency_hot) == [1.0, 0.0]


def test_same_data_same_model_scores(gold, fitted):
    train, test = split.split_frames(report.labeled(gold))
    again = model.fit(train, cache=False)
    pair = [
        {r.transaction_id: r.fraud_probability for r in model.score(m, test).collect()}
        for m in (fitted, again)
    ]
    assert pair[0].keys() == pair[1].keys()
    close = sum(abs(pair[0][k] - pair[1][k]) < 0.1 for k in pair[0])
    assert close > 0.99 * len(pair[0])


def test_save_and_load(spark, fitted, gold, tmp_path):
    first, second = str(tmp_path / "first"), str(tmp_path / "second")
    assert not models.model_exists(spark, first, second)
    with pytest.raises(FileNotFoundError):
        models.load_model(spark, first, second)
    assert models.save_model(fitted, second) == second
    assert models.model_exists(spark, first, second)
    loaded = models.load_model(spark, first, second)
    assert isinstance(loaded, PipelineModel)
    some = gold.limit(20)
    assert model.score(loaded, some).collect() == model.score(fitted, some).collect()


def test_save_falls_back_only_when_told(spark, fitted, tmp_path):
    (tmp_path / "file").write_text("in the way")
    blocked, second = str(tmp_path / "file" / "model"), str(tmp_path / "second")
    with pytest.raises(Exception):
        models.save_model(fitted, blocked)
    assert models.save_model(fitted, blocked, second) == second


def test_no_python_runs_per_row(fitted, gold):
    plan = model.score(fitted, gold)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_the_forest_runs_once_per_row(fitted, gold):
    plan = frames.plan_of(queue.alerts(model.score(fitted, gold)))
    above, below = plan.split("Generate explode", 1)
    assert "Filter" in above and "UDF" not in above
    # Votes, normalized votes and probabilities, nested in one place.
    assert below.count("AS probability") == 1


def test_training_rows_lie_in_partitions_of_bounded_size(spark):
    """A crowded partition is dealt out evenly, equal rows too; small ones stay as they are."""
    rows = spark.range(0, 1000, 1, 1).select((F.col("id") % 2).alias("amount"), F.lit(1).alias(LABEL))
    dealt = model.in_parts(rows, most_rows=150)
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 7 and max(sizes) <= 150
    assert sorted(dealt.collect()) == sorted(rows.collect())
    assert dealt.collect() == model.in_parts(rows, most_rows=150).collect()
    assert model.in_parts(rows, most_rows=1000) is rows
    assert model.in_parts(rows.limit(0)).count() == 0


def test_the_forest_is_fitted_on_bounded_partitions(spark, gold, monkeypatch):
    monkeypatch.setattr(model, "PART_ROWS", 500)
    taken = []
    monkeypatch.setattr(model, "_fitted", lambda inputs, *_: taken.append(inputs.rdd.glom().map(len).collect()))
    model.fit(report.labeled(gold).coalesce(1))
    assert sum(taken[0]) > 2000 and max(taken[0]) <= 600
