from dataclasses import replace

import frames
import pytest
from pyspark.sql import functions as F

from txnrisk import __main__
from txnrisk.operators import clean, model, quality
from txnrisk.plans import stages, workdir
from txnrisk.plans.catalog import Views
from txnrisk.plans.workdir import new_folder
from txnrisk.schemas import GOLD_COLUMNS, QUEUE_COLUMNS, typed_schema
from txnrisk.sources.tables import Table
from txnrisk.sources.versions import Versioned

FOLDER = "/root/testdata/sf0.001"
ACCEPTED = ("not_null_enriched_transactions_amount",)


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("inputs")
    v = Views(spark, FOLDER)
    v.raw.write.json(str(root / "logs"))
    (root / "logs" / "part-x.json").write_text('{"transaction_id":"X"\n\nbroken\n')
    v.payers.write.option("header", True).csv(str(root / "payers"))
    v.payees.write.option("header", True).csv(str(root / "payees"))
    return {name: str(root / name) for name in ("logs", "payers", "payees")}


@pytest.fixture(scope="module")
def done(spark, inputs, tmp_path_factory):
    layers = stages.Layers.under(str(tmp_path_factory.mktemp("layers")))
    settings = stages.Settings(**inputs, accepted_failures=ACCEPTED)
    return layers, settings, stages.run(spark, layers, settings)


def test_layers_hold_the_expected_rows(spark, done):
    layers, _, results = done
    assert stages.read_raw(spark, layers).count() == 6000
    assert stages.read_corrupt(spark, layers).count() == 2
    assert layers.silver.read(spark).count() == 4586
    assert dict(stages.read_raw(spark, layers).dtypes)["amount"] == "string"
    assert layers.invalid.read(spark).count() == 69
    gold = stages.read_gold(spark, layers)
    assert gold.columns == GOLD_COLUMNS and gold.count() == 4586
    assert stages.labeled_gold(spark, layers).count() == 3022
    assert stages.unlabeled_gold(spark, layers).count() == 1564
    summary = results["ingestion"].first()
    assert (summary.total, summary.payment_methods) == (6000, 5)
    assert summary.labeled + summary.unlabeled == 6000


def test_stored_layers_equal_the_views(spark, done):
    layers, *_ = done
    v = Views(spark, FOLDER)
    ntz = F.col("timestamp").cast("timestamp_ntz")
    gold = stages.read_gold(spark, layers).withColumn("timestamp", ntz)
    assert gold.exceptAll(v.gold).isEmpty() and v.gold.exceptAll(gold).isEmpty()


def test_quarantine_time_is_the_same_for_all_rows(spark, done):
    invalid = done[0].invalid.read(spark)
    assert invalid.select("quarantined_at").distinct().count() == 1


def test_every_bad_id_is_quarantined_and_none_is_silver(spark, done):
    layers, *_ = done
    raw, invalid = stages.read_raw(spark, layers), layers.invalid.read(spark)
    blank = F.col("transaction_id").isNull() | (F.trim("transaction_id") == "")
    assert raw.filter(blank).count() == invalid.filter(blank).count() > 0
    assert layers.silver.read(spark).filter(blank).isEmpty()
    assert invalid.filter("quarantine_reason = 'OTHER_ANOMALY'").isEmpty()


def test_quality_and_metrics_are_stored(spark, done):
    layers, _, results = done
    tests = {r.test: r.failures for r in results["transform"].collect()}
    assert len(tests) == 12
    assert {name for name, failures in tests.items() if failures} == set(ACCEPTED)
    metrics = results["training"].first()
    assert metrics.roc_auc > 0.8 and metrics.test_rows == pytest.approx(0.2 * 3022, abs=3)
    assert layers.roc_curve.read(spark).count() == 100
    classes = {r["class"]: r for r in layers.class_report.read(spark).collect()}
    assert classes["accuracy"].f1_score == metrics.accuracy
    assert classes["Fraud"].support + classes["Legitimate"].support == metrics.test_rows


def test_queue_holds_scored_rows_once(spark, done):
    layers, settings, results = done
    queue = layers.queue.read(spark)
    before = sorted(tuple(r) for r in queue.collect())
    assert queue.columns == QUEUE_COLUMNS and before
    assert queue.filter("is_fraud <> 1 OR prediction <> 1.0").isEmpty()
    waiting = stages.unlabeled_gold(spark, layers).select("transaction_id")
    assert queue.join(waiting, "transaction_id", "left_anti").isEmpty()
    assert results["inference"].count() == 5
    stages.infer(spark, layers, settings)
    assert sorted(tuple(r) for r in layers.queue.read(spark).collect()) == before


def test_replacing_the_queue(spark, done, tmp_path):
    layers, settings, _ = done
    other = replace(layers, queue=Table(str(tmp_path / "q")))
    replaced = replace(settings, replace_queue=True, threshold=0.8)
    stages.infer(spark, other, settings)
    many = other.queue.read(spark).count()
    stages.infer(spark, other, replaced)
    few = other.queue.read(spark).count()
    assert 0 < few < many


def test_only_needed_directories_are_read(spark, done):
    layers, *_ = done
    half = frames.plan_of(stages.labeled_gold(spark, layers))
    assert "PartitionFilters: [isnotnull(label_state" in half
    plan = frames.plan_of(clean.quarantine(stages.read_raw(spark, layers)))
    assert "PartitionFilters: [isnotnull(record_state" in plan


def test_failed_quality_stops_the_run_after_the_tables_are_written(spark, inputs, tmp_path):
    layers = stages.Layers.under(str(tmp_path))
    settings = stages.Settings(**inputs)
    with pytest.raises(quality.QualityError, match="not_null_enriched_transactions_amount: 10"):
        stages.run(spark, layers, settings)
    assert layers.gold.exists(spark) and not layers.queue.exists(spark)


def test_unknown_stage(spark, done):
    with pytest.raises(ValueError, match="nonsense"):
        stages.run(spark, done[0], done[1], ("nonsense",))


def test_inference_trains_when_there_is_no_model(spark, done, tmp_path):
    layers, settings, _ = done
    other = replace(
        layers,
        model=str(tmp_path / "m"),
        queue=Table(str(tmp_path / "q")),
        metrics=Table(str(tmp_path / "metrics")),
        roc_curve=Table(str(tmp_path / "roc")),
        class_report=Table(str(tmp_path / "classes")),
    )
    stages.run(spark, other, settings, ("inference",))
    assert other.queue.read(spark).count() == layers.queue.read(spark).count()


def test_no_waiting_rows(spark, done, tmp_path):
    layers, settings, _ = done
    labeled = Table(str(tmp_path / "gold"))
    labeled.replace(layers.gold.read(spark).filter("is_fraud IS NOT NULL"), "label_state")
    other = replace(layers, gold=labeled, queue=Table(str(tmp_path / "q")))
    stages.infer(spark, other, settings)
    assert other.queue.read(spark).isEmpty()
    stages.infer(spark, other, replace(settings, score_first_when_none_wait=True))
    assert not other.queue.read(spark).isEmpty()


def test_silver_as_a_view_and_missing_lookups(spark, inputs, tmp_path):
    layers = stages.Layers.under(str(tmp_path), silver=None)
    settings = stages.Settings(inputs["logs"], accepted_failures=ACCEPTED)
    stages.run(spark, layers, settings, ("ingestion", "transform"))
    gold = stages.read_gold(spark, layers)
    assert gold.count() == 4586
    assert gold.filter("payor_country <> 'UNKNOWN' OR payee_name IS NOT NULL").isEmpty()
    assert not (tmp_path / "stg_transactions").exists()


def test_work_folder_is_the_one_the_session_names(spark):
    assert new_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert new_folder(spark, "x") != new_folder(spark, "x")


LINE = (
    '{"transaction_id":"%s","amount":%s,"is_fraud":%s,"timestamp":"2026-01-01 00:00:00",'
    '"payment_method":"card","currency":"USD","merchant_mcc":5411}\n'
)


def lines(labels, amount="5.5"):
    return "".join(LINE % (f"T{n}", amount, label) for n, label in enumerate(labels))


def small(tmp_path, text, kind):
    """Layers in a format, and the settings of a run over the text."""
    (tmp_path / "logs.json").write_text(text)
    layers = stages.Layers.under(str(tmp_path / "layers"))
    tables = {k: replace(t, format=kind) for k, t in vars(layers).items() if isinstance(t, Table)}
    return replace(layers, **tables), stages.Settings(str(tmp_path / "logs.json"))


@pytest.mark.parametrize("kind", ["parquet", "orc", "json"])
@pytest.mark.parametrize(
    "text", ["", '{"amount":5}\n{"transaction_id":" ","amount":1}\n', lines(["null"] * 3)]
)
def test_nothing_to_train_on_is_said_clearly(spark, tmp_path, kind, text):
    layers, settings = small(tmp_path, text, kind)
    stages.run(spark, layers, settings, ("ingestion", "transform"))
    kept = 3 if "T0" in text else 0
    assert stages.read_gold(spark, layers).count() == kept
    assert stages.unlabeled_gold(spark, layers).count() == kept
    assert layers.quality.read(spark).count() == 12
    with pytest.raises(ValueError, match="no rows labelled 0"):
        stages.run(spark, layers, settings, ("training",))


def test_a_category_without_values_is_named(spark, tmp_path):
    text = lines([0, 1] * 5).replace('"card"', "null")
    layers, settings = small(tmp_path, text, "parquet")
    with pytest.raises(ValueError, match="payment_method is null"):
        stages.run(spark, layers, settings, ("ingestion", "transform", "training"))


@pytest.mark.parametrize("kind", ["parquet", "orc", "json"])
def test_no_unlabelled_rows_leave_an_empty_queue(spark, tmp_path, kind):
    layers, settings = small(tmp_path, lines([0, 1] * 20), kind)
    stages.run(spark, layers, settings)
    assert layers.queue.read(spark, typed_schema(QUEUE_COLUMNS)).isEmpty()
    stages.infer(spark, layers, settings)


def test_odd_amounts_and_labels(spark, tmp_path):
    text = lines([0, 1] * 20) + "".join(
        LINE % (f"O{n}", amount, 1) for n, amount in enumerate(['"12d"', "1e999", '"0x1p4"', '"1,5"'])
    )
    layers, settings = small(tmp_path, text, "parquet")
    settings = replace(settings, accepted_failures=ACCEPTED)
    stages.run(spark, layers, settings)
    invalid = {r.transaction_id: r.amount for r in layers.invalid.read(spark).collect()}
    assert invalid == {"O0": "12d", "O1": "1e999", "O2": "0x1p4", "O3": "1,5"}
    tests = {r.test: r.failures for r in layers.quality.read(spark).collect()}
    assert tests["readable_raw_transactions_amount"] == 4


def test_labels_that_are_no_class_are_counted_and_refused(spark, tmp_path):
    layers, settings = small(tmp_path, lines([0, 1, 7] * 10), "parquet")
    results = stages.run(spark, layers, settings, ("ingestion", "transform"))
    tests = {r.test: r.failures for r in results["transform"].collect()}
    assert tests["accepted_values_stg_transactions_is_fraud"] == 10
    with pytest.raises(ValueError, match="labels are neither"):
        stages.run(spark, layers, settings, ("training",))


def test_the_first_existing_input_is_read(spark, tmp_path):
    layers, settings = small(tmp_path, lines([0, 1]), "parquet")
    several = replace(settings, logs=(str(tmp_path / "none"), settings.logs))
    assert stages.ingest(spark, layers, several).first().total == 2
    with pytest.raises(FileNotFoundError):
        stages.ingest(spark, layers, replace(settings, logs=(str(tmp_path / "none"),)))


def test_a_category_with_too_many_values_is_refused(spark):
    rows = frames.raw(spark, *[{"transaction_id": f"T{i}", "is_fraud": i % 2, "currency": f"c{i}"} for i in range(60)])
    gold = rows.selectExpr("*", "'x' payor_country", "'x' payee_country", "'x' payee_category", "0.1D payor_risk_score", "0.1D payee_risk_score")
    inputs = model.feature_frame(gold)
    model.check_inputs(inputs)
    with pytest.raises(ValueError, match="currency has about"):
        model.check_inputs(inputs, most_values=20)


def test_command_line(tmp_path):
    args = __main__.parser().parse_args(
        ["--root", "/r", "--logs", "a", "--logs", "b", "--layer", "gold=orc", "--layer", "raw=json:/x",
         "--layer", "queue=jdbc:", "--option", "queue.url=u=1", "--second-model", "/m", "--threshold", "0.7",
         "--csv-null", "NA", "--score-first", "--batch", "b1"]
    )
    layers, settings = __main__.layers_of(args), __main__.settings_of(args)
    assert layers.gold == Versioned("/r/enriched_transactions", format="orc")
    assert layers.raw == Versioned("/x", format="json")
    assert layers.queue == Table(None, format="jdbc", options={"url": "u=1"})
    assert layers.second_model == "/m" and settings.logs == ("a", "b") and settings.payers is None
    assert settings.threshold == 0.7 and settings.csv_null_tokens == ("NA",)
    assert settings.score_first_when_none_wait and settings.batch == "b1"
    with pytest.raises(SystemExit):
        __main__.layers_of(__main__.parser().parse_args(["--root", "/r", "--layer", "none=orc"]))
    with pytest.raises(SystemExit):
        __main__.settings_of(__main__.parser().parse_args(["--root", "/r"]))


def test_own_folders_are_removed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(workdir, "own_folder", lambda spark: str(tmp_path / "own"))
    path = new_folder(spark, "x")
    spark.range(1).write.parquet(path)
    workdir.remove_folders(spark)
    assert not (tmp_path / "own").exists() and tmp_path.exists()
