import json
from dataclasses import replace

import pytest

from txnrisk.operators import report
from txnrisk.plans import runs, stages
from txnrisk.plans.catalog import Views
from txnrisk.sources.tables import Table
from txnrisk.sources.versions import Versioned

FOLDER = "/root/testdata/sf0.001"
ACCEPTED = ("not_null_enriched_transactions_amount",)


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("inputs")
    v = Views(spark, FOLDER)
    v.raw.write.json(str(root / "logs"))
    v.payers.write.option("header", True).csv(str(root / "payers"))
    v.payees.write.option("header", True).csv(str(root / "payees"))
    return stages.Settings(
        str(root / "logs"), str(root / "payers"), str(root / "payees"), accepted_failures=ACCEPTED
    )


def stale(spark, *where):
    return [p.stage for p in runs.plan(spark, *where) if p.stale]


def records(spark, log):
    rows = log.read(spark, runs.LOG_SCHEMA).orderBy("ended").collect()
    return [(r.stage, r.state) for r in rows]


def test_a_run_goes_on_where_it_died(spark, inputs, tmp_path, monkeypatch):
    layers = stages.Layers.under(str(tmp_path / "layers"))
    log = Versioned(str(tmp_path / "runs"))
    where = (layers, inputs, log)
    assert stale(spark, *where) == list(stages.STAGES)

    def dies(*_):
        raise RuntimeError("lost")

    train = runs.STEPS["training"]
    monkeypatch.setitem(runs.STEPS, "training", replace(train, run=dies))
    with pytest.raises(RuntimeError, match="lost"):
        runs.run_stale(spark, *where)
    assert records(spark, log) == [("ingestion", "done"), ("transform", "done"), ("training", "failed")]
    assert stale(spark, *where) == ["training", "inference"]
    monkeypatch.setitem(runs.STEPS, "training", train)
    before = [layers.raw.numbers(spark), layers.gold.numbers(spark)]
    assert list(runs.run_stale(spark, *where)) == ["training", "inference"]
    assert [layers.raw.numbers(spark), layers.gold.numbers(spark)] == before
    assert stale(spark, *where) == [] and runs.run_stale(spark, *where) == {}
    # Other settings make only the stages stale that they concern.
    other = replace(inputs, threshold=0.7)
    assert stale(spark, layers, other, log) == ["training", "inference"]
    assert stale(spark, layers, replace(inputs, csv_null_tokens=("NA",)), log) == list(stages.STAGES)
    # Another writer's rows in the queue do not.
    layers.queue.append(layers.queue.read(spark).limit(1))
    assert stale(spark, *where) == []
    # A layer that is not as its stage left it is made again, with all that follows.
    layers.gold.replace(report.labeled(layers.gold.read(spark)))
    reasons = {p.stage: p.reason for p in runs.plan(spark, *where)}
    assert reasons["ingestion"] == "" and reasons["transform"] == "not as left: gold"
    assert reasons["training"] == "made anew: gold" and reasons["inference"] == "made anew: gold, model"


def test_a_changed_input_is_seen(spark, inputs, tmp_path):
    (tmp_path / "log.json").write_text('{"transaction_id":"A","amount":1}\n')
    layers, log = stages.Layers.under(str(tmp_path / "layers")), Versioned(str(tmp_path / "runs"))
    settings = stages.Settings((str(tmp_path / "none"), str(tmp_path / "log.json")))
    where = (layers, settings, log)
    runs.run_stale(spark, *where, until="transform")
    assert stale(spark, *where) == ["training", "inference"]
    (tmp_path / "log.json").write_text('{"transaction_id":"A","amount":1}\n{"transaction_id":"B","amount":2}\n')
    assert [p.reason for p in runs.plan(spark, *where)][:2] == [
        "changed: logs", "made anew: raw, dim_payers, dim_payees",
    ]
    runs.run_stale(spark, *where, until="ingestion")
    assert stages.read_raw(spark, layers).count() == 2
    # Now the first of the two places is there.
    (tmp_path / "none").write_text('{"transaction_id":"C","amount":1}\n')
    assert runs.plan(spark, *where)[0].reason == "changed: logs"


def test_layers_without_fingerprints_are_always_stale(spark, tmp_path):
    (tmp_path / "log.json").write_text('{"transaction_id":"A","amount":1}\n')
    named = Table(name="runs_invalid", options={"path": str(tmp_path / "invalid")})
    layers = stages.Layers.under(str(tmp_path / "layers"), invalid=named, silver=None, raw=Table(str(tmp_path / "raw")))
    settings, log = stages.Settings(str(tmp_path / "log.json")), Versioned(str(tmp_path / "runs"))
    runs.run_stale(spark, layers, settings, log, until="transform")
    reasons = [p.reason for p in runs.plan(spark, layers, settings, log)]
    assert reasons[:2] == ["", "not as left: invalid"]


def test_order():
    def step(needs, *makes):
        return runs.Step(None, tuple(needs), makes)

    steps = {"c": step("y", "z"), "a": step("i", "x"), "b": step("x", "y"), "d": step("i", "w")}
    assert runs.order(steps, {"i"}) == ["a", "b", "c", "d"]
    with pytest.raises(ValueError, match="these need each other: c, a, b"):
        runs.order({**steps, "a": step("z", "x")}, {"i"})
    with pytest.raises(ValueError, match="nothing makes what c needs: q"):
        runs.order({**steps, "c": step("q", "z")}, {"i"})
    with pytest.raises(ValueError, match="both b and d make y"):
        runs.order({**steps, "d": step("i", "y")}, {"i"})


def test_records_hold_what_was_read_and_made(spark, tmp_path):
    (tmp_path / "log.json").write_text('{"transaction_id":"A","amount":1}\n')
    layers, log = stages.Layers.under(str(tmp_path / "layers")), Versioned(str(tmp_path / "runs"))
    runs.run_stale(spark, layers, stages.Settings(str(tmp_path / "log.json")), log, until="ingestion")
    row = log.read(spark, runs.LOG_SCHEMA).first()
    assert set(json.loads(row.needs)) == {"logs", "payers", "payees"} and row.message == "never done"
    assert set(json.loads(row.makes)) == {"raw", "dim_payers", "dim_payees"} and None not in json.loads(row.makes).values()
