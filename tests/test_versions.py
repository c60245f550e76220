import random
from pathlib import Path

import frames
import pytest
from pyspark.sql import functions as F

from txnrisk.operators import queue, sieve
from txnrisk.plans import stages
from txnrisk.sources.tables import append_new
from txnrisk.sources.versions import COMMITS, Conflict, Versioned


def ids(df):
    return sorted(r.transaction_id for r in df.collect())


def raw(spark, *names, **values):
    return frames.raw(spark, *[{"transaction_id": n, **values} for n in names])


@pytest.fixture
def table(tmp_path):
    return Versioned(str(tmp_path / "t"))


def broken(df):
    """The same rows, of which one makes its task fail after others have been written."""
    fails = F.when(F.col("transaction_id") == "bad", F.raise_error(F.lit("lost"))).otherwise(F.col("status"))
    return df.repartition(4, "transaction_id").withColumn("status", fails.cast("string"))


def test_a_write_that_dies_halfway_leaves_the_old_rows(spark, table):
    table.replace(raw(spark, "A", "B"))
    with pytest.raises(Exception, match="lost"):
        table.replace(broken(raw(spark, "X", "Y", "Z", "bad")))
    assert ids(table.read(spark)) == ["A", "B"] and table.numbers(spark) == [1]
    with pytest.raises(Exception, match="lost"):
        table.append(broken(raw(spark, "X", "Y", "Z", "bad")))
    assert ids(table.read(spark)) == ["A", "B"] and table.numbers(spark) == [1]


def test_a_reader_keeps_its_version(spark, table):
    table.replace(raw(spark, "A"))
    before = table.read(spark)
    table.replace(raw(spark, "B"))
    table.append(raw(spark, "C"))
    assert ids(before) == ["A"]
    assert ids(table.read(spark)) == ["B", "C"]
    assert [ids(table.read(spark, number=n)) for n in (1, 2, 3)] == [["A"], ["B"], ["B", "C"]]
    with pytest.raises(FileNotFoundError, match="no version 9"):
        table.read(spark, number=9)
    assert {(r.version, r.transaction_id) for r in table.history(spark).collect()} == {
        (1, "A"), (2, "B"), (3, "B"), (3, "C"),
    }


def test_a_table_can_replace_itself(spark, table):
    table.replace(raw(spark, "A", "B", "C"))
    table.replace(table.read(spark).filter("transaction_id <> 'B'"))
    assert ids(table.read(spark)) == ["A", "C"]


def test_replacing_after_others(spark, table, monkeypatch):
    """Another writer commits between this one's look and its commit."""
    table.replace(raw(spark, "A"))
    switch, done = Versioned._switch, []

    def late(self, session, new):
        if not done:
            done.append(1)
            Versioned(self.path).append(raw(session, "other"))
        switch(self, session, new)

    monkeypatch.setattr(Versioned, "_switch", late)
    table.replace(raw(spark, "B"))
    assert ids(table.read(spark)) == ["B"] and table.numbers(spark) == [1, 2, 3]
    done.clear()
    table.append(raw(spark, "C"))
    assert ids(table.read(spark)) == ["B", "C", "other"]


def test_a_taken_version_is_a_conflict(spark, table):
    table.replace(raw(spark, "A"))
    with pytest.raises(Conflict):
        table._switch(spark, table.commit(spark))
    names = [p.name for p in Path(table.path, COMMITS).iterdir()]
    assert [n for n in names if not n.startswith(".")] == ["00000000000000000001.json"]


def test_two_runs_at_once_do_not_queue_an_alert_twice(spark, table, monkeypatch):
    append_new(raw(spark, "A"), table)
    switch, done = Versioned._switch, []

    def late(self, session, new):
        if not done:
            done.append(1)
            append_new(raw(session, "B", "C"), Versioned(self.path))
        switch(self, session, new)

    monkeypatch.setattr(Versioned, "_switch", late)
    append_new(raw(spark, "B", "D"), table)
    assert ids(table.read(spark)) == ["A", "B", "C", "D"]


def test_a_batch_is_appended_once(spark, table):
    append_new(raw(spark, "A"), table, "run-1")
    append_new(raw(spark, "A", "B"), table, "run-1")
    assert ids(table.read(spark)) == ["A"]
    append_new(raw(spark, "A", "B"), table, "run-2")
    table.append(raw(spark, "C"), "run-2")
    table.append(raw(spark, "C"), "run-3")
    assert ids(table.read(spark)) == ["A", "B", "C"]
    assert table.commit(spark).batches == ("run-1", "run-2", "run-3")
    # Compacting keeps the rows and the batches; replacing starts anew.
    table.compact(spark)
    assert len(table.commit(spark).folders) == 1 and table.commit(spark).batches[0] == "run-1"
    assert ids(table.read(spark)) == ["A", "B", "C"]
    table.replace(raw(spark, "Z"))
    table.append(raw(spark, "Y"), "run-1")
    assert ids(table.read(spark)) == ["Y", "Z"]


def test_vacuum_removes_what_no_kept_version_names(spark, table, tmp_path):
    for name in "ABC":
        table.replace(raw(spark, name))
    with pytest.raises(Exception, match="lost"):
        table.replace(broken(raw(spark, "X", "bad")))
    folders = {p.name for p in (tmp_path / "t").glob("data-*")}
    assert table.vacuum(spark) == []
    gone = table.vacuum(spark, keep=2, grace_seconds=0)
    left = {p.name for p in (tmp_path / "t").glob("data-*")}
    assert left == {f for n in (2, 3) for f in table.commit(spark, n).folders}
    assert set(gone) | left == folders and len(gone) >= 1
    assert table.numbers(spark) == [2, 3] and ids(table.read(spark)) == ["C"]
    with pytest.raises(ValueError, match="latest"):
        table.vacuum(spark, keep=0)


@pytest.mark.parametrize("kind", ["parquet", "orc", "json"])
def test_parts_and_empty_tables(spark, tmp_path, kind):
    table, empty = Versioned(str(tmp_path / "t"), format=kind), frames.raw(spark)
    assert not table.exists(spark)
    table.replace(empty, "status")
    assert table.exists(spark) and table.read(spark, empty.schema).select(empty.columns).isEmpty()
    rows = frames.raw(spark, {"transaction_id": "A", "status": "x"}, {"transaction_id": "B", "status": "y"})
    table.replace(rows, "status")
    found = table.read(spark, empty.schema)
    assert ids(found.filter("status = 'y'")) == ["B"]
    assert "status=y" in {p.name for p in (tmp_path / "t").glob("parts-*/*")}
    # Rows by directories and others side by side.
    table.append(frames.raw(spark, {"transaction_id": "C", "status": "z"}))
    table.append(frames.raw(spark, {"transaction_id": "D", "status": "y"}))
    found = table.read(spark, empty.schema)
    assert ids(found) == ["A", "B", "C", "D"] and ids(found.filter("status = 'y'")) == ["B", "D"]


def test_only_files_with_a_path_have_versions():
    for options in ({"path": None}, {"path": "p", "name": "n"}, {"path": "p", "format": "jdbc"}):
        with pytest.raises(ValueError, match="path"):
            Versioned(**options)


def test_layers_are_replaced_in_one_step(spark, tmp_path):
    layers = stages.Layers.under(str(tmp_path))
    (tmp_path / "log.json").write_text('{"transaction_id":"A","amount":1}\n')
    settings = stages.Settings(str(tmp_path / "log.json"))
    stages.ingest(spark, layers, settings)
    old = stages.read_raw(spark, layers)
    (tmp_path / "log.json").write_text('{"transaction_id":"B","amount":1}\n')
    stages.ingest(spark, layers, settings)
    assert ids(old) == ["A"] and ids(stages.read_raw(spark, layers)) == ["B"]


# The filter before an append.


def test_no_value_is_lost_by_the_sieve(spark):
    values = [f"T{i}" for i in range(3000)]
    put = spark.createDataFrame([(v,) for v in values] + [(None,)], "id string").repartition(3)
    words = sieve.words_for(3001)
    made = sieve.sieve(put, "id", words)
    others = spark.range(20_000).select(F.concat(F.lit("X"), "id").alias("id"))
    passed = put.unionByName(others).filter(sieve.passes(F.col("id"), made, words))
    kept = [r.id for r in passed.collect()]
    assert {v for v in kept if v[0] == "T"} == set(values) and None not in kept
    assert len(kept) - 3000 < 20_000 / 40
    assert sieve.words_for(0) == 1 and sieve.words_for(10**12) == sieve.MOST_WORDS
    # A filter that is too small lets everything pass.
    small = sieve.sieve(put, "id", 1)
    assert others.filter(sieve.passes(F.col("id"), small, 1)).count() > 19_000


def test_an_empty_sieve_lets_nothing_pass(spark):
    none = spark.createDataFrame([], "id string")
    some = spark.range(100).select(F.col("id").cast("string"))
    assert some.filter(sieve.passes(F.col("id"), sieve.sieve(none, "id", 1), 1)).isEmpty()


def test_the_queue_is_pruned_before_it_is_shuffled(spark, tmp_path):
    draw = random.Random(1)
    queued = Versioned(str(tmp_path / "q"))
    queued.replace(raw(spark, *[f"Q{i}" for i in range(2000)]).repartition(5))
    names = [f"Q{draw.randrange(2000)}" for _ in range(20)] + [f"N{i}" for i in range(20)]
    new = raw(spark, *dict.fromkeys(names))
    found = queue.not_queued(new, queued.read(spark), sieve.words_for(40))
    assert {r.transaction_id for r in found.collect()} == {n for n in names if n[0] == "N"}
    # The filter stands below the join, hence before its exchange.
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join LeftAnti") < plan.index("Filter") and "getbit" in plan
    # What the filter lets through, of 2,000 queued ids.
    made = sieve.sieve(new, "transaction_id", sieve.words_for(40))
    kept = queued.read(spark).filter(sieve.passes(F.col("transaction_id"), made, sieve.words_for(40)))
    assert kept.count() < 150
