import frames
import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from txnrisk.operators import queue
from txnrisk.schemas import QUEUE_COLUMNS
from txnrisk.sources.tables import WRITERS, Table, append_new, buckets_for, materialize
from txnrisk.sources.versions import Versioned


def ids(df):
    return sorted(r.transaction_id for r in df.collect())


@pytest.mark.parametrize("kind", ["parquet", "orc", "json", "catalog"])
def test_replace_and_append(spark, tmp_path, kind):
    table = Table(name="t_replace") if kind == "catalog" else Table(str(tmp_path), format=kind)
    first = frames.raw(spark, {"transaction_id": "A"}, {"transaction_id": "B"})
    table.replace(first)
    table.replace(frames.raw(spark, {"transaction_id": "C"}))
    table.append(frames.raw(spark, {"transaction_id": "D"}))
    assert ids(table.read(spark)) == ["C", "D"]
    assert table.exists(spark)


def test_append_new_adds_each_id_once(spark, tmp_path):
    for table in (Table(str(tmp_path / "q")), Table(name="t_queue")):
        assert not table.exists(spark)
        append_new(frames.raw(spark, {"transaction_id": "A"}, {"transaction_id": "B"}), table)
        more = frames.raw(spark, {"transaction_id": "B"}, {"transaction_id": "C"})
        append_new(more, table)
        append_new(more, table)
        assert ids(table.read(spark)) == ["A", "B", "C"]


def test_append_new_takes_one_row_of_each_id(spark, tmp_path):
    table = Table(str(tmp_path / "q"))
    rows = [{"transaction_id": i, "amount": a} for i, a in (("A", 2.0), ("A", 1.0), ("B", 3.0), ("A", 1.0))]
    append_new(frames.raw(spark, *rows), table)
    assert {(r.transaction_id, r.amount) for r in table.read(spark).collect()} == {("A", 1.0), ("B", 3.0)}


@pytest.mark.parametrize("kind", ["parquet", "orc", "json"])
def test_a_schema_gives_an_empty_folder_its_columns(spark, tmp_path, kind):
    table, empty = Table(str(tmp_path / "t"), format=kind), frames.raw(spark)
    table.replace(empty, "status")
    assert table.read(spark, empty.schema).select(empty.columns).isEmpty()


def test_append_new_to_an_empty_queue(spark, tmp_path):
    table = Table(str(tmp_path / "q"))
    table.replace(frames.raw(spark))
    append_new(frames.raw(spark, {"transaction_id": "A"}), table)
    assert ids(table.read(spark)) == ["A"]


def test_view_or_table(spark, tmp_path):
    rows = frames.raw(spark, {"transaction_id": "A"})
    materialize(rows, "as_view")
    stored = materialize(rows, "as_table", Table(str(tmp_path / "t")))
    assert ids(spark.table("as_view")) == ids(spark.table("as_table")) == ids(stored) == ["A"]
    assert "parquet" in frames.plan_of(spark.table("as_table")).lower()


def test_alerts_follow_the_threshold(spark):
    gold = frames.raw(spark, *[{"transaction_id": i} for i in "ABC"])
    score = {"A": 0.5, "B": 0.49999, "C": 0.9}
    scored = spark.createDataFrame(
        [(k, v, float(v >= 0.5)) for k, v in score.items()],
        "transaction_id string, fraud_probability double, prediction double",
    )
    alerts = queue.alerts(gold.join(scored, "transaction_id"))
    assert {(r.transaction_id, r.is_fraud, r.prediction) for r in alerts.collect()} == {
        ("A", 1, 1.0),
        ("C", 1, 1.0),
    }
    assert alerts.columns == [c for c in QUEUE_COLUMNS if c in [*gold.columns, "prediction"]]
    assert alerts.schema["merchant_mcc"].dataType.simpleString() == "bigint"


def test_appended_alerts_come_in_few_files(spark, tmp_path):
    rows = frames.raw(spark, *[{"transaction_id": f"T{i}"} for i in range(200)]).repartition(40)
    append_new(rows, Table(str(tmp_path / "q")))
    assert len(list((tmp_path / "q").glob("*.parquet"))) == 1


def test_rows_are_not_sorted_by_directory(spark, tmp_path, monkeypatch):
    """Not in a table, not in one with versions; the session's setting stays as it was."""
    name, seen, save = "spark.sql.maxConcurrentOutputFileWriters", [], DataFrameWriter.save

    def watched(writer, *args, **options):
        seen.append(spark.conf.get(name))
        return save(writer, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "save", watched)
    before = spark.conf.get(name)
    # More directories than writers: no row is lost.
    rows = spark.range(100).selectExpr("id", "id % 12 AS part")
    for table in (Table(str(tmp_path / "plain")), Versioned(str(tmp_path / "versioned"))):
        table.replace(rows, "part")
        found = table.read(spark).select("id", F.col("part").cast("long"))
        assert sorted(found.collect()) == sorted(rows.collect())
    assert seen == [str(WRITERS)] * 2 and spark.conf.get(name) == before


def test_buckets_grow_with_the_rows():
    assert [buckets_for(n) for n in (0, 600_000, 8_000_001, 36_000_000)] == [8, 8, 9, 36]
