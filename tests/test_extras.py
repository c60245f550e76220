import json

import pytest

from txnrisk.operators import clean, extras
from txnrisk.plans import stages
from txnrisk.schemas import RAW_COLUMNS
from txnrisk.sources import files
from txnrisk.sources.tables import Table

LINES = [
    '{"transaction_id":"A","amount":12.50,"geo":{"lat":1.50,"k":null,"in":{"x":[{"deep":1}]}},"tags":[1,"x"]}',
    "",
    "not json",
    "42",
    '{"transaction_id":"B","amount":NaN,"late":NaN}',
    '{"transaction_id":"C","amount":1,"note":null}',
    '{"transaction_id":"D","amount":1,"note":"n","note":"m"}',
    '{"transaction_id":"E","amount":1}',
    '{"transaction_id":"F","amount":1,"Amount":2,"NOTE":3,"extra_fields":4,"a.b":5,"":6,"é`":7}',
    '{"amount":3,"note":{"k":1}}',
    '{"transaction_id":',
]


@pytest.fixture
def path(tmp_path):
    (tmp_path / "logs.json").write_text("\n".join(LINES))
    return str(tmp_path / "logs.json")


@pytest.fixture
def names(spark, path):
    return files.further_fields(spark, path)


def test_names(spark, path, names, caplog):
    # Other spellings of a known name are left out; a line with NaN is no strict JSON and names nothing.
    assert names == ["", "NOTE", "a.b", "geo", "tags", "é`"]
    with pytest.raises(ValueError, match="more than 3 different fields"):
        files.further_fields(spark, path, most=3)


def kept(spark, path, names):
    rows = files.read_lines(spark, path, names).selectExpr("transaction_id", "record_state", "to_json(extra_fields) AS extra")
    return {r.transaction_id: (r.record_state, r.extra and json.loads(r.extra)) for r in rows.collect() if r.transaction_id}


def test_fields_are_kept_with_their_types(spark, path):
    found = kept(spark, path, ["geo", "tags", "note", "late", "a.b", "", "é`"])
    assert found == {
        "A": ("VALID", {"geo": {"lat": 1.5, "k": None, "in": {"x": [{"deep": 1}]}}, "tags": [1, "x"]}),
        "B": ("INVALID_AMOUNT", {"late": "NaN"}),
        "C": ("VALID", {"note": None}),
        "D": ("VALID", {"note": "m"}),
        "E": ("VALID", None),
        "F": ("VALID", {"a.b": 5, "": 6, "é`": 7}),
    }


def test_the_twelve_columns_are_as_without_further_fields(spark, path, names, tmp_path):
    def stored(further, name):
        table = Table(str(tmp_path / name))
        table.replace(files.read_lines(spark, path, further))
        return sorted(map(str, table.read(spark).select(*RAW_COLUMNS, files.CORRUPT_TEXT, clean.STATE).collect()))

    assert stored(None, "plain") == stored(names, "further") == stored([], "none")


def test_census(spark, path):
    names = ["geo", "tags", "note"]
    rows = files.read_lines(spark, path, names).filter(f"{files.EXTRA} IS NOT NULL")
    found = {(r.field, r.type): r.rows for r in extras.census(rows, files.EXTRA, "transaction_id").collect()}
    assert found == {
        ("geo", "OBJECT"): 1,
        ("geo.lat", "DECIMAL"): 1,
        ("geo.k", "VOID"): 1,
        ("geo.in", "OBJECT"): 1,
        ("geo.in.x", "ARRAY"): 1,
        ("tags", "ARRAY"): 1,
        ("note", "VOID"): 1,
        ("note", "STRING"): 1,
        ("note", "OBJECT"): 1,
        ("note.k", "BIGINT"): 1,
    }
    top = {r.field for r in extras.census(rows, files.EXTRA, "transaction_id", levels=1).collect()}
    assert top == {"geo", "tags", "note"}


@pytest.mark.parametrize("kind", ["parquet", "orc", "json"])
def test_the_raw_layer_keeps_them_in_any_format(spark, path, tmp_path, kind):
    layers = stages.Layers.under(str(tmp_path / "layers"), raw=Table(str(tmp_path / "raw"), format=kind))
    stages.ingest(spark, layers, stages.Settings(path))
    rows = stages.read_further(spark, layers)
    text = "to_json(extra_fields)" if kind == "parquet" else "extra_fields"
    found = {r.transaction_id: json.loads(r.x) for r in rows.selectExpr("transaction_id", f"{text} AS x").collect()}
    assert found["A"]["geo"]["in"] == {"x": [{"deep": 1}]} and found["A"]["tags"] == [1, "x"]
    # Of "note" and "NOTE" the one first in code point order is kept.
    assert set(found) == {"A", "F"} and found["F"] == {"NOTE": 3, "a.b": 5, "": 6, "é`": 7}
    assert stages.read_raw(spark, layers).columns == [*RAW_COLUMNS, clean.STATE]
    assert stages.read_corrupt(spark, layers).count() == 3


def test_an_older_raw_layer_has_none(spark, path, tmp_path):
    layers = stages.Layers.under(str(tmp_path / "layers"))
    layers.raw.replace(files.read_lines(spark, path), clean.STATE)
    assert stages.read_further(spark, layers).isEmpty()


def test_no_further_fields(spark, tmp_path):
    (tmp_path / "logs.json").write_text('{"transaction_id":"A","amount":1}\n')
    layers = stages.Layers.under(str(tmp_path / "layers"))
    stages.ingest(spark, layers, stages.Settings(str(tmp_path / "logs.json")))
    assert stages.read_further(spark, layers).isEmpty()
    assert stages.read_raw(spark, layers).count() == 1
