import pytest
from pyspark.errors import AnalysisException

from txnrisk.operators import clean
from txnrisk.schemas import PAYEE_COLUMNS, PAYER_COLUMNS
from txnrisk.sources import files
from txnrisk.sources.tables import Table

LINES = """{"transaction_id":"A","timestamp":"2026-01-01 10:00:00","amount":12.5,"is_fraud":1}

{"transaction_id":"B","amount":"12","merchant_mcc":"5411.0","is_fraud":true}
{"transaction_id":"C","amount":NaN,"extra":{"x":[1,2]}}
{"transaction_id":"D","amount":
42
not json
   {"transaction_id":"\\t","amount":1}
{"amount":3}
{"transaction_id":"E","amount":"much","timestamp":"?"}
{"transaction_id":17,"amount":2,"currency":null}
"""


@pytest.fixture
def stored(spark, tmp_path):
    (tmp_path / "logs.json").write_text(LINES)
    table = Table(str(tmp_path / "raw"))
    table.replace(files.read_lines(spark, str(tmp_path / "logs.json")), clean.STATE)
    return table.read(spark)


def test_values_are_stored_as_they_arrived(stored):
    rows = {r.transaction_id: r for r in files.readable(stored).collect()}
    assert (rows["B"].amount, rows["B"].merchant_mcc, rows["B"].is_fraud) == ("12", "5411.0", "true")
    assert (rows["E"].amount, rows["E"].timestamp) == ("much", "?")
    lost = {r["column"]: r.lost for r in clean.parse_losses(files.readable(stored)).collect()}
    assert lost == {"timestamp": 1, "amount": 2, "merchant_mcc": 0, "is_fraud": 0}


def test_lines(stored):
    got = {
        r.transaction_id: (r.amount, r.merchant_mcc, r.is_fraud, r.record_state)
        for r in clean.typed(files.readable(stored)).collect()
    }
    assert got == {
        "A": (12.5, None, 1, "VALID"),
        "B": (12.0, 5411, 1, "VALID"),
        "C": (None, None, None, "INVALID_AMOUNT"),
        "\t": (1.0, None, None, "VALID"),
        None: (3.0, None, None, "MISSING_TRANSACTION_ID"),
        "E": (None, None, None, "INVALID_AMOUNT"),
        "17": (2.0, None, None, "VALID"),
    }


def test_corrupt_lines_are_kept_apart_with_their_text(stored):
    texts = {r.corrupt_line.strip() for r in files.corrupt(stored).collect()}
    assert texts == {'{"transaction_id":"D","amount":', "42", "not json"}


def test_missing_logs_are_an_error(spark, tmp_path):
    with pytest.raises(AnalysisException):
        files.read_lines(spark, str(tmp_path / "none.json"))


PAYERS = '''payor_country,payor_id,payor_name,payor_risk_score,more
NA,C1,"Smith, ""Jo""",0.5,x
,C2,,not a number,x
DE,C2,N,,x
'''


def test_csv(spark, tmp_path):
    path = tmp_path / "payers.csv"
    path.write_text(PAYERS)
    table = files.read_lookup(spark, str(path), PAYER_COLUMNS)
    assert table.columns == PAYER_COLUMNS
    assert [tuple(r) for r in table.orderBy("payor_id", "payor_country").collect()] == [
        ("C1", 'Smith, "Jo"', "NA", 0.5),
        ("C2", None, None, None),
        ("C2", "N", "DE", None),
    ]
    tokens = files.read_lookup(spark, str(path), PAYER_COLUMNS, ("NA", "N"))
    assert {(r.payor_name, r.payor_country) for r in tokens.collect()} == {
        ('Smith, "Jo"', None),
        (None, None),
        (None, "DE"),
    }


def test_csv_with_a_header_only_or_without_a_column(spark, tmp_path):
    path = tmp_path / "payees.csv"
    path.write_text(",".join(PAYEE_COLUMNS) + "\n")
    assert files.read_lookup(spark, str(path), PAYEE_COLUMNS).isEmpty()
    with pytest.raises(AnalysisException):
        files.read_lookup(spark, str(path), PAYER_COLUMNS)


def test_missing_csv_is_an_empty_table_with_columns(spark, tmp_path):
    for path in (None, str(tmp_path / "none.csv")):
        table = files.read_lookup(spark, path, PAYEE_COLUMNS)
        assert table.columns == PAYEE_COLUMNS and table.isEmpty()
        assert table.schema["payee_risk_score"].dataType.simpleString() == "double"


def test_a_folder_exists_without_being_listed(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    assert files.path_exists(spark, str(tmp_path / "empty"))
    assert not files.path_exists(spark, str(tmp_path / "none"))
    assert files.path_exists(spark, str(tmp_path / "em*"))


def test_first_existing(spark, tmp_path):
    (tmp_path / "b").write_text("x")
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    assert files.first_existing(spark, a, b) == b
    with pytest.raises(FileNotFoundError):
        files.first_existing(spark, a)
