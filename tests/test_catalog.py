"""How queries build and store what they read."""

import glob
import gzip

import compare
import pytest

from txnrisk.plans import catalog, oracle

FOLDER = "/root/testdata/sf0.001"


def _gzipped(folder):
    return sorted(glob.glob(f"{folder}/part-*.gz"))


@pytest.mark.parametrize("of", [lambda v: v.lines, lambda v: v.wide_lines, lambda v: v.settings.logs[1]])
def test_json_lines_are_compressed_and_in_files_of_bounded_rows(spark, monkeypatch, of):
    monkeypatch.setitem(catalog.LINE_FILES, "maxRecordsPerFile", 1000)
    v = catalog.Views(spark, FOLDER)
    folder = of(v)
    files = _gzipped(folder)
    lines = [sum(1 for line in gzip.open(f, "rt") if line.strip()) for f in files]
    assert sum(lines) == v.raw.count() and max(lines) <= 1000
    assert not set(glob.glob(f"{folder}/part-*")) - set(files)


@pytest.mark.parametrize("name", ["queue_replace", "queue_append_repeats"])
def test_gold_is_made_once(spark, monkeypatch, name):
    """What is written several times or compared comes from stored rows, not from the lookups again."""
    v = catalog.Views(spark, FOLDER)
    written, write = [], catalog.Table.write

    def watched(table, df, mode, partition_by=None):
        written.append(df._jdf.queryExecution().optimizedPlan().toString())
        write(table, df, mode, partition_by)

    monkeypatch.setattr(catalog.Table, "write", watched)
    result = catalog.QUERIES[name](v)
    assert sum("l_shipdate" in plan for plan in written) == 1
    assert compare.spark_rows(result) == compare.sql_rows(oracle.oracle_sql()[name], FOLDER)
