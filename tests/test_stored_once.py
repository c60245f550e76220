"""Rows that a query reads more than once are made once and stored."""

import frames
import pytest

from txnrisk.plans import catalog

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["random_split", "unlabeled_or_first_2500"])
def test_later_readers_join_nothing(spark, name):
    """What is read last comes from stored rows; before, its plan made gold from the order tables again."""
    plan = frames.plan_of(catalog.QUERIES[name](catalog.Views(spark, FOLDER)))
    assert "SortMergeJoin" not in plan and "HashJoin" not in plan and "Location: InMemoryFileIndex" in plan
