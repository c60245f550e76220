"""What the registered queries' physical plans may and may not hold."""

import frames
import pytest

from txnrisk.operators import clean, enrich, queue, report
from txnrisk.plans import catalog
from txnrisk.sources.tables import Table

FOLDER = "/root/testdata/sf0.001"
# These build their frame by writing tables first.
LAZY = [
    name
    for name in catalog.QUERIES
    if name
    not in {
        "queue_append_repeats", "one_hot", "category_index", "score_checks", "queue_checks",
        "json_ingest", "json_line_states", "csv_payers", "csv_payees", "table_overwrite",
        "table_by_state", "queue_append_twice", "queue_replace", "stage_counts", "train_eval",
        "score_unlabeled", "review_queue", "extra_fields", "inputs_missing", "table_versions",
        "connector_round_trip", "queue_append_pruned", "forest_rescored", "forest_shape",
        "enriched_without_payers", "enriched_bucketed", "category_ranks", "category_codes",
        "exact_medians", "stored_counts", "stage_plan",
    }
]


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cross_join(spark, name):
    plan = frames.plan_of(catalog.queries()[name](spark, FOLDER))
    for operator in ("PythonUDF", "EvalPython", "MapInPandas", "CartesianProduct", "NestedLoopJoin"):
        assert operator not in plan, operator


def test_scans_read_only_the_needed_columns(spark):
    plan = frames.plan_of(catalog.queries()["ingestion_summary"](spark, FOLDER))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_extendedprice:double" in plan
    for unused in ("l_tax", "l_quantity", "l_shipdate", "o_totalprice", "p_name"):
        assert unused not in plan


def test_top_rows_are_not_sorted_as_a_whole(spark):
    plan = frames.plan_of(catalog.queries()["layer_sample_raw"](spark, FOLDER))
    assert "TakeOrderedAndProject" in plan and "Sort [" not in plan


def test_silver_is_shuffled_once_and_its_partitioning_reused(spark):
    silver = catalog.Views(spark, FOLDER).silver
    counted = silver.groupBy("transaction_id").count()
    assert frames.plan_of(counted).count("Exchange hashpartitioning(transaction_id") == 1


def test_a_table_in_buckets_needs_no_exchange(spark, tmp_path):
    """Latest row of each id, lookups, and the anti join with a queue in as many buckets."""
    v = catalog.Views(spark, FOLDER)

    def bucketed(name, df):
        made = Table(name=name, options={"path": str(tmp_path / name)}, bucket_by="transaction_id", buckets=4)
        made.replace(df)
        return made

    raw = bucketed("plan_raw", v.raw)
    queued = bucketed("plan_queue", v.alerts.limit(50))
    silver = clean.latest(raw.read(spark))
    assert "Exchange" not in frames.plan_of(silver)
    gold = enrich.enrich(silver, v.payers, v.payees)
    assert "hashpartitioning(transaction_id" not in frames.plan_of(gold)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        new = queue.not_queued(silver, queued.read(spark))
        plan = frames.plan_of(new)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    queued.append(v.alerts.limit(60))
    assert queued.read(spark).count() == 110
    with pytest.raises(ValueError, match="buckets need"):
        Table("p", bucket_by="x", buckets=3)


def test_stored_counts_read_no_rows(spark):
    plan = frames.plan_of(catalog.queries()["stored_counts"](spark, FOLDER))
    assert plan.count("PushedAggregation: [COUNT(*)]") == 3
    # The session's own settings stay as they were.
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_stored_counts_by_directory(spark):
    v = catalog.views(spark.sparkContext.applicationId, spark, FOLDER)
    found = report.stored_counts(spark, {"gold": v.layers.gold.folders(spark)}, by="label_state")
    assert {r.label_state: r.n for r in found.collect()} == {"labeled": 3022, "unlabeled": 1564}
    assert "PushedAggregation: [COUNT(*)]" in frames.plan_of(found)


def test_frequent_keys_are_counted_on_the_rows_of_the_join(spark):
    """Silver's shuffle serves the counts of both keys and the joins: line items are read once."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = frames.plan_of(catalog.queries()["enriched_by_shuffle"](spark, FOLDER))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("struct<l_orderkey") == 1
