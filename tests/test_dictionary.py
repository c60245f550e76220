from collections import Counter

import frames
from pyspark.sql import functions as F

from txnrisk.operators import dictionary, report
from txnrisk.operators.joins import Limits
from txnrisk.plans import catalog
from txnrisk.plans.catalog import Views
from txnrisk.schemas import CATEGORICAL_FEATURES

FOLDER = "/root/testdata/sf0.001"


def values(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, v string").repartition(4)


def test_positions_against_sorting(spark):
    texts = [f"v{i % 13}" for i in range(200)] + ["hot"] * 300 + [None] * 50 + ["", "É", "z", "a"]
    counts = Counter(t for t in texts if t is not None)
    wanted = sorted(counts.items(), key=lambda item: (-item[1], item[0].encode()))
    got = {r.value: (r.n, r.position) for r in dictionary.ranks(values(spark, texts), "v").collect()}
    assert got == {value: (n, place) for place, (value, n) in enumerate(wanted)}


def test_more_values_than_partitions_and_none(spark):
    got = dictionary.ranks(values(spark, [f"{i:05}" for i in range(5000)]), "v").collect()
    assert sorted((r.position, r.value) for r in got) == [(i, f"{i:05}") for i in range(5000)]
    assert dictionary.ranks(values(spark, [None]), "v").isEmpty()


def test_nothing_but_small_tables_is_broadcast(spark):
    plan = frames.plan_of(dictionary.ranks(values(spark, ["a", "b"]), "v"))
    assert "SinglePartition" in plan and plan.count("Window") == 1


def test_it_equals_the_models_own_index(spark):
    v = Views(spark, FOLDER)
    own = {(r.feature, r.value): r.position for r in catalog.QUERIES["category_index"](v).collect()}
    labeled = report.labeled(v.gold)
    for name in CATEGORICAL_FEATURES:
        got = {(name, r.value): r.position for r in dictionary.ranks(labeled, name).collect()}
        assert got == {k: p for k, p in own.items() if k[0] == name}


def test_codes(spark):
    rows = values(spark, ["a"] * 40 + ["b"] * 3 + [None, "new"])
    known = dictionary.ranks(rows.filter("v <> 'new'"), "v")
    got = dictionary.encoded(rows, "v", known, "id", Limits(0, 5, 10))
    assert got.columns == ["id", "v", "v_position"]
    counted = {(r.v, r.v_position): r.n for r in got.groupBy("v", "v_position").agg(F.count("*").alias("n")).collect()}
    assert counted == {("a", 0): 40, ("b", 1): 3, (None, None): 1, ("new", None): 1}


def test_hashed_codes(spark):
    rows = spark.range(5000).select(F.col("id").cast("string").alias("v")).unionByName(
        spark.createDataFrame([(None,)], "v string")
    )
    coded = rows.select("v", dictionary.hashed("v", 64).alias("code"))
    counts = {r.code: r.n for r in coded.groupBy("code").agg(F.count("*").alias("n")).collect()}
    assert counts.pop(None) == 1 and set(counts) == set(range(64)) and max(counts.values()) < 140
