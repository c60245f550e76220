import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from txnrisk.operators import forest


@pytest.fixture(scope="module")
def fitted(spark, tmp_path_factory):
    """A forest over a number and a category, whose splits are lists of values."""
    rows = spark.range(2000).select(
        ((F.col("id") * 7919) % 101).cast("double").alias("a"),
        ((F.col("id") * 31) % 7).cast("string").alias("b"),
        # The xor of both inputs, with noise.
        F.when(
            (((F.col("id") * 31) % 7).isin(1, 4) == ((F.col("id") * 7919) % 101 > 40)) != (F.xxhash64("id") % 5 == 0),
            1.0,
        ).otherwise(0.0).alias("y"),
    )
    steps = [
        StringIndexer(inputCol="b", outputCol="bi"),
        VectorAssembler(inputCols=["a", "bi"], outputCol="features"),
        RandomForestClassifier(labelCol="y", featuresCol="features", numTrees=7, maxDepth=4, seed=3),
    ]
    model = Pipeline(stages=steps).fit(rows)
    path = str(tmp_path_factory.mktemp("model") / "m")
    model.write().save(path)
    return model, rows, path


def test_the_walk_gives_the_models_probabilities(spark, fitted):
    model, rows, path = fitted
    table = forest.nodes(spark, path)
    own = forest.probability(vector_to_array("features"), table, 4).alias("own")
    theirs = F.get(vector_to_array("probability"), F.lit(1)).alias("theirs")
    found = model.transform(rows).select(own, theirs).distinct().collect()
    assert len(found) > 5
    assert max(abs(r.own - r.theirs) for r in found) < 1e-12
    kinds = table.filter("left >= 0").agg(F.count("threshold").alias("n"), F.count("left_values").alias("c")).first()
    assert kinds.n and kinds.c


def test_nodes_agree_with_the_models_own_counts(spark, fitted):
    model, _, path = fitted
    trees = model.stages[-1].trees
    counted = {r.tree: r for r in forest.shape(forest.nodes(spark, path), 4).collect()}
    assert [(counted[i].nodes, counted[i].depth) for i in range(7)] == [(t.numNodes, t.depth) for t in trees]
    assert all(r.complete and r.rows_add_up and r.nodes == 2 * r.leaves - 1 for r in counted.values())


def test_broken_trees_are_seen(spark, fitted):
    table = forest.nodes(spark, fitted[2])
    cut = table.filter("NOT (tree = 2 AND node = 1)")
    assert {r.tree for r in forest.shape(cut, 4).filter("NOT complete").collect()} == {2}
    assert {r.tree for r in forest.shape(table, 1).filter("complete").collect()} == set()
    moved = table.withColumn("rows", F.when(F.expr("tree = 3 AND node = 0"), 1).otherwise(F.col("rows")))
    assert {r.tree for r in forest.shape(moved, 4).filter("NOT rows_add_up").collect()} == {3}


def test_shares_of_the_inputs(spark, fitted):
    model, _, path = fitted
    found = {r.feature: r for r in forest.splits_by_feature(forest.nodes(spark, path)).collect()}
    assert set(found) == {0, 1} and sum(r.share for r in found.values()) == pytest.approx(1.0)
    theirs = model.stages[-1].featureImportances
    assert (found[0].share > found[1].share) == (theirs[0] > theirs[1])


def test_a_walk_of_missing_and_odd_values(spark):
    """Nulls, NaN, short and null vectors go right, in lists of categories too; many rows make many batches."""
    schema = (
        "tree int, node int, left int, right int, feature int, threshold double, left_values array<double>,"
        " gain double, rows bigint, probability double"
    )
    table = spark.createDataFrame(
        [
            (0, 0, 1, 2, 0, 1.5, None, 0.1, 9, 0.5),
            (0, 1, -1, -1, None, None, None, None, 4, 0.0),
            (0, 2, -1, -1, None, None, None, None, 5, 0.25),
            (1, 0, 1, 2, 2, None, [0.0, 2.0], 0.1, 9, 0.5),
            (1, 1, -1, -1, None, None, None, None, 4, 0.0),
            (1, 2, 3, 4, 0, 5.0, None, 0.1, 5, 0.5),
            (1, 3, -1, -1, None, None, None, None, 4, 0.5),
            (1, 4, -1, -1, None, None, None, None, 4, 1.0),
        ],
        schema,
    )
    nan = float("nan")
    cases = [
        ([1.5, 0.0, 2.0], 0.0), ([2.0, 0.0, 0.0], 0.125), ([2.0, 0.0, 1.0], 0.375), ([6.0, 0.0, 7.0], 0.625),
        ([1.0, 0.0, None], 0.25), ([nan, 0.0, nan], 0.625), ([1.0], 0.25), ([], 0.625), (None, 0.625),
        ([1.0, 0.0, 0.5], 0.25), ([1.0, 0.0, -1.0], 0.25),
    ]
    rows = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(cases)], "i int, v array<double>")
    many = rows.crossJoin(spark.range(2000).select("id"))
    found = many.select("i", forest.probability(F.col("v"), table, 2).alias("p")).distinct().collect()
    assert sorted((r.i, r.p) for r in found) == [(i, p) for i, (_, p) in enumerate(cases)]
    assert rows.filter("i < 0").select(forest.probability(F.col("v"), table, 2)).collect() == []
    # One step alone ends at a node inside.
    one = rows.filter("i = 3").select(forest.probability(F.col("v"), table, 1).alias("p")).first()
    assert one.p == (0.25 + 0.5) / 2
    plan = rows.select(forest.probability(F.col("v"), table, 2).alias("p"))._jdf.queryExecution().toString()
    assert "ArrowEvalPython" in plan
