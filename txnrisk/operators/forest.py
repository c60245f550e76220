"""The fitted forest as a table of nodes, and probabilities by walking that table.

The table has at most trees * (2 ** (depth + 1) - 1) rows, whatever the forest
was fitted on: 25,550 here. So each task of the walk holds it whole.
"""

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txnrisk.operators.model import DEPTH
from txnrisk.plans.session import share_code


def nodes(spark: SparkSession, path: str) -> DataFrame:
    """The nodes of a saved pipeline's forest.

    tree, node (0 is the root), left and right (-1 in a leaf), feature (its place
    in the vector), threshold (up to it rows go left) or left_values of a feature
    with categories, gain, rows, and probability: the share of class 1.
    """
    saved = spark.read.parquet(f"{path}/stages/*_RandomForestClassifier_*/data")
    node, split = F.col("nodeData"), F.col("nodeData.split")
    known = split["leftCategoriesOrThreshold"]
    is_number, counts = split["numCategories"] < 0, node["impurityStats"]
    inner = node["leftChild"] >= 0
    return saved.select(
        F.col("treeID").alias("tree"),
        node["id"].alias("node"),
        node["leftChild"].alias("left"),
        node["rightChild"].alias("right"),
        F.when(inner, split["featureIndex"]).alias("feature"),
        F.when(inner & is_number, F.get(known, F.lit(0))).alias("threshold"),
        F.when(inner & ~is_number, known).alias("left_values"),
        F.when(inner, node["gain"]).alias("gain"),
        node["rawCount"].alias("rows"),
        (F.get(counts, F.lit(1)) / F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)).alias("probability"),
    )


def with_depth(table: DataFrame, most: int = DEPTH) -> DataFrame:
    """The nodes that a walk of at most ``most`` steps from a root reaches, with the steps as ``depth``."""
    level = table.filter("node = 0").select("tree", "node")
    levels = [level.withColumn("depth", F.lit(0))]
    for depth in range(1, most + 1):
        inner = level.join(table.filter("left >= 0"), ["tree", "node"])
        level = inner.select("tree", F.explode(F.array("left", "right")).alias("node"))
        levels.append(level.withColumn("depth", F.lit(depth)))
    return table.join(reduce(DataFrame.unionByName, levels), ["tree", "node"])


def shape(table: DataFrame, most: int = DEPTH) -> DataFrame:
    """One row a tree: nodes, leaves, depth, and whether the tree is whole.

    ``complete``: every node is reached from the root once, within ``most``
    steps, and a leaf ends every way. ``rows_add_up``: children share their
    parent's rows.
    """
    reached = with_depth(table, most).groupBy("tree").agg(
        F.count("*").alias("reached"), F.max("depth").alias("depth")
    )
    child = table.select("tree", F.col("node").alias("child"), F.col("rows").alias("child_rows"))
    pairs = table.filter("left >= 0").select("tree", "node", "rows", F.explode(F.array("left", "right")).alias("child"))
    sums = pairs.join(child, ["tree", "child"]).groupBy("tree", "node", "rows").agg(F.sum("child_rows").alias("below"))
    added = sums.groupBy("tree").agg(F.bool_and(F.col("rows") == F.col("below")).alias("rows_add_up"))
    counted = table.groupBy("tree").agg(
        F.count("*").alias("nodes"), F.count_if(F.col("left") < 0).alias("leaves")
    )
    whole = (F.col("reached") == F.col("nodes")) & (F.col("nodes") == 2 * F.col("leaves") - 1)
    return counted.join(reached, "tree", "left").join(added, "tree", "left").select(
        "tree",
        "nodes",
        "leaves",
        "depth",
        F.coalesce(whole, F.lit(False)).alias("complete"),
        # A tree of one leaf has nothing to add up.
        F.coalesce("rows_add_up", F.lit(True)).alias("rows_add_up"),
    )


@dataclass
class _Walk:
    """The nodes as arrays, for a walk of many rows at once: a leaf's children are itself."""

    left: np.ndarray
    right: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    probability: np.ndarray
    roots: list[int]
    # Nodes that ask for categories: their line in ``members``, which has a place for each category; else -1.
    line: np.ndarray
    members: np.ndarray

    @classmethod
    def of(cls, table: DataFrame) -> "_Walk":
        rows = sorted(table.collect(), key=lambda row: (row.tree, row.node))
        place = {(row.tree, row.node): i for i, row in enumerate(rows)}
        inner = [row.left >= 0 for row in rows]
        listed = [row.left_values if go and row.left_values is not None else None for go, row in zip(inner, rows)]
        by_list = [i for i, values in enumerate(listed) if values is not None]
        members = np.zeros((len(by_list), 1 + max([int(v) for i in by_list for v in listed[i]], default=0)), dtype=bool)
        line = np.full(len(rows), -1)
        for n, i in enumerate(by_list):
            line[i] = n
            members[n, [int(v) for v in listed[i]]] = True
        return cls(
            np.array([place[r.tree, r.left] if go else i for i, (go, r) in enumerate(zip(inner, rows))], dtype=np.int64),
            np.array([place[r.tree, r.right] if go else i for i, (go, r) in enumerate(zip(inner, rows))], dtype=np.int64),
            np.array([r.feature if go else 0 for go, r in zip(inner, rows)], dtype=np.int64),
            np.array([r.threshold if go and r.threshold is not None else np.nan for go, r in zip(inner, rows)]),
            np.array([r.probability for r in rows], dtype=float),
            [i for i, row in enumerate(rows) if row.node == 0],
            line,
            members,
        )

    def _goes_left(self, at: np.ndarray, value: np.ndarray) -> np.ndarray:
        left = value <= self.threshold.take(at)
        if len(self.members):
            asks = np.flatnonzero(self.line.take(at) >= 0)
            known = value[asks]
            whole = (known >= 0) & (known < self.members.shape[1]) & (known == np.floor(known))
            found = self.members[self.line.take(at[asks]), np.where(whole, known, 0).astype(np.int64)]
            left[asks] = whole & found
        return left

    def probabilities(self, vectors: pa.Array, most: int) -> np.ndarray:
        """For each vector the mean over the trees. A missing value goes right."""
        values = _matrix(vectors, int(self.feature.max(initial=0)) + 1)
        flat, start = values.ravel(), np.arange(len(values)) * values.shape[1]
        total = np.zeros(len(values))
        for root in self.roots:
            at = np.full(len(values), root)
            for _ in range(most):
                value = flat.take(start + self.feature.take(at))
                at = np.where(self._goes_left(at, value), self.left.take(at), self.right.take(at))
            total += self.probability.take(at)
        return total / len(self.roots)


def _matrix(vectors: pa.Array, least: int) -> np.ndarray:
    """The vectors as lines of at least so many values; what is missing is NaN."""
    lengths = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False)
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    width = max(least, int(lengths.max(initial=0)))
    if (lengths == width).all():
        return flat.reshape(len(lengths), width)
    lines = np.full((len(lengths), width), np.nan)
    lines[np.arange(width) < lengths[:, None]] = flat
    return lines


def probability(features: Column, table: DataFrame, most: int = DEPTH) -> Column:
    """The mean over all trees of class 1's share in the leaf that a row reaches.

    ``features`` is an array of doubles. The nodes are collected, as a model is,
    and go to the tasks with the function. No row is copied for a tree and nothing
    is joined: a batch of rows walks each tree by at most ``most`` steps in numpy.
    """
    share_code(table.sparkSession)
    walk = _Walk.of(table)

    @F.arrow_udf("double")
    def walked(vectors: pa.Array) -> pa.Array:
        return pa.array(walk.probabilities(vectors, most))

    return walked(features)


def splits_by_feature(table: DataFrame) -> DataFrame:
    """(feature, splits, share): how often each input is asked, and its share of all gain by rows."""
    inner = table.filter("left >= 0").withColumn("weight", F.col("gain") * F.col("rows"))
    by = inner.groupBy("feature").agg(F.count("*").alias("splits"), F.sum("weight").alias("weight"))
    whole = Window.partitionBy()
    return by.select("feature", "splits", (F.col("weight") / F.sum("weight").over(whole)).alias("share"))
