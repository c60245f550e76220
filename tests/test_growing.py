import collections
import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from txnrisk.functions import scoring
from txnrisk.operators import curves, forest, growing, medians, model, report, split
from txnrisk.plans.catalog import Views

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def gold(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("gold") / "t")
    Views(spark, FOLDER).gold.write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def both(gold):
    """The same rows fitted by Spark ML's forest and by the one that is grown."""
    train, test = split.split_frames(report.labeled(gold))
    theirs = model.fit(train)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(model, "KEPT_ROWS", 0)
        # Several blocks, so that counts of tasks and blocks have to add up.
        patch.setattr(growing, "BLOCK_ROWS", 300)
        patch.setattr(growing, "PART_BLOCKS", 2)
        own = model.fit(train)
    return theirs, own, test


def _inputs() -> growing.Inputs:
    cuts = [np.array([0.5, 1.5, 2.5]), np.array([])]
    return growing.Inputs(["a", "b"], [3, 300], ["x", "y"], np.ones(305), cuts)


def _codes(rows: int) -> np.ndarray:
    random = np.random.default_rng(7)
    label = random.integers(0, 2, rows)
    columns = [random.integers(0, w, rows) for w in _inputs().widths()]
    return np.stack([2 * c + label for c in columns]).astype(_inputs().kind())


def test_many_rows_make_a_model_of_the_same_kind(both):
    theirs, own, _ = both
    assert [type(s) for s in own.stages] == [type(s) for s in theirs.stages]
    grown, kept = own.stages[-1], theirs.stages[-1]
    assert (grown.getNumTrees, grown.getMaxDepth(), grown.numFeatures, grown.numClasses) == (
        kept.getNumTrees,
        kept.getMaxDepth(),
        kept.numFeatures,
        kept.numClasses,
    )
    assert max(t.depth for t in grown.trees) == model.DEPTH
    assert 0.7 < grown.totalNumNodes / kept.totalNumNodes < 1.4


def test_it_is_as_good_as_spark_mls(both):
    found = []
    for fitted in both[:2]:
        counts = curves.score_counts(model.score(fitted, both[2]), "fraud_probability")
        found.append(model.evaluate(curves.running_totals(counts)).first())
    for name in ("roc_auc", "average_precision", "accuracy"):
        assert abs(found[0][name] - found[1][name]) < 0.06
    assert found[0].test_rows == found[1].test_rows


def test_its_stored_nodes_are_whole_trees(spark, both, tmp_path):
    path = str(tmp_path / "m")
    both[1].write().save(path)
    nodes = forest.nodes(spark, path)
    shape = forest.shape(nodes).collect()
    assert len(shape) == model.TREES and all(r.complete and r.rows_add_up and r.nodes > 1 for r in shape)
    scored = both[1].transform(both[2])
    same = F.abs(forest.probability(vector_to_array("features"), nodes) - scoring.fraud_probability()) <= 1e-9
    assert scored.filter(~same).count() == 0
    # About as many rows as there are, drawn anew for each tree.
    rows = [r["rows"] for r in nodes.filter("node = 0").collect()]
    assert len(set(rows)) > 1 and max(rows) < 1.2 * min(rows)


def test_splits_send_rows_where_the_counts_said(gold, monkeypatch):
    """Every row of training walks to a leaf; the rows of each node, drawn as often as said, are its counts."""
    monkeypatch.setattr(model, "KEPT_ROWS", 0)
    monkeypatch.setattr(growing, "draw_counts", lambda: np.ones(1 << 16, dtype=np.uint8))
    train, _ = split.split_frames(report.labeled(gold))
    fitted = model.fit(train)
    known = model.feature_frame(train).filter("amount IS NOT NULL")
    leaf = F.get(vector_to_array("leaves"), F.lit(0)).alias("leaf")
    fitted.stages[-1].setLeafCol("leaves")
    reached = collections.Counter(r.leaf for r in fitted.transform(known).select(leaf).collect())
    root = fitted.stages[-1].trees[0]._call_java("rootNode")
    counts, stack, seen = [], [root], 0
    while stack:
        node = stack.pop()
        if "LeafNode" in node.getClass().getName():
            counts.append(node.impurityStats().rawCount())
            seen += 1
        else:
            stack += [node.rightChild(), node.leftChild()]
    assert [reached[i] for i in range(seen)] == counts and sum(counts) == known.count()


@pytest.mark.parametrize("asked", [0.0, 2.0])
@pytest.mark.parametrize("tabled", [0, 10_000])
def test_counts_against_a_loop(monkeypatch, asked, tabled):
    monkeypatch.setattr(growing, "ASKED", asked)
    monkeypatch.setattr(growing, "TABLED", tabled)
    inputs, codes = _inputs(), _codes(500)
    tree = growing.Tree.empty(3)
    # The root sends the second value of b right, its left child numbers above 1.5.
    tree.column[:2], tree.low[:2], tree.span[:2] = [1, 2], [2, 4], [1, 3]
    subsets = np.array([[0, 2, 4, 303], [1, 5, 303, 304]])
    wanted = growing.Wanted(tree, np.array([3, 4]), subsets)
    batch = pa.RecordBatch.from_pydict({"block": [9], "rows": [500], "codes": [codes.tobytes()]})
    (made,) = growing._counted(inputs, [wanted], growing.draw_counts(), 2, 42, iter([batch]))
    got = np.frombuffer(made.column("sums")[0].as_py())

    random = np.random.Generator(np.random.SFC64([42, 9, 0])).integers(0, 1 << 16, 500, np.uint16)
    times, starts = growing.draw_counts()[random], wanted.starts(inputs.counted())[0]
    expected = np.zeros(len(got))
    for row in range(500):
        values, label = codes[:, row] // 2, codes[0, row] % 2
        if values[1] == 1:
            continue
        node = int(values[2] > 1)
        expected[1 + 2 * node + label] += times[row]
        for place, start in zip(subsets[node], starts[node], strict=True):
            if place < 303:
                column, value = (0, place) if place < 3 else (1, place - 3)
                expected[start + label] += times[row] * (values[column] == value)
            else:
                expected[start + 2 * values[place - 301] + label] += times[row]
    assert np.array_equal(got[1:], expected[1:])


def test_the_split_of_most_gain_is_taken():
    inputs = growing.Inputs(["a"], [2], ["x"], np.array([2.0, 0.0, 1.0]), [np.array([1.0, 5.0])])
    wanted = growing.Wanted(growing.Tree.empty(2), np.array([0]), np.array([[0, 1, 2]]))
    starts, length = wanted.starts(inputs.counted())
    sums = np.zeros(length)
    sums[1:3] = [10, 10]
    sums[starts[0, 0] :][:2] = [5, 6]
    # The second category would be perfect, but never varies in the vector.
    sums[starts[0, 1] :][:2] = [10, 0]
    sums[starts[0, 2] :][:6] = [4, 3, 5, 0, 1, 7]
    opened = growing.split_open(wanted, sums, inputs, last=False)
    tree = wanted.tree
    assert tree.inner[0] and tree.place[0] == 2 and tree.threshold[0] == 5.0
    assert tree.stats[:3].tolist() == [[10, 10], [9, 3], [1, 7]] and opened.tolist() == [1, 2]
    parts = [1 - (9 / 12) ** 2 - (3 / 12) ** 2, 1 - (1 / 8) ** 2 - (7 / 8) ** 2]
    assert math.isclose(tree.gain[0], 0.5 - 12 / 20 * parts[0] - 8 / 20 * parts[1])


def test_pure_and_last_children_are_leaves_and_equal_ones_merge():
    inputs = growing.Inputs(["a"], [1], [], np.array([1.0]))
    wanted = growing.Wanted(growing.Tree.empty(2), np.array([0]), np.array([[0]]))
    sums = np.array([0, 6.0, 4.0, 0.0, 3.0])
    assert growing.split_open(wanted, sums, inputs, last=False).tolist() == [1]
    assert wanted.tree.stats[1:3].tolist() == [[6, 1], [0, 3]]
    rows = growing.node_rows([wanted.tree])
    assert [r[1][0] for r in rows] == [0, 1, 2] and rows[0][1][6:] == (1, 2, (0, [0.5], -1))
    assert growing.split_open(growing.Wanted(growing.Tree.empty(2), np.array([0]), np.array([[0]])), sums, inputs, True).size == 0
    wanted.tree.stats[2] = [2, 1]
    growing.merge_leaves(wanted.tree)
    assert not wanted.tree.inner[0] and len(growing.node_rows([wanted.tree])) == 1


def test_cuts_lie_between_values_or_at_quantiles():
    assert growing.cuts_of(np.array([3.0, 1.0, 1.0]), 32).tolist() == [2.0]
    assert growing.cuts_of(np.array([4.0, 4.0]), 32).tolist() == []
    cuts = growing.cuts_of(np.arange(3200.0), 32)
    assert len(cuts) == 31 and set(np.histogram(np.arange(3200.0), [-1, *cuts, 3200])[0]) <= {99, 100, 101}


def test_draws_are_a_poisson_distribution():
    shares = np.bincount(growing.draw_counts()) / (1 << 16)
    for times, share in enumerate(shares[:6]):
        assert abs(share - math.exp(-1) / math.factorial(times)) < 1e-4


def test_wide_categories_by_hash_are_grown_too(gold, monkeypatch):
    monkeypatch.setattr(model, "KEPT_ROWS", 0)
    some = report.labeled(gold).withColumn("currency", F.col("transaction_id"))
    fitted = model.fit(some, hash_width=400, most_values=100)
    scored = model.score(fitted, some).select("fraud_probability").distinct().count()
    assert scored > 50 and fitted.stages[-1].numFeatures > 400


def test_shared_ranges_of_two_ranks_are_counted_once(spark, monkeypatch):
    rows = spark.range(1000).select((F.col("id") * 0.5).alias("v"))
    taken, entry = [], medians._Search.entry
    monkeypatch.setattr(medians._Search, "entry", lambda self, i: taken.append(i) or entry(self, i))
    assert medians.medians(rows, ["v"]) == {"v": (1000, 249.75)}
    assert taken[0] == 0 and taken.count(0) > 0 and len(taken) <= 3


def test_no_row_of_training_is_kept_as_objects(gold, monkeypatch):
    """Above the limit Spark ML's forest sees none of the rows."""
    monkeypatch.setattr(model, "KEPT_ROWS", 0)
    seen, fit = [], model.RandomForestClassifier.fit
    monkeypatch.setattr(model.RandomForestClassifier, "fit", lambda self, df: seen.append(df.count()) or fit(self, df))
    model.fit(report.labeled(gold))
    assert seen == [2]
