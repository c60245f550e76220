"""A random forest grown level by level from histograms, for more rows than Spark ML's forest can keep.

Spark ML's forest keeps each row as objects of 1.4 kB between its levels. Here a
row is one small code for each input column: the place of its category, or the
bin of its number. For each level, each task walks its rows down the trees grown
so far and counts classes by node, input and bin; the counts are added up by
tree, and the driver chooses the splits from them. What reaches it is bounded by
trees, nodes, inputs of a node and bins, whatever the number of rows.

The method is that of Spark ML: Gini impurity; bins from the quantiles of a
sample; a random subset of the inputs, the square root of their number, for each
node; each row in each tree as often as a Poisson draw of mean 1 says, here one
of 16 bits. A row's draws come from its place in its block, so that they are the
same in all levels. Leaves of one prediction below the same node are merged.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnrisk.plans.session import share_code
from txnrisk.plans.workdir import new_folder

#: Rows of one block, which a task holds at a time, blocks of one task, and rows of which bins are made.
BLOCK_ROWS = 65_536
PART_BLOCKS = 8
SAMPLE_ROWS = 10_000
#: A column with more codes than this finds the counts of its values by search, not in a table.
TABLED = 256
#: A column that fewer of the open nodes ask for is counted over these nodes' rows alone.
ASKED = 0.4
#: Impurities below this count as none.
EPSILON = float(np.finfo(float).eps)
_BLOCK = "block bigint, rows int, codes binary"
_SUMS = "tree int, sums binary"
_NODES = (
    "treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>,"
    " rawCount: bigint, gain: double, leftChild: int, rightChild: int,"
    " split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>>"
)


@dataclass
class Inputs:
    """How the columns of the rows become the places of the feature vector.

    Each category is a column of indices and has ``sizes`` places, one for each
    index below its size; other indices have none. The numbers come after all
    categories, a place each. ``scales`` has the factor of each place.
    """

    categories: list[str]
    sizes: list[int]
    numbers: list[str]
    scales: np.ndarray
    cuts: list[np.ndarray] = field(default_factory=list)

    @property
    def places(self) -> int:
        return sum(self.sizes) + len(self.numbers)

    def first(self, column: int) -> int:
        """The first place of a column."""
        return sum(self.sizes[:column]) + max(0, column - len(self.sizes))

    def widths(self) -> list[int]:
        """Codes of each column: all indices and one for none, or bins."""
        return [size + 1 for size in self.sizes] + [len(c) + 1 for c in self.cuts]

    def counted(self) -> np.ndarray:
        """Counts that a node keeps for each place: of the rows that have the category, or of each bin."""
        return np.array([1] * sum(self.sizes) + [len(c) + 1 for c in self.cuts])

    def kind(self) -> np.dtype:
        """The smallest type for a code and a class in one number."""
        return np.min_scalar_type(2 * max(self.widths()))


def cuts_of(values: np.ndarray, bins: int) -> np.ndarray:
    """Where the bins of a number end, from a sample: between all values or, if there are more, at quantiles."""
    distinct, counts = np.unique(values, return_counts=True)
    middles = (distinct[:-1] + distinct[1:]) / 2
    if len(middles) <= bins - 1:
        return middles
    upto = np.cumsum(counts)
    stride = target = upto[-1] / bins
    kept = []
    for i in range(1, len(upto)):
        if abs(upto[i - 1] - target) < abs(upto[i] - target):
            kept.append(middles[i - 1])
            target += stride
    return np.array(kept)


def draw_counts() -> np.ndarray:
    """How often a row is taken, for each number of 16 bits: a Poisson distribution of mean 1."""
    shares = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)])
    return np.searchsorted(shares, (np.arange(1 << 16) + 0.5) / (1 << 16)).astype(np.uint8)


@dataclass
class Tree:
    """A tree in the places of a heap: the children of node n are 2n + 1 and 2n + 2.

    A row goes right where its code in ``column`` lies from ``low`` on within ``span``.
    """

    column: np.ndarray
    low: np.ndarray
    span: np.ndarray
    place: np.ndarray
    threshold: np.ndarray
    gain: np.ndarray
    stats: np.ndarray
    inner: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        n = 2 ** (depth + 1) - 1
        whole = [np.zeros(n, dtype=np.int64) for _ in range(4)]
        return cls(*whole, np.zeros(n), np.zeros(n), np.zeros((n, 2)), np.zeros(n, dtype=bool))


@dataclass
class Wanted:
    """What a level counts of one tree: its open nodes and the places that each of them may be split by.

    The counts lie in one array: a place for what is not wanted, the classes of
    each node, then those of each node's places and their bins.
    """

    tree: Tree
    nodes: np.ndarray
    subsets: np.ndarray

    def starts(self, counted: np.ndarray) -> tuple[np.ndarray, int]:
        """Where the counts of each node's places begin, and how long the array is."""
        sizes = 2 * counted[self.subsets]
        ends = np.cumsum(sizes).reshape(sizes.shape)
        first = 1 + 2 * len(self.nodes)
        return first + ends - sizes, first + int(sizes.sum())


class _Spots:
    """Where the rows of one node and code are counted, for each column of one tree."""

    def __init__(self, wanted: Wanted, inputs: Inputs):
        counted = inputs.counted()
        starts, self.length = wanted.starts(counted)
        node, place, start = (
            np.repeat(np.arange(len(wanted.nodes)), wanted.subsets.shape[1]),
            wanted.subsets.ravel(),
            starts.ravel(),
        )
        self.widths = [2 * w for w in inputs.widths()]
        self.found: list[tuple[np.ndarray | None, np.ndarray]] = []
        # Which nodes may be split by a column at all.
        self.asked = np.zeros((len(self.widths), len(wanted.nodes)), dtype=bool)
        for c, width in enumerate(self.widths):
            first, after = inputs.first(c), inputs.first(c + 1)
            mine = (place >= first) & (place < after)
            self.asked[c, node[mine]] = True
            # Keys of node, code and class, and the spots of their counts.
            each = 2 * counted[place[mine]]
            offset = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
            keys = np.repeat(node[mine] * width + 2 * (place[mine] - first) * (c < len(inputs.sizes)), each) + offset
            spots = np.repeat(start[mine], each) + offset
            if width <= 2 * TABLED:
                table = np.zeros(len(wanted.nodes) * width, dtype=np.int64)
                table[keys] = spots
                self.found.append((None, table))
            else:
                order = np.argsort(keys)
                self.found.append((np.append(keys[order], -1), np.append(spots[order], 0)))

        self.shares = self.asked.mean(axis=1)

    def of(self, column: int, at: np.ndarray, line: np.ndarray) -> np.ndarray:
        known, spots = self.found[column]
        keys = at * self.widths[column] + line
        if known is None:
            return spots.take(keys)
        at = np.searchsorted(known[:-1], keys)
        return np.where(known.take(at) == keys, spots.take(at), 0)


def _open_rows(tree: Tree, nodes: np.ndarray, codes: np.ndarray, rows: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the rows those that reach an open node of a level, and the node's number among these."""
    flat, line, low, span = codes.ravel(), tree.column * codes.shape[1], tree.low, tree.span.view(np.uint64)
    at = np.zeros(len(rows), dtype=np.int64)
    for _ in range(level):
        value = flat.take(line.take(at) + rows) - low.take(at)
        right = value.view(np.uint64) <= span.take(at)
        at += at
        at += 1
        at += right
    number = np.full(len(tree.column), -1, dtype=np.int64)
    number[nodes] = np.arange(len(nodes))
    at = number.take(at)
    if level == 0:
        return rows, at
    kept = np.flatnonzero(at >= 0)
    return (rows, at) if len(kept) == len(rows) else (rows.take(kept), at.take(kept))


def _to_blocks(inputs: Inputs, most: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of indices, numbers and the label to blocks of ``most`` rows' codes, a line of the block for each column."""
    kind, widths = inputs.kind(), inputs.widths()
    held: list[np.ndarray] = []
    scales = inputs.scales[sum(inputs.sizes) :]
    number = TaskContext.get().partitionId() << 32

    def block(codes: np.ndarray) -> pa.RecordBatch:
        values = [pa.array([number]), pa.array([codes.shape[1]], pa.int32()), pa.array([codes.tobytes()], pa.binary())]
        return pa.RecordBatch.from_arrays(values, names=["block", "rows", "codes"])

    for batch in batches:
        label = batch.column("label").to_numpy().astype(kind)
        lines = [
            np.minimum(batch.column(name).to_numpy(), width - 1)
            for name, width in zip(inputs.categories, widths[: len(inputs.sizes)], strict=True)
        ]
        lines += [
            np.searchsorted(cuts, batch.column(name).to_numpy() * scale)
            for name, cuts, scale in zip(inputs.numbers, inputs.cuts, scales, strict=True)
        ]
        held.append(np.stack([2 * line.astype(kind) + label for line in lines]))
        while sum(h.shape[1] for h in held) >= most:
            whole = np.concatenate(held, axis=1)
            yield block(np.ascontiguousarray(whole[:, :most]))
            number, held = number + 1, [whole[:, most:]]
    rest = np.concatenate(held, axis=1) if held else np.zeros((0, 0))
    if rest.size:
        yield block(np.ascontiguousarray(rest))


def _counted(
    inputs: Inputs, level: list[Wanted], draws: np.ndarray, depth: int, seed: int, batches: Iterator[pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    """The counts of a task's blocks, a row for each tree that has open nodes."""
    kind, columns = inputs.kind(), len(inputs.widths())
    none = int(np.searchsorted(draws, 1))
    trees = [(t, wanted, _Spots(wanted, inputs)) for t, wanted in enumerate(level) if len(wanted.nodes)]
    sums = {t: np.zeros(spots.length) for t, _, spots in trees}
    for batch in batches:
        for number, bytes_ in zip(batch.column("block").to_pylist(), batch.column("codes"), strict=True):
            codes = np.frombuffer(bytes_.as_buffer(), dtype=kind).reshape(columns, -1)
            n = codes.shape[1]
            for t, wanted, spots in trees:
                random = np.random.Generator(np.random.SFC64([seed, number, t])).integers(0, 1 << 16, n, np.uint16)
                rows, at = _open_rows(wanted.tree, wanted.nodes, codes, np.flatnonzero(random >= none), depth)
                if not len(rows):
                    continue
                weights, added = draws.take(random.take(rows)).astype(float), sums[t]
                added += np.bincount(1 + 2 * at + (codes[0].take(rows) & 1), weights, spots.length)
                for c in np.flatnonzero(spots.shares):
                    some = (rows, at, weights)
                    if spots.shares[c] < ASKED:
                        chosen = np.flatnonzero(spots.asked[c].take(at))
                        some = (part.take(chosen) for part in some)
                    row, node, weight = some
                    added += np.bincount(spots.of(c, node, codes[c].take(row)), weight, spots.length)
    if sums:
        yield _sums_batch(sums)


def _sums_batch(sums: dict[int, np.ndarray]) -> pa.RecordBatch:
    lines = [pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())]
    return pa.RecordBatch.from_arrays(lines, names=["tree", "sums"])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each tree of a task: its counts added up."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for tree, counts in zip(batch.column("tree").to_pylist(), batch.column("sums"), strict=True):
            more = np.frombuffer(counts.as_buffer())
            sums[tree] = sums[tree] + more if tree in sums else more
    if sums:
        yield _sums_batch(sums)


def _gini(stats: np.ndarray) -> np.ndarray:
    with np.errstate(invalid="ignore", divide="ignore"):
        return 1 - ((stats / stats.sum(axis=-1, keepdims=True)) ** 2).sum(axis=-1)


def split_open(wanted: Wanted, sums: np.ndarray, inputs: Inputs, last: bool) -> np.ndarray:
    """Split the open nodes of a tree where that gains anything; the children that are open now.

    Of equal gains that of the first place and the lowest threshold is taken.
    """
    tree, counted, hot = wanted.tree, inputs.counted(), sum(inputs.sizes)
    starts, _ = wanted.starts(counted)
    totals = sums[1 : 1 + 2 * len(wanted.nodes)].reshape(-1, 2)
    tree.stats[wanted.nodes] = totals
    node, place = np.repeat(np.arange(len(wanted.nodes)), wanted.subsets.shape[1]), wanted.subsets.ravel()
    found = []
    # A category that never varies has a factor of 0 and no split.
    some = np.flatnonzero((place < hot) & (inputs.scales[place] != 0))
    at = starts.ravel()[some]
    found.append((node[some], place[some], np.zeros(len(some), int), totals[node[some]] - sums[at[:, None] + np.arange(2)]))
    for j, cuts in enumerate(inputs.cuts):
        some = np.flatnonzero(place == hot + j)
        if not len(cuts) or not len(some):
            continue
        counts = sums[starts.ravel()[some][:, None] + np.arange(2 * (len(cuts) + 1))].reshape(len(some), -1, 2)
        left = np.cumsum(counts, axis=1)[:, :-1].reshape(-1, 2)
        each = np.repeat(some, len(cuts))
        found.append((node[each], place[each], np.tile(np.arange(len(cuts)), len(some)), left))
    node, place, cut, left = (np.concatenate(parts) for parts in zip(*found, strict=True))
    right, whole = totals[node] - left, totals[node].sum(axis=1)
    left_rows, right_rows = left.sum(axis=1), right.sum(axis=1)
    with np.errstate(invalid="ignore", divide="ignore"):
        gain = _gini(totals)[node] - left_rows / whole * _gini(left) - right_rows / whole * _gini(right)
    good = np.flatnonzero((left_rows >= 1) & (right_rows >= 1) & (gain > 0))
    order = good[np.lexsort((cut[good], place[good], -gain[good], node[good]))]
    best = order[np.unique(node[order], return_index=True)[1]]
    opened = []
    for i in best:
        n, p = wanted.nodes[node[i]], place[i]
        column = int(np.searchsorted([inputs.first(c + 1) for c in range(len(inputs.widths()))], p, side="right"))
        if p < hot:
            low, span, threshold = p - inputs.first(column), 0, inputs.scales[p] / 2
        else:
            low, threshold = cut[i] + 1, inputs.cuts[p - hot][cut[i]]
            span = len(inputs.cuts[p - hot]) - low
        tree.column[n], tree.low[n], tree.span[n] = column, 2 * low, 2 * span + 1
        tree.place[n], tree.threshold[n], tree.gain[n], tree.inner[n] = p, threshold, gain[i], True
        for child, stats in ((2 * n + 1, left[i]), (2 * n + 2, right[i])):
            tree.stats[child] = stats
            if not last and _gini(stats) >= EPSILON:
                opened.append(child)
    return np.array(sorted(opened), dtype=np.int64)


def merge_leaves(tree: Tree) -> None:
    """Nodes whose children are leaves of one prediction become leaves, from the bottom up."""
    for n in np.flatnonzero(tree.inner)[::-1]:
        left, right = 2 * n + 1, 2 * n + 2
        if not tree.inner[left] and not tree.inner[right]:
            tree.inner[n] = tree.stats[left].argmax() != tree.stats[right].argmax()


def node_rows(trees: list[Tree]) -> list[tuple]:
    """The nodes as Spark ML stores them: numbered from the root on, a node before what is left of it."""
    rows = []
    for t, tree in enumerate(trees):
        ids: dict[int, int] = {}
        stack = [0]
        while stack:
            n = stack.pop()
            ids[n] = len(ids)
            if tree.inner[n]:
                stack += [2 * n + 2, 2 * n + 1]
        for n, number in ids.items():
            stats = tree.stats[n]
            known = (number, float(stats.argmax()), float(_gini(stats)), stats.tolist(), int(stats.sum()))
            if tree.inner[n]:
                split = (int(tree.place[n]), [float(tree.threshold[n])], -1)
                rows.append((t, (*known, float(tree.gain[n]), ids[2 * n + 1], ids[2 * n + 2], split)))
            else:
                rows.append((t, (*known, -1.0, -1, -1, (-1, [], -1))))
    return rows


def _as_model(
    spark: SparkSession, forest: RandomForestClassifier, trees: list[Tree], places: int
) -> RandomForestClassificationModel:
    """The trees as a model of Spark ML: its own saved form of a blank forest, with their nodes."""
    empty = Vectors.sparse(places, [])
    blank = spark.createDataFrame([(empty, 0.0), (empty, 1.0)], [forest.getFeaturesCol(), forest.getLabelCol()])
    path = new_folder(spark, "forest")
    forest.fit(blank).write().save(path)
    nodes = spark.createDataFrame(node_rows(trees), _NODES)
    nodes.coalesce(1).write.mode("overwrite").parquet(f"{path}/data")
    return RandomForestClassificationModel.load(path)


def grow(
    rows: DataFrame, label: str, inputs: Inputs, forest: RandomForestClassifier, count: int
) -> RandomForestClassificationModel:
    """The forest's settings (trees, depth, bins, seed) fitted on ``count`` rows with columns as ``inputs`` has them."""
    spark = rows.sparkSession
    share_code(spark)
    depth, seed, numbers = forest.getMaxDepth(), forest.getSeed(), inputs.numbers
    sample = rows.select(numbers).sample(min(1.0, SAMPLE_ROWS / max(1, count)), seed).collect()
    scales = inputs.scales[sum(inputs.sizes) :]
    for j, scale in enumerate(scales):
        inputs.cuts.append(cuts_of(np.array([row[j] for row in sample]) * scale, forest.getMaxBins()))
    columns = [*[F.col(c).cast("int").alias(c) for c in inputs.categories], *numbers, F.col(label).cast("int").alias("label")]
    most = BLOCK_ROWS
    blocks = rows.select(columns).mapInArrow(lambda batches: _to_blocks(inputs, most, batches), _BLOCK)
    # Blocks are dealt out evenly: the levels take most of the time.
    blocks = blocks.repartition(-(-count // (most * PART_BLOCKS))).persist()
    random, some = np.random.default_rng(seed), math.ceil(math.sqrt(inputs.places))
    trees = [Tree.empty(depth) for _ in range(forest.getNumTrees())]
    opened = [np.zeros(1, dtype=np.int64) for _ in trees]
    try:
        for level in range(depth):
            wanted = [
                Wanted(tree, nodes, np.array([np.sort(random.choice(inputs.places, some, replace=False)) for _ in nodes]))
                for tree, nodes in zip(trees, opened, strict=True)
            ]
            for tree, sums in _level_sums(blocks, inputs, wanted, level, seed).items():
                opened[tree] = split_open(wanted[tree], sums, inputs, level + 1 == depth)
            if not any(len(nodes) for nodes in opened):
                break
    finally:
        blocks.unpersist()
    for tree in trees:
        merge_leaves(tree)
    return _as_model(spark, forest, trees, inputs.places)


def _level_sums(blocks: DataFrame, inputs: Inputs, wanted: list[Wanted], level: int, seed: int) -> dict[int, np.ndarray]:
    """The counts of a level over all blocks, by tree. Each task sends a row a tree, which meet by tree."""
    told = blocks.sparkSession.sparkContext.broadcast((inputs, wanted, draw_counts()))
    try:
        counted = blocks.mapInArrow(lambda batches: _counted(*told.value, level, seed, batches), _SUMS)
        added = counted.repartition(min(len(wanted), 16), "tree").mapInArrow(_added, _SUMS)
        return {row["tree"]: np.frombuffer(row["sums"]) for row in added.collect()}
    finally:
        told.unpersist()
