"""Links between rows that share a bucket, and the groups that links make.

A bucket may hold any share of the rows. It is cut into parts of a bounded
number of rows, and each two of its parts meet in one block, so every pair of
the bucket is compared in some task, no task holds more than two parts, and
nothing is left out. A block gives a spanning forest of its links, so what
leaves it grows with its rows and not with its pairs.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnrisk.llm.tables import for_tasks, stored

#: Rows of a bucket's part; a block has two parts at most.
PART_ROWS = 1024
#: Rows that are compared with a whole block at once.
STRIPE = 256

Edges = dict[str, np.ndarray]


def in_blocks(
    rows: DataFrame, sizes: DataFrame, key: list[str], node: str, part_rows: int = PART_ROWS
) -> DataFrame:
    """The rows of buckets named in ``sizes`` (key, n), each once for each block it is in.

    Adds ``part`` and the block's two parts ``low`` and ``high``. A bucket of up
    to ``part_rows`` rows is one block. ``sizes`` should be a stored table, so
    that Spark can broadcast it if it is small and else split skewed keys.
    """
    parts = F.ceil(F.col("n") / part_rows).cast("int")
    part = F.pmod(F.xxhash64(node, F.lit(7)), parts).cast("int")
    others = F.sequence(F.lit(0), F.col("parts") - 1)

    def block(other: Column) -> Column:
        return F.struct(
            F.least("part", other).alias("low"), F.greatest("part", other).alias("high")
        )

    return (
        rows.join(sizes, key)
        .withColumns({"parts": parts, "part": part})
        .withColumn("block", F.explode(F.transform(others, block)))
        .select(*rows.columns, "part", "block.low", "block.high")
    )


def found(
    blocks: DataFrame,
    key: list[str],
    columns: list[str],
    kernel: Callable[[dict[str, np.ndarray]], Edges],
    schema: str,
) -> DataFrame:
    """What the kernel makes of each block, given its columns as arrays and its ``part``."""
    for_tasks(blocks.sparkSession)
    group = [*key, "low", "high"]
    dealt = blocks.repartition(*group).sortWithinPartitions(*group)
    wanted = [*columns, "part", "low", "high"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, group):
            arrays = {name: _array(block.column(name)) for name in wanted}
            edges = kernel(arrays)
            if len(next(iter(edges.values()))):
                yield pa.record_batch(edges)

    return dealt.mapInArrow(work, schema)


def _array(column: pa.ChunkedArray) -> np.ndarray:
    """Numbers as an array, lists of one length as a matrix."""
    whole = column.combine_chunks()
    if isinstance(whole, pa.ChunkedArray):
        whole = whole.chunk(0)
    if pa.types.is_list(whole.type):
        return whole.flatten().to_numpy().reshape(len(whole), -1)
    return whole.to_numpy(zero_copy_only=False)


def _blocks(batches: Iterator[pa.RecordBatch], group: list[str]) -> Iterator[pa.Table]:
    """The sorted rows cut where the group changes; a block may come in several batches."""
    open_rows: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        codes = np.stack([batch.column(g).to_numpy().astype(np.int64) for g in group])
        cuts = np.flatnonzero((codes[:, 1:] != codes[:, :-1]).any(axis=0)) + 1
        edges = [0, *cuts.tolist(), batch.num_rows]
        if open_rows and last != tuple(codes[:, 0]):
            yield pa.Table.from_batches(open_rows)
            open_rows = []
        for a, b in zip(edges, edges[1:], strict=False):
            open_rows.append(batch.slice(a, b - a))
            if b < batch.num_rows:
                yield pa.Table.from_batches(open_rows)
                open_rows = []
        last = tuple(codes[:, -1])
    if open_rows:
        yield pa.Table.from_batches(open_rows)


def forest(nodes: np.ndarray, near: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> Edges:
    """Each node of a block with the smallest node it reaches there, where that is another.

    ``near`` says for two arrays of places which pairs are linked. Stars from
    the places not reached yet go outwards ring by ring, so each place is
    compared with the unreached ones once.
    """
    order = np.argsort(nodes, kind="stable")
    root = np.full(len(nodes), -1)
    left = order
    while len(left):
        ring, start = left[:1], left[0]
        root[start] = start
        left = left[1:]
        while len(ring) and len(left):
            hit = np.zeros(len(left), dtype=bool)
            for at in range(0, len(ring), STRIPE):
                hit |= near(ring[at : at + STRIPE], left).any(axis=0)
            ring, left = left[hit], left[~hit]
            root[ring] = start
    other = nodes != nodes[root]
    return {"u": nodes[other], "v": nodes[root][other]}


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One step: to each node's smallest neighbour, move its larger neighbours or the others."""
    if large:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    joined = both.join(stored(least, "least"), "u")
    if large:
        moved = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        moved = moved.union(least.select("u", F.col("m").alias("v")))
    return moved.filter("u > v").distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether every node has one edge to a node that has none further."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up"))
    ends = ends.union(edges.select("v", F.lit(0), F.lit(1)))
    nodes = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return nodes.filter("down > 1 or (down > 0 and up > 0)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node reachable, of all nodes with an edge (u, v).

    Alternates large stars and small stars (Kiveris and others, 2014) until
    every node points to its root. Every round is stored. Hot nodes are
    pre-aggregated, and the join spreads them.
    """
    larger, smaller = F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    now = stored(edges.select(larger, smaller).filter("u > v").distinct(), "edges")
    while not _settled(now):
        now = stored(_stars(stored(_stars(now, large=True), "large"), large=False), "small")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
