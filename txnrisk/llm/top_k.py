"""Exact top-k inner products of a query set against all rows.

Vectors become integers, floor(scale * x). They are rotated by the directions
of their second-moment matrix (its SVD), so that the first coordinates carry
most of a vector, and are dealt into blocks of falling length. Each block of
vectors meets each block of queries in one task, which goes through slices of
falling length and leaves a vector out only where the rotated partial sum plus
the Cauchy-Schwarz bound on the remaining coordinates cannot reach the query's
limit. The limit is the k-th best score known so far: before the main pass, that
among the longest vectors, which also leaves out whole blocks. Survivors are
scored in integers, so the result is exact.

Defined results: vectors that are null or hold null or non-finite components
take no part; an empty vector scores 0, and a shorter one counts as padded with
zeros; rows that repeat a vec_id count as one, the smallest vector; a null id
is never a query but takes part as a vector; ties go to the smaller vec_id,
null first; a query without other vectors has no rows; an empty table gives an
empty result; only ``vec_id`` and ``embedding`` are looked at. Vectors whose
products could leave 64 bits raise an error.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnrisk.llm.tables import for_tasks, stored

#: Vectors and queries of one task, and vectors looked at between two updates of the limits.
BLOCK_ROWS, QUERY_ROWS, SLICE_ROWS = 8192, 1024, 1024
#: Share of the squared length that the first coordinates should carry.
HEAD_SHARE = 0.8


def whole_numbers(vectors: DataFrame, scale: int) -> DataFrame:
    """vec_id, ``x`` (whole numbers as doubles) and ``norm``, one row for each id, in no order."""
    doubles = F.col("embedding").cast("array<double>")
    finite = F.forall(doubles, lambda v: v.isNotNull() & (F.abs(v) < float("inf")))
    valid = vectors.filter(F.coalesce(finite, F.lit(False))).select("vec_id", doubles.alias("x"))
    single = valid.groupBy("vec_id").agg(F.min("x").alias("x"))
    floored = single.select("vec_id", F.transform("x", lambda v: _floor(v * scale)).alias("x"))
    squares = F.aggregate("x", F.lit(0.0), lambda total, v: total + v * v)
    return floored.withColumn("norm", F.sqrt(squares))


def _floor(value: Column) -> Column:
    """As a double, since large values do not fit a long."""
    return F.when(F.abs(value) < 2.0**62, F.floor(value).cast("double")).otherwise(value)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Lists as rows, padded with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy()
    matrix = np.zeros((len(sizes), dim))
    matrix[np.arange(dim) < sizes[:, None]] = flat
    return matrix


def directions(vectors: DataFrame, dim: int) -> tuple[np.ndarray, int]:
    """Rotation by falling share of the squared length, and how many coordinates make the head.

    Each task adds up its rows' outer products, so ``dim`` squared numbers a
    task are summed, and as many reach the driver.
    """

    def outer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim))
        for batch in batches:
            rows = _matrix(batch.column("x"), dim)
            scaled = rows / np.maximum(1.0, np.abs(rows).max(initial=1.0))
            total += scaled.T @ scaled
        yield pa.record_batch({"at": np.arange(dim * dim), "v": total.reshape(-1)})

    sums = vectors.select("x").mapInArrow(outer, "at long, v double")
    cells = sums.groupBy("at").agg(F.sum("v").alias("v")).collect()
    moment = np.zeros(dim * dim)
    for row in cells:
        moment[row["at"]] = row["v"]
    rotation, shares, _ = np.linalg.svd(moment.reshape(dim, dim), hermitian=True)
    carried = np.cumsum(shares) / max(shares.sum(), 1e-300)
    return rotation, min(dim, int(np.searchsorted(carried, HEAD_SHARE)) + 1)


def _ids(table: pa.Table, name: str = "vec_id") -> tuple[np.ndarray, np.ndarray]:
    """Ids with 0 for null, and where they are null."""
    column = table.column(name).combine_chunks()
    return column.fill_null(0).to_numpy(), column.is_null().to_numpy(zero_copy_only=False)


class _Best:
    """The k best of each query so far: by score, then the smaller id, null first."""

    def __init__(self, limits: np.ndarray, k: int):
        self.k, self.limits, self._parts = k, limits.copy(), []

    def add(self, query: np.ndarray, score: np.ndarray, ident: np.ndarray, null: np.ndarray) -> None:
        if not len(query):
            return
        self._parts.append((query, score, ident, null))
        query, score, ident, null = self.top()
        self._parts = [(query, score, ident, null)]
        full = np.flatnonzero(np.bincount(query, minlength=len(self.limits)) >= self.k)
        ends = np.searchsorted(query, full, side="right") - 1
        self.limits[full] = np.maximum(self.limits[full], score[ends])

    def top(self) -> tuple[np.ndarray, ...]:
        if not self._parts:
            return tuple(np.zeros(0, dtype=t) for t in (np.int64, np.int64, np.int64, bool))
        query, score, ident, null = map(np.concatenate, zip(*self._parts, strict=True))
        order = np.lexsort((ident, ~null, -score, query))
        query = query[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query)
        order, query = order[rank < self.k], query[rank < self.k]
        return query, score[order], ident[order], null[order]


def _search(queries: pa.Table, block: pa.Table, rotation: np.ndarray, head: int, k: int) -> _Best:
    """The best of one block of vectors for one block of queries."""
    dim = len(rotation)
    best = _Best(queries.column("least").to_numpy(), k)
    q = _matrix(queries.column("x").combine_chunks(), dim)
    own, _ = _ids(queries)
    q_norm = queries.column("norm").to_numpy()
    order = np.argsort(-block.column("norm").to_numpy(), kind="stable")
    block = block.take(pa.array(order))
    x = _matrix(block.column("x").combine_chunks(), dim)
    norm = block.column("norm").to_numpy()
    ident, null = _ids(block)
    if q_norm.max(initial=0) * norm.max(initial=0) >= 2.0**63:
        raise OverflowError("inner products do not fit 64 bits")
    whole_q, whole_x = q.astype(np.int64), x.astype(np.int64)
    turned_q, turned_x = q @ rotation, x @ rotation
    rest_q = np.linalg.norm(turned_q[:, head:], axis=1)
    rest_x = np.linalg.norm(turned_x[:, head:], axis=1)
    for at in range(0, len(x), SLICE_ROWS):
        part = slice(at, at + SLICE_ROWS)
        # Rounding in the rotated sums is far below this share of the lengths.
        slack = 1e-9 * q_norm * norm[at] + 1e-6
        open_q = np.flatnonzero(q_norm * norm[at] + slack >= best.limits)
        if not len(open_q):
            break
        bound = turned_q[open_q, :head] @ turned_x[part, :head].T
        bound += rest_q[open_q, None] * rest_x[None, part]
        a, b = np.nonzero(bound + slack[open_q, None] >= best.limits[open_q, None])
        a, b = open_q[a], b + at
        other = (ident[b] != own[a]) | null[b]
        a, b = a[other], b[other]
        for cut in range(0, len(a), 1 << 18):
            i, j = a[cut : cut + (1 << 18)], b[cut : cut + (1 << 18)]
            best.add(i, np.einsum("ij,ij->i", whole_q[i], whole_x[j]), ident[j], null[j])
    return best


def _searched(queries: DataFrame, blocks: DataFrame, rotation: np.ndarray, head: int, k: int):
    """query_id, vec_id and score: the best of each block for each query it meets."""

    def work(key, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({n: pa.array([], pa.int64()) for n in ("query_id", "vec_id", "score")})
        query, score, ident, null = _search(left, right, rotation, head, k).top()
        return pa.table(
            {
                "query_id": _ids(left)[0][query],
                "vec_id": pa.array(ident, mask=null),
                "score": score,
            }
        )

    grouped = queries.groupBy("chunk", "block").cogroup(blocks.groupBy("chunk", "block"))
    return grouped.applyInArrow(work, "query_id long, vec_id long, score long")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc_nulls_first("vec_id"))
    ranked = found.withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= k)


def search(
    vectors: DataFrame, is_query: Column, k: int = 10, scale: int = 1024
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the k best rows for each query row.

    Every query meets every block unless its limit rules the block out, so the
    work is queries times rows; it is spread over one task for each pair of blocks.
    """
    spark = vectors.sparkSession
    for_tasks(spark)
    numbers = stored(whole_numbers(vectors.withColumn("vec_id", F.col("vec_id").cast("long")), scale), "whole")
    n, dim = numbers.agg(F.count("*"), F.coalesce(F.max(F.size("x")), F.lit(0))).first()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    dim = max(dim, 1)
    rotation, head = directions(numbers, dim)
    # Lengths may all be one; the random number keeps such rows apart.
    blocks = -(-n // BLOCK_ROWS)
    dealt = numbers.withColumn("salt", F.rand(5)).repartitionByRange(blocks, F.desc("norm"), "salt")
    rows = stored(dealt.withColumn("block", F.spark_partition_id()).drop("salt"), "norm-blocks")
    longest = rows.groupBy("block").agg(F.max("norm").alias("longest"))

    asked = rows.filter(is_query & F.col("vec_id").isNotNull()).select("vec_id", "x", "norm")
    chunks = max(1, -(-asked.count() // QUERY_ROWS))
    chunk = F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(chunks)).cast("int")
    asked = stored(asked.withColumn("chunk", chunk), "queries")
    every_chunk = F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk")

    first = rows.filter("block = 0").select("vec_id", "x", "norm", "block", every_chunk)
    start = asked.withColumns({"block": F.lit(0), "least": F.lit(float("-inf"))})
    seed = stored(_best(_searched(start, first, rotation, head, k), k).drop("rank"), "seed")
    limits = seed.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("low"))
    limits = limits.filter(F.col("n") >= k).select(F.col("query_id").alias("vec_id"), "low")
    known = asked.join(limits, "vec_id", "left").withColumn(
        "least", F.coalesce(F.col("low").cast("double"), F.lit(float("-inf")))
    )
    # A block is needed by the queries whose length times its longest vector reaches their limit.
    need = F.col("norm") * F.col("longest") * (1 + 1e-9) + 1e-6 >= F.col("least")
    reach = longest.filter("block > 0").agg(F.collect_list(F.struct("block", "longest")).alias("all"))
    reach = reach.first()["all"]
    listed = F.array(*[F.struct(F.lit(b["block"]).alias("block"), F.lit(b["longest"]).alias("longest")) for b in reach])
    if not reach:
        return _shaped(seed, k)
    met = known.withColumn("b", F.explode(listed)).select(*known.columns, "b.*").filter(need)
    rest = rows.filter("block > 0").select("vec_id", "x", "norm", "block", every_chunk)
    found = _searched(met.drop("longest", "low"), rest, rotation, head, k)
    return _shaped(seed.unionByName(found), k)


def _shaped(found: DataFrame, k: int) -> DataFrame:
    return _best(found, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
