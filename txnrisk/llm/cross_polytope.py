"""Near-duplicate vectors by cross-polytope hashing.

A vector is scaled to length 1 and rotated by three rounds of random signs and
a fast Hadamard transform. Its hash is the nearest of the 2 * dim corners of the
cross-polytope: the largest component by amount, with its sign. ``CODES`` such
hashes make a key, and ``TABLES`` keys are drawn. Multiprobe: in each table a
vector is put into the bucket of its key and of the keys that come next, in
which one hash takes its second corner. Two vectors with a common bucket are
candidates, and every candidate pair's cosine is computed in double precision.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components link with nothing; equal vectors are compared once and counted each;
rows that repeat a vec_id are vectors of their own in the counts; a null id
is counted but never names a component; vectors of different length never
link; an empty table gives an empty result; only ``vec_id`` and ``embedding``
are looked at.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from txnrisk.llm import links
from txnrisk.llm.tables import for_tasks, stored

LEAST_COSINE = 0.95
TABLES, CODES, PROBES = 10, 3, 4
SEED = 9
VECTOR_ROWS = 2048


def usable(vector: Column) -> Column:
    """Neither null nor empty nor zero, and every component a finite number."""
    doubles = vector.cast("array<double>")
    finite = F.forall(doubles, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(doubles, lambda x: x != 0), F.lit(False))


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled by the largest component first, so that no square is lost."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def hadamard(rows: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of rows whose length is a power of two."""
    n, dim = rows.shape
    half = 1
    while half < dim:
        pairs = rows.reshape(n, -1, 2, half)
        rows = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2)
        half *= 2
    return rows.reshape(n, dim) / np.sqrt(dim)


def _corners(units: np.ndarray, table: int, code: int) -> tuple[np.ndarray, ...]:
    """First and second corner of each row under one rotation, and how much the second is worse."""
    n, dim = units.shape
    size = 1 << max(0, dim - 1).bit_length()
    rows = np.zeros((n, size))
    rows[:, :dim] = units
    signs = np.random.default_rng([SEED, size, table, code]).integers(0, 2, (3, size)) * 2 - 1
    for flip in signs:
        rows = hadamard(rows * flip)
    amount = np.abs(rows)
    places = np.argsort(-amount, axis=1, kind="stable")[:, :2]
    line = np.arange(n)
    first, second = places[:, 0], places[:, -1]
    corner = [2 * p + (rows[line, p] < 0) for p in (first, second)]
    return corner[0], corner[1], amount[line, first] - amount[line, second]


def buckets(units: np.ndarray, tables: int, codes: int, probes: int) -> np.ndarray:
    """The keys of each row: (rows, tables * probes), the first of each table its own key."""
    n, dim = units.shape
    base = 2 << max(0, dim - 1).bit_length()
    made = []
    for table in range(tables):
        corners = [_corners(units, table, code) for code in range(codes)]
        place = [base**code for code in range(codes)]
        own = sum(c[0].astype(np.int64) * p for c, p in zip(corners, place, strict=True))
        moves = np.stack([(c[1] - c[0]) * p for c, p in zip(corners, place, strict=True)], axis=1)
        order = np.argsort(np.stack([c[2] for c in corners], axis=1), axis=1, kind="stable")
        made.append(own)
        for probe in range(probes - 1):
            made.append(own + np.take_along_axis(moves, order[:, probe : probe + 1], axis=1)[:, 0])
    keys = np.stack(made, axis=1)
    # A key names its table too, so that one number is a bucket.
    return keys * tables + np.repeat(np.arange(tables), probes)


def _hashed(classes: DataFrame, tables: int, codes: int, probes: int) -> DataFrame:
    """The classes with ``keys``, an array of buckets."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("vec")
            sizes = np.diff(vectors.offsets.to_numpy())
            flat = vectors.flatten().to_numpy().astype(np.float64)
            starts = np.cumsum(sizes) - sizes
            for dim in np.unique(sizes):
                rows = np.flatnonzero(sizes == dim)
                matrix = flat[starts[rows, None] + np.arange(dim)]
                keys = buckets(unit(matrix), tables, codes, probes)
                yield pa.record_batch(
                    [
                        *[c.take(pa.array(rows)) for c in batch.columns],
                        pa.FixedSizeListArray.from_arrays(
                            pa.array(keys.reshape(-1)), keys.shape[1]
                        ).cast(pa.list_(pa.int64())),
                    ],
                    names=[*batch.schema.names, "keys"],
                )

    kind = classes.schema["vec"].dataType.simpleString()
    schema = f"node long, size long, vec {kind}, first long, dim int, keys array<long>"
    return classes.mapInArrow(work, schema)


def _compared(least: float):
    def pairs(block: dict[str, np.ndarray]) -> links.Edges:
        """Links of the block that no earlier bucket has: counts for each node, and a forest."""
        node, keys, part = block["node"], block["keys"], block["part"]
        units, bucket = unit(block["vec"].astype(np.float64)), block["bucket"][0]
        diagonal = block["low"][0] == block["high"][0]
        earlier = np.argmax(keys == bucket, axis=1)
        sums = np.zeros(len(node), dtype=np.int64)

        def linked(i: np.ndarray, j: np.ndarray) -> np.ndarray:
            return units[i] @ units[j].T >= least

        for at in range(0, len(node), links.STRIPE):
            i = np.arange(at, min(at + links.STRIPE, len(node)))
            near = linked(i, np.arange(len(node)))
            near[np.arange(len(i)), i] = False
            if not diagonal:
                near &= part[i, None] != part[None, :]
            rows, cols = np.nonzero(near)
            for a in range(0, len(rows), links.PART_ROWS * 16):
                r, c = rows[a : a + links.PART_ROWS * 16], cols[a : a + links.PART_ROWS * 16]
                fresh = _first_common(keys, i[r], c, bucket)
                np.add.at(sums, i[r[fresh]], block["size"][c[fresh]])
        tree = links.forest(node, linked)
        counted = np.flatnonzero(sums)
        return {
            "u": np.concatenate([tree["u"], node[counted]]),
            "v": np.concatenate([tree["v"], node[counted]]),
            "n": np.concatenate([np.zeros(len(tree["u"]), dtype=np.int64), sums[counted]]),
        }

    return pairs


def _first_common(keys: np.ndarray, i: np.ndarray, j: np.ndarray, bucket: int) -> np.ndarray:
    """Whether this bucket is the smallest that rows i and j have in common.

    Both rows' keys are sorted, so the smallest common one is found by merging.
    """
    earlier = np.zeros(len(i), dtype=bool)
    for k in range(keys.shape[1]):
        own = keys[i, k]
        below = (own < bucket) & ~earlier
        if not below.any():
            continue
        rows = np.flatnonzero(below)
        earlier[rows] = (keys[j[rows]] == own[rows, None]).any(axis=1)
    return ~earlier


def links_and_groups(
    vectors: DataFrame,
    least: float = LEAST_COSINE,
    tables: int = TABLES,
    codes: int = CODES,
    probes: int = PROBES,
) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row."""
    for_tasks(vectors.sparkSession)
    # Single precision travels as it is; tasks turn it to double, which changes no value.
    single = vectors.schema["embedding"].dataType == ArrayType(FloatType())
    vector = F.col("embedding").cast("array<float>" if single else "array<double>")
    rows = vectors.select("vec_id", F.when(usable(F.col("embedding")), vector).alias("vec"))
    # Equal vectors are one class, named by a number that storing it fixes.
    valid = rows.filter("vec is not null")
    classes = stored(
        valid.groupBy("vec")
        .agg(F.count("*").alias("size"), F.min("vec_id").cast("long").alias("first"))
        .select(
            F.monotonically_increasing_id().alias("node"),
            "size",
            "vec",
            "first",
            F.size("vec").alias("dim"),
        ),
        "classes",
    )
    hashed = stored(_hashed(classes, tables, codes, probes), "hashed")
    in_buckets = hashed.select(
        "node", "size", "vec", "dim", F.sort_array("keys").alias("keys"),
        F.explode(F.array_distinct("keys")).alias("bucket"),
    )
    slim = hashed.select("dim", F.explode(F.array_distinct("keys")).alias("bucket"))
    sizes = stored(
        slim.groupBy("dim", "bucket").agg(F.count("*").alias("n")).filter("n > 1"), "buckets"
    )
    blocks = links.in_blocks(in_buckets, sizes, ["dim", "bucket"], "node", VECTOR_ROWS // 2)
    found = stored(
        links.found(
            blocks,
            ["dim", "bucket"],
            ["node", "size", "vec", "keys", "bucket"],
            _compared(least),
            "u long, v long, n long",
        ),
        "links",
    )
    counts = found.filter("u = v").groupBy(F.col("u").alias("node")).agg(F.sum("n").alias("others"))
    roots = links.components(found.filter("u != v").select("u", "v"))
    rooted = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    per_class = stored(
        rooted.join(smallest, "root")
        .join(counts, "node", "left")
        .select(
            "vec",
            (F.coalesce("others", F.lit(0)) + F.col("size") - 1).alias("n_links"),
            "component_id",
        ),
        "groups",
    )
    return (
        rows.join(per_class, "vec", "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("component_id", F.col("vec_id").cast("long")).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
    )
