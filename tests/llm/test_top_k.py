import math
import random

import llm_frames
import pytest
from pyspark.sql import functions as F

from txnrisk.llm import queries, top_k

SCHEMA = "vec_id long, embedding array<double>, label int, norm int, block int, least string"


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, 0, 0, 0, "") for i, v in vectors], SCHEMA)


def brute(vectors, every, k=10, scale=1024):
    valid = {}
    for i, v in vectors:
        if v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        valid[i] = min(v, valid.get(i, v))
    whole = {i: [math.floor(scale * x) for x in v] for i, v in valid.items()}
    rows = []
    for q in whole:
        if q is None or q % every:
            continue
        scored = [
            (-sum(a * b for a, b in zip(whole[q], x, strict=False)), i is not None, i or 0, i)
            for i, x in whole.items()
            if i != q
        ]
        rows += [(q, r + 1, s[3], -s[0]) for r, s in enumerate(sorted(scored)[:k])]
    return sorted(rows, key=str)


def found(spark, vectors, every, **settings):
    result = top_k.search(frame(spark, vectors), F.col("vec_id") % every == 0, **settings)
    return sorted((tuple(r) for r in result.collect()), key=str)


def cloud(n, dim, seed, spread=1.0):
    rng = random.Random(seed)
    return [(i, [rng.gauss(0, 1) * spread ** rng.random() for _ in range(dim)]) for i in range(n)]


@pytest.mark.parametrize("spread", [1.0, 20.0])
@pytest.mark.parametrize("blocks", [(8192, 1024, 1024), (64, 8, 16)])
def test_as_brute_force(spark, monkeypatch, spread, blocks):
    for name, value in zip(("BLOCK_ROWS", "QUERY_ROWS", "SLICE_ROWS"), blocks, strict=True):
        monkeypatch.setattr(top_k, name, value)
    vectors = cloud(400, 12, 1, spread)
    assert found(spark, vectors, 20) == brute(vectors, 20)


def test_ties_repeats_nulls_and_short_vectors(spark):
    odd = [
        (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (None, [0.5, 0.5]),
        (5, []), (6, [0.5]), (10, [0.5, 0.5]), (11, [0.5, 0.5]), (12, [0.5, 0.5]), (12, [0.25, 0.5]),
        (20, [0.0, 0.0]), (30, [-0.5, 1e-9]), (30, [-0.5, 1e-9]),
    ]
    assert found(spark, odd, 10) == brute(odd, 10)
    assert found(spark, odd, 10, k=2) == brute(odd, 10, 2)


def test_fewer_rows_than_asked_and_none(spark):
    assert found(spark, [(0, [1.0])], 10) == []
    assert found(spark, [], 10) == []
    assert found(spark, [(1, [1.0]), (2, [2.0])], 10) == []
    assert found(spark, [(0, [1.0]), (2, [2.0])], 10) == [(0, 1, 2, 2 * 1024 * 1024)]


def test_products_beyond_64_bits_are_refused(spark):
    with pytest.raises(Exception, match="64 bits"):
        found(spark, [(0, [1e12]), (1, [1e12])], 10)


def test_pruning_leaves_vectors_out(monkeypatch):
    """Of vectors with falling lengths, most are never scored."""
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(1)
    x = np.floor(rng.normal(size=(5000, 8)) * 1000 / np.arange(1, 5001)[:, None])
    norm = np.linalg.norm(x, axis=1)
    block = pa.table({"vec_id": np.arange(5000), "x": list(x), "norm": norm})
    asked = pa.table(
        {"vec_id": np.arange(5), "x": list(x[:5]), "norm": norm[:5], "least": np.full(5, -np.inf)}
    )
    scored = []
    add = top_k._Best.add
    monkeypatch.setattr(top_k._Best, "add", lambda self, q, *r: (scored.append(len(q)), add(self, q, *r)))
    best = top_k._search(asked, block, np.eye(8), 4, 10)
    assert len(best.top()[0]) == 50
    assert sum(scored) < 5 * 5000 / 3


def test_query(spark):
    rows = sorted((tuple(r) for r in queries.nearest(spark, llm_frames.FOLDER).collect()), key=str)
    vectors = [(r[0], r[1]) for r in llm_frames.table("embeddings")]
    assert rows == brute(vectors, 100)
