import itertools
import math

import llm_frames
import numpy as np
import pytest

from txnrisk.llm import cross_polytope, links, queries


def frame(spark, vectors):
    rows = [(i, v, 0, 0, "") for i, v in vectors]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, node int, size string")


def brute(vectors, least=0.95):
    def usable(v):
        return v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    unit = {}
    for place, (_, v) in enumerate(vectors):
        if usable(v):
            array = np.array(v) / np.abs(v).max()
            unit[place] = array / np.linalg.norm(array)
    return [
        (a, b)
        for a, b in itertools.combinations(unit, 2)
        if len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= least
    ]


def near_copies(n, dim, noise, seed):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=dim)
    return [(centre + rng.normal(size=dim) * noise).tolist() for _ in range(n)]


def test_the_transform_is_orthogonal():
    rows = np.eye(16)
    turned = cross_polytope.hadamard(rows)
    assert np.allclose(turned @ turned.T, rows)


def test_recall_and_precision_on_the_test_vectors(spark):
    """The test vectors, and of each some copies with noise, from far below the limit to above."""
    rng = np.random.default_rng(3)
    given = [(r[0], list(map(float, r[1]))) for r in llm_frames.table("embeddings", "/root/testdata/sf0.01")]
    vectors = list(given)
    for i, v in given:
        noise = rng.normal(size=(3, len(v))) * np.linalg.norm(v) * rng.uniform(0.0, 0.05, (3, 1))
        vectors += [(10_000 + 10 * i + k, (np.array(v) + n).tolist()) for k, n in enumerate(noise)]
    pairs = brute(vectors)
    result = cross_polytope.links_and_groups(frame(spark, vectors))
    rows = {r.vec_id: r for r in result.collect()}
    assert set(rows) == {i for i, _ in vectors}
    links_of = dict.fromkeys(rows, 0)
    for a, b in pairs:
        links_of[vectors[a][0]] += 1
        links_of[vectors[b][0]] += 1
    assert all(rows[i].n_links <= n for i, n in links_of.items())
    assert sum(r.n_links for r in rows.values()) >= 0.95 * 2 * len(pairs) > 0
    for r in rows.values():
        assert r.kept == (r.vec_id == r.component_id) and r.component_id <= r.vec_id


def test_planted_pairs_at_the_limit(spark):
    """Pairs of cosine just above 0.95, the hardest ones, are found nine times in ten."""
    rng = np.random.default_rng(5)
    vectors = []
    for i in range(400):
        a = rng.normal(size=64)
        a /= np.linalg.norm(a)
        b = rng.normal(size=64)
        b -= (b @ a) * a
        b /= np.linalg.norm(b)
        vectors += [(2 * i, a.tolist()), (2 * i + 1, (0.952 * a + math.sqrt(1 - 0.952**2) * b).tolist())]
    rows = cross_polytope.links_and_groups(frame(spark, vectors)).collect()
    assert sum(r.n_links for r in rows) >= 0.9 * 800


@pytest.mark.parametrize("part_rows", [1024, 8])
def test_hot_groups_are_counted_whole(spark, monkeypatch, part_rows):
    monkeypatch.setattr(cross_polytope, "VECTOR_ROWS", 2 * part_rows)
    vectors = [(i + 10, v) for i, v in enumerate(near_copies(120, 16, 0.02, 1))]
    vectors += [(i + 500, v) for i, v in enumerate(near_copies(30, 16, 0.02, 2))]
    rows = {r.vec_id: r for r in cross_polytope.links_and_groups(frame(spark, vectors)).collect()}
    assert len(brute(vectors)) == 120 * 119 // 2 + 30 * 29 // 2
    assert {(r.n_links, r.component_id) for r in rows.values()} == {(119, 10), (29, 500)}


def test_copies_odd_vectors_and_repeats(spark):
    vectors = [
        (7, [1.0, 0.0]), (3, [2.0, 0.0]), (5, [1.0, 0.0]), (5, [1.0, 0.0]), (None, [1.0, 0.0]),
        (8, None), (9, []), (10, [0.0, 0.0]), (11, [1.0, None]), (12, [float("nan"), 1.0]),
        (13, [float("inf"), 1.0]), (14, [1.0, 0.0, 0.0]), (15, [1e200, 1e-200]), (16, [-1.0, 0.0]),
        (17, [1e-300, 0.0]), (18, [5.0]), (19, [6.0]),
    ]
    rows = cross_polytope.links_and_groups(frame(spark, vectors)).collect()
    assert len(rows) == len(vectors)
    found = {(r.vec_id, r.n_links, r.component_id, r.kept) for r in rows}
    linked = [7, 3, 5, None, 15, 17]
    expected = {(i, 6, 3, i == 3) for i in linked}
    expected |= {(i, 0, i, True) for i in (8, 9, 10, 11, 12, 13, 14, 16)}
    expected |= {(18, 1, 18, True), (19, 1, 18, False)}
    assert found == expected


def test_query(spark):
    vectors = [(r[0], r[1]) for r in llm_frames.table("embeddings")]
    rows = queries.near_vectors(spark, llm_frames.FOLDER).collect()
    assert len(rows) == len(vectors) and sum(r.n_links for r in rows) == 2 * len(brute(vectors))


def test_floats_and_empty(spark):
    one = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<float>")
    assert {r.n_links for r in cross_polytope.links_and_groups(one).collect()} == {1}
    assert cross_polytope.links_and_groups(one.filter("false")).count() == 0


def test_a_pair_counts_in_its_first_common_bucket_only():
    keys = np.array([[1, 4, 9], [4, 9, 2], [9, 1, 7]])
    i, j = np.array([0, 0, 1]), np.array([1, 2, 2])
    assert cross_polytope._first_common(keys, i, j, 9).tolist() == [False, False, True]
    assert cross_polytope._first_common(keys, i[:1], j[:1], 4).tolist() == [True]


def test_forests_keep_reachability():
    nodes = np.array([5, 1, 9, 7, 3])
    near = np.zeros((5, 5), dtype=bool)
    for a, b in ((0, 2), (2, 3), (1, 4)):
        near[a, b] = near[b, a] = True
    edges = links.forest(nodes, lambda i, j: near[np.ix_(i, j)])
    assert sorted(zip(edges["u"].tolist(), edges["v"].tolist(), strict=True)) == [(3, 1), (7, 5), (9, 5)]
