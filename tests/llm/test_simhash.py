import itertools
import random
import re

import llm_frames
import pytest
import xxhash

from txnrisk.llm import links, queries, simhash


def brute_print(text, words=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    parts = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not parts:
        return 0
    shingles = [" ".join(parts[i : i + words]) for i in range(max(1, len(parts) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints, radius=4):
    """component by place, of fingerprints by (id, place)."""
    pairs = itertools.combinations(prints, 2)
    return llm_frames.roots(list(prints), [p for p in pairs if (prints[p[0]] ^ prints[p[1]]).bit_count() <= radius])


def check(spark, texts, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    rows = simhash.groups(llm_frames.documents(spark, texts, ids)).collect()
    prints = {i: brute_print(t or "") for i, t in zip(ids, texts, strict=True)}
    assert {r.doc_id: r.fingerprint for r in rows} == {i: f"{p:016x}" for i, p in prints.items()}
    assert {r.doc_id: r.component_id for r in rows} == brute_groups(prints)
    return rows


def test_every_near_pair_shares_a_key():
    tables = simhash.masks(4)
    assert len(tables) == 31
    rng = random.Random(4)
    for n in range(5):
        for _ in range(2000):
            a = rng.getrandbits(64)
            b = a
            for bit in rng.sample(range(64), n):
                b ^= 1 << bit
            assert any(a & m == b & m for m in tables)


def test_fingerprints_and_groups_of_the_test_documents(spark):
    texts = llm_frames.texts()
    check(spark, list(texts.values()), list(texts))


def variants(n, seed=1):
    rng = random.Random(seed)
    words = [f"w{rng.randrange(500)}" for _ in range(400)]
    made = []
    for _ in range(n):
        copy = list(words)
        for _ in range(rng.randrange(6)):
            copy[rng.randrange(400)] = f"x{rng.randrange(10_000)}"
        made.append(" ".join(copy))
    return made


def test_near_copies_copies_and_odd_texts(spark):
    check(spark, variants(60) + llm_frames.ODD_TEXTS + [None, ""] + ["same words here now"] * 5)


def test_hot_buckets_are_cut_and_keep_every_link(spark, monkeypatch):
    monkeypatch.setattr(links, "PART_ROWS", 4)
    monkeypatch.setattr(links.in_blocks, "__defaults__", (4,))
    check(spark, variants(80, seed=2))


def test_every_pair_of_a_bucket_meets_in_one_block(spark):
    rows = spark.range(50).selectExpr("id as node", "id % 2 as key")
    sizes = rows.groupBy("key").count().withColumnRenamed("count", "n")
    blocks = links.in_blocks(rows, sizes, ["key"], "node", 6).collect()
    met = {}
    for b in blocks:
        met.setdefault((b.key, b.low, b.high), set()).add(b.node)
    pairs = {p for nodes in met.values() for p in itertools.combinations(sorted(nodes), 2)}
    wanted = {p for k in (0, 1) for p in itertools.combinations(range(k, 50, 2), 2)}
    assert pairs == wanted
    assert max(map(len, met.values())) <= 25


@pytest.mark.parametrize("seed", range(3))
def test_components_of_random_graphs_chains_and_stars(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)]
    edges += [(100 + i, 101 + i) for i in range(30)] + [(200, 200 + i) for i in range(1, 30)]
    frame = spark.createDataFrame(edges, "u long, v long")
    found = {r.node: r.root for r in links.components(frame).collect()}
    expected = llm_frames.roots({n for e in edges for n in e}, edges)
    assert found == {n: r for n, r in expected.items() if n != r}


def test_one_of_each_group_stays(spark):
    texts = ["a b c d e f"] * 3 + ["g h i j k l", "g h i j k l", None, "", "m n o p q", "m n o p q"]
    ids = [5, 5, 9, None, 4, None, None, None, None]
    docs = llm_frames.documents(spark, texts, ids)
    rows = simhash.one_of_each(docs).collect()
    assert simhash.one_of_each(docs).columns == docs.columns
    assert sorted((r.doc_id or -1, r.text or "") for r in rows) == [
        (-1, ""),
        (-1, "m n o p q"),
        (4, "g h i j k l"),
        (5, "a b c d e f"),
    ]


def test_one_of_each_group_stays_where_texts_share_an_id(spark):
    texts = ["a b c d e f", "g h i j k l", "g h i j k l", "m n o p q", None, "m n o p q", "r s t u v"]
    docs = llm_frames.documents(spark, texts, [1, 1, 2, 3, 3, 1, None])
    rows = simhash.one_of_each(docs).collect()
    assert sorted((r.doc_id or -1, r.text or "") for r in rows) == [
        (-1, "r s t u v"),
        (1, "a b c d e f"),
        (1, "g h i j k l"),
        (1, "m n o p q"),
        (3, ""),
    ]


def test_empty(spark):
    assert simhash.groups(llm_frames.empty_documents(spark)).count() == 0
    assert simhash.one_of_each(llm_frames.empty_documents(spark)).count() == 0


def test_query(spark):
    texts = llm_frames.texts()
    rows = queries.near_documents(spark, llm_frames.FOLDER).collect()
    prints = {i: brute_print(t) for i, t in texts.items()}
    assert {r.doc_id: r.component_id for r in rows} == brute_groups(prints)
