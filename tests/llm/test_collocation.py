import random
import re
from collections import Counter
from fractions import Fraction

import compare
import llm_frames
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from txnrisk.llm import collocation, queries, sql

FOLDED = str.maketrans({chr(c): chr(c + 32) for c in range(ord("A"), ord("Z") + 1)})


def pieces(text):
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(FOLDED)):
        yield re.findall(r"[^\x20\x09]+", piece)


def expected(rows, least=10, covered=50, most=2000):
    """By counting every phrase of every text."""
    by_lang, found = {}, []
    for text, lang in rows:
        by_lang.setdefault("und" if lang is None else lang, []).append(text)
    for lang, texts in by_lang.items():
        f, n = Counter(), 0
        for words in (w for text in texts for w in pieces(text)):
            n += len(words)
            f.update(tuple(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1))
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        ranked = []
        for p, a in candidates.items():
            around = [b for q, b in candidates.items() if len(q) > len(p) and p in (q[:2], q[1:])] if len(p) == 2 else []
            if any(100 * b >= covered * a for b in around):
                continue
            cuts = [(int(Fraction(10**6 * a * a, f[p[:k]] * f[p[k:]])), k) for k in range(1, len(p))]
            score, k = min(cuts)
            ranked.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(ranked)[:most], 1):
            found.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(found)


def found(docs, **options):
    result = collocation.phrases(docs, **options)
    assert result.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert {t for c, t in result.dtypes if c not in ("lang", "phrase")} == {"bigint"}
    return sorted(map(tuple, result.collect()))


def corpus(spark, rows):
    full = [(i, t, lang, 1, "w", 0) for i, (t, lang) in enumerate(rows)]
    schema = "doc_id long, text string, lang string, n long, word string, ID int"
    return spark.createDataFrame(full, schema).repartition(5)


def random_rows(seed=3):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["É", "straße", "Ab", "aB", "\xa0x", "\x1f", "日本"]
    weights = [1 / (i + 1) for i in range(len(words))]
    texts = []
    for _ in range(160):
        picked = draw.choices(words, weights, k=draw.randint(0, 60))
        marks = draw.choices([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", "! "], k=len(picked))
        texts.append("".join(w + m for w, m in zip(picked, marks, strict=True)))
    rows = [(t, draw.choice(["en", "de", None, "und", ""])) for t in texts]
    return rows + [(None, "en"), ("", None), (" \t", "xx"), (".,;:!?\n\x0b\x0c\r", "en"), *rows[:9]]


@pytest.mark.parametrize(
    "options",
    [
        {},
        # Many small chunks and tiles, a map in which nearly every pair seems frequent.
        {"chunk_bytes": 300, "tile_tokens": 50, "map_bits": 64},
        {"least": 3, "covered_percent": 80, "most": 7},
    ],
)
def test_phrases_against_counting(spark, options):
    rows = random_rows()
    inner = {k: v for k, v in options.items() if k in ("least", "most")} | (
        {"covered": options["covered_percent"]} if "covered_percent" in options else {}
    )
    assert found(corpus(spark, rows), **options) == expected(rows, **inner)


def test_tiles_are_added_in_groups(spark, monkeypatch):
    monkeypatch.setattr(collocation, "CHUNKS_AT_ONCE", 3)
    rows = random_rows(4)
    assert found(corpus(spark, rows), chunk_bytes=300, tile_tokens=50) == expected(rows)


def test_one_phrase_in_a_third_of_all_texts(spark):
    """Equal words on both sides overlap, and one language holds nearly everything."""
    rows = [("very very very very much", "en")] * 400 + [(f"a{i} b{i}. a{i % 3} c", "en") for i in range(600)]
    rows += [("very much", "de")] * 11
    assert found(corpus(spark, rows), tile_tokens=100) == expected(rows)


def test_no_candidates(spark):
    rows = [("one two three", "en"), ("", "de")]
    assert found(corpus(spark, rows)) == []
    assert found(corpus(spark, rows).filter("false")) == []


def test_a_long_text_is_cut_between_pieces(spark):
    text = "alpha beta gamma. " * 3000 + "delta " * 5000
    rows = [(text, "en")]
    assert found(corpus(spark, rows), chunk_bytes=1000) == expected(rows)
    folded = text.encode().translate(collocation._FOLDED)
    parts = list(collocation._cut(folded, 1000))
    assert b"".join(parts) == folded and len(parts) > 40
    assert all(p.startswith(b"\n") for p in parts[1:])


@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30), st.integers(1, 5)), max_size=60), st.integers(0, 2**40))
def test_sums_dense_and_sorted(cells, shift):
    totals = Counter()
    for a, b, n in cells:
        totals[a, b] += n
    for far in (0, shift):
        columns = [np.array(c, dtype=np.int64) for c in zip(*cells, strict=True)] or [np.zeros(0, np.int64)] * 3
        a, b, n = collocation.summed(columns[0] * max(far, 1), columns[1], columns[2])
        assert dict(zip(zip((a // max(far, 1)).tolist(), b.tolist(), strict=True), n.tolist(), strict=True)) == totals


@settings(max_examples=20, deadline=None)
@given(st.lists(st.tuples(*[st.integers(1, 10**13)] * 3), min_size=1, max_size=20))
def test_scores_are_exact(spark, rows):
    rows = [(min(r), *r[:2]) for r in rows]
    frame = spark.createDataFrame(rows, "a long, l long, r long")
    scores = [r.s for r in frame.select(collocation.score("a", "l", "r").alias("s")).collect()]
    assert scores == [10**6 * a * a // (left * right) for a, left, right in rows]


def test_query_against_sql(spark):
    got = compare.spark_rows(queries.queries()["op13_collocation"](spark, llm_frames.FOLDER))
    assert got == compare.sql_rows(sql.oracle_sql()["op13_collocation"], llm_frames.FOLDER)
    assert len(got[1]) > 100
