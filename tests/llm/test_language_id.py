import math
import zlib

import llm_frames
import pyarrow as pa
import pytest

from txnrisk.llm import language_id, queries

MIDDLE = "/root/testdata/sf0.01"


def test_scores_by_hand():
    rows = [("a", 0, "the", 3, 4), ("b", 0, "le", 2, 4), ("b", 0, "the", 1, 4), ("a", 2, "th", 5, 10), ("b", 1, "z", 1, 10)]
    names = ["lang", "order", "term", "n", "total"]
    columns = [list(c) for c in zip(*rows, strict=True)]
    model = language_id.model_of(pa.table(dict(zip(names, columns, strict=True))), missing=-5.0)
    assert model.languages == ("a", "b")
    assert model.score("the").tolist() == pytest.approx([math.log10(3 / 4), math.log10(1 / 4)])
    assert model.score("le").tolist() == pytest.approx([-5, math.log10(1 / 2)])
    # Unseen: the longest order with a known n-gram decides, here 2, then 1.
    assert model.score("thz").tolist() == pytest.approx([math.log10(1 / 2), -5])
    assert model.score("zz").tolist() == pytest.approx([-5, -1])
    assert model.score("qq").tolist() == [0, 0]


def brute(model, text):
    sums = [0.0] * len(model.languages)
    words = [w for w in language_id.words_of(text) if any(c.isalpha() for c in w)]
    for word in words:
        for k, value in enumerate(model.score(word)):
            sums[k] += value * math.log(10)
    if not words or not sums:
        return "und", 0.0
    best = max(range(len(sums)), key=lambda k: (sums[k], -k))
    return model.languages[best], 1 / sum(math.exp(max(s - sums[best], -700)) for s in sums)


@pytest.fixture(scope="module")
def model(spark):
    return language_id.fit(spark.read.parquet(f"{MIDDLE}/documents.parquet"))


def test_predictions_are_the_sums_over_words(spark, model, monkeypatch):
    texts = llm_frames.ODD_TEXTS + list(llm_frames.texts().values())
    rows = {r.doc_id: r for r in language_id.predict(llm_frames.documents(spark, texts), model).collect()}
    for i, text in enumerate(texts):
        lang, score = brute(model, text)
        assert rows[i].score == pytest.approx(score, rel=1e-6, abs=1e-9)
        assert rows[i].lang_pred == lang or 0.4 < score < 0.6
    monkeypatch.setattr(language_id, "REMEMBERED", 40)
    small, large = language_id.Scorer(model), brute
    for text in texts[-40:]:
        assert small.predict(text)[1] == pytest.approx(large(model, text)[1], rel=1e-6, abs=1e-9)


def test_held_out_accuracy(spark):
    rows = queries.languages(spark, MIDDLE).collect()
    truth = {r[0]: r[2] for r in llm_frames.table("documents", MIDDLE)}
    assert {r.doc_id for r in rows} == set(truth)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
    right = [r.lang_pred == truth[r.doc_id] for r in rows if r.held_out and truth[r.doc_id]]
    assert len(right) > 100 and sum(right) / len(right) > 0.97


def test_frequencies_are_relative_to_the_language(spark):
    texts = {"x": "aa aa bb", "y": "aa cc cc cc"}
    rows = [(1, t, lang) for lang, t in texts.items()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert not docs.select(language_id.held_out()).first()[0]
    found = language_id.fit(docs, least=1)
    assert found.languages == ("x", "y")
    assert found.score("aa").tolist() == pytest.approx([math.log10(2 / 3), math.log10(1 / 4)])
    # " cc " as trigrams: " cc" and "cc ", three each of six.
    assert found.table[found.rows[3][" cc"], 1] == pytest.approx(math.log10(3 / 8))
    # What occurs once in a language is not learned there, whatever the number of terms.
    often = language_id.fit(docs)
    assert often.rows[0].keys() == {"aa", "cc"}
    assert often.score("aa").tolist() == pytest.approx([math.log10(2 / 3), -7.0])


def test_no_term_is_cut(spark):
    words = ["".join(chr(97 + i // 26**k % 26) for k in range(4)) for i in range(30_000)]
    docs = spark.createDataFrame([(1, " ".join(words * 2), "x")], "doc_id long, text string, lang string")
    assert len(language_id.fit(docs).rows[0]) == 30_000


def test_held_out_documents_teach_nothing(spark):
    held = [i for i in range(50) if zlib.crc32(str(i).encode()) % 5 == 0]
    rows = [(i, "zzz", "zz") for i in held] + [(None, "zzz", "zz"), (1, "aaa", "aa"), (2, None, "bb"), (3, "x", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert language_id.fit(docs).languages == ("aa",)


def test_nothing_learned_no_letters_and_empty(spark, model):
    texts = [None, "", "123 ... ²", "the und"]
    docs = llm_frames.documents(spark, texts, [None, 1, 2, 3])
    nothing = language_id.fit(docs)
    assert {(r.lang_pred, r.score) for r in language_id.predict(docs, nothing).collect()} == {("und", 0.0)}
    kept = language_id.accepted(docs, model).collect()
    assert [r.text for r in kept] == ["the und"] and language_id.accepted(docs, model).schema == docs.schema
    assert language_id.predict(llm_frames.empty_documents(spark), model).count() == 0
    assert language_id.fit(llm_frames.empty_documents(spark)).languages == ()


def test_a_learned_model_is_no_heap_of_objects(model):
    """What a worker loads holds few Python objects, however many terms there are."""
    import pickle
    import tracemalloc

    raw = pickle.dumps(model, 5)
    tracemalloc.start()
    loaded = pickle.loads(raw)
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert loaded.score("the").tolist() == model.score("the").tolist()
    assert sum(map(len, model.rows.values())) > 20_000 and held < 2 * len(raw)
