import zlib

import corpus_pipeline
import llm_frames
import numpy as np
from tokenizers import Tokenizer
from test_simhash import brute_groups, brute_print

import __spark_entry__ as driver
from txnrisk.llm import bytes_bpe


def test_registered():
    names = set(driver.queries())
    assert "pipeline" in names
    assert {n.split("_")[0] for n in names if n.startswith("op") and n[2].isdigit()} == {f"op{i}" for i in range(1, 14)}


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{llm_frames.FOLDER}/documents.parquet")
    kept = corpus_pipeline.language(spark, docs, llm_frames.FOLDER)
    assert kept.schema == docs.schema
    texts = {r.doc_id: r.text for r in kept.collect()}
    with_letters = {i for i, t in llm_frames.texts().items() if any(map(str.isalpha, t))}
    assert set(texts) == with_letters
    leaders = corpus_pipeline.near_duplicates(spark, kept, llm_frames.FOLDER)
    assert leaders.schema == docs.schema
    groups = brute_groups({i: brute_print(t) for i, t in texts.items()})
    rows = {r.doc_id: r for r in leaders.collect()}
    assert set(rows) == set(groups.values()) and all(rows[i].text == texts[i] for i in rows)
    clean = corpus_pipeline.secrets(spark, leaders, llm_frames.FOLDER)
    assert clean.schema == docs.schema
    cleaned = {r.doc_id: r for r in clean.collect()}
    assert set(cleaned) == set(rows)
    for i, row in cleaned.items():
        assert row.n_chars == len(row.text)
        assert row.text == texts[i] or "[SECRET]" in row.text
    tool = Tokenizer.from_file(bytes_bpe.default_path())
    pieces = {}
    for r in corpus_pipeline.packing(spark, clean, llm_frames.FOLDER).collect():
        pieces.setdefault(r.doc_id, []).append((r.start, np.frombuffer(r.ids, "<u4").tolist()))
    assert set(pieces) == set(cleaned)
    for i, parts in pieces.items():
        ids = [x for _, p in sorted(parts) for x in p]
        assert ids == [*tool.encode(cleaned[i].text, add_special_tokens=False).ids, 0]


def test_run(spark):
    rows = corpus_pipeline.run(spark, llm_frames.FOLDER).collect()
    assert rows and all(len(r.ids) == 4 * r.length for r in rows)
    assert len({zlib.crc32(bytes(r.ids)) for r in rows}) > 100


def test_empty_and_clashing_columns(spark):
    docs = llm_frames.documents(spark, ["the and of", None], [1, None])
    for frame in (docs, docs.filter("false")):
        now = frame
        for name, stage in corpus_pipeline.STAGES:
            now = stage(spark, now, "")
            if name != "packing":
                assert now.columns == docs.columns
        assert now.count() == 0
