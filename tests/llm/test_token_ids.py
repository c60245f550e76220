import random
import zlib

import llm_frames
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from txnrisk.llm import bit_packing, bytes_bpe, length_packing, queries
from txnrisk.llm.tables import steps


@pytest.fixture(scope="module")
def library():
    """Untouched: strings of added tokens get these tokens' ids."""
    return Tokenizer.from_file(bytes_bpe.default_path())


def whole(library, text):
    return [*library.encode(text, add_special_tokens=False).ids, 0]


def checksum(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


@given(st.data(), st.integers(1, 32))
def test_packing_and_random_access(data, width):
    ids = data.draw(st.lists(st.integers(0, 2**width - 1), max_size=60))
    packed = bit_packing.pack(np.array(ids, dtype="<u4"), width)
    assert len(packed) == -(-len(ids) * width // 8)
    start = data.draw(st.integers(0, len(ids)))
    n = data.draw(st.integers(0, len(ids) - start))
    assert bit_packing.unpack(packed, width, start, n).tolist() == ids[start : start + n]


def test_widths():
    assert [bit_packing.width_of(n) for n in (1, 2, 3, 256, 257, 50257, 65536, 65537)] == [1, 1, 2, 8, 9, 16, 16, 17]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="ab'sé \n\t\x1f\x85\u2003日1_.<|>Ⅷ", max_size=30), min_size=1, max_size=8))
def test_ids_are_the_librarys(texts):
    tool = bytes_bpe.encoder(bytes_bpe.default_path())
    flat, borders = tool.encode(pa.array(texts))
    library = tool._tokenizer
    assert len(borders) == len(texts) + 1
    for text, a, b in zip(texts, borders, borders[1:], strict=False):
        assert flat[a:b].tolist() == library.encode(text, add_special_tokens=False).ids


def test_ascii_pieces_are_looked_up_as_they_stand(monkeypatch):
    """ASCII pieces are looked up as they stand, and lines of them are put together from these."""
    tool = bytes_bpe.Encoder(bytes_bpe.default_path())
    expected = tool._tokenizer.encode("one two.\nThree (four), five", add_special_tokens=False).ids
    monkeypatch.setattr(bytes_bpe, "_marked", None)
    flat, _ = tool.encode(pa.array(["one two.\nThree (four), five"]))
    assert flat.tolist() == expected


def test_an_encoder_loads_one_tokenizer_and_forgets_rare_pieces(monkeypatch):
    loaded = []
    real = Tokenizer.from_file
    fake = type("Fake", (), {"from_file": staticmethod(lambda path: loaded.append(path) or real(path))})
    monkeypatch.setattr("tokenizers.Tokenizer", fake)
    tool = bytes_bpe.Encoder(bytes_bpe.default_path())
    assert len(loaded) == 1 and tool._piece._entries < tool._word._entries


def test_steps_give_unused_memory_back(monkeypatch):
    released = []
    pool = type("Pool", (), {"release_unused": lambda self: released.append(1)})
    monkeypatch.setattr(pa, "default_memory_pool", pool)
    batch = pa.record_batch({"text": pa.array(["a", "b", "c"])})
    assert [b.num_rows for b in steps(iter([batch, batch]), most=1)] == [1, 1, 1] * 2
    assert len(released) == 2


END = "<|endoftext|>"


def test_added_tokens_get_their_ids(library):
    texts = [
        END, f"{END} a", f"a {END}", f"a{END}b", f"{END}{END}", f" {END}  {END} ", f"x\n{END}\ny", "<|endoftext", "|>",
        f"two words {END} and a comma, {END}.", "plain text", "", f"é{END}é", "< |endoftext|>",
    ]
    flat, borders = bytes_bpe.encoder(bytes_bpe.default_path()).encode(pa.array(texts))
    got = [flat[a:b].tolist() for a, b in zip(borders, borders[1:], strict=False)]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert got[0] == [50256] and got[4] == [50256, 50256]
    assert bytes_bpe.encoder(bytes_bpe.default_path()).encode(pa.array(texts[:1]))[0].tolist() == [50256]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.sampled_from([END, "a", " ", "  ", "b.", "\n", "é", "<|"]), max_size=8).map("".join), min_size=1, max_size=5))
def test_added_tokens_anywhere(texts):
    whole = Tokenizer.from_file(bytes_bpe.default_path())
    flat, borders = bytes_bpe.encoder(bytes_bpe.default_path()).encode(pa.array(texts))
    for text, a, b in zip(texts, borders, borders[1:], strict=False):
        assert flat[a:b].tolist() == whole.encode(text, add_special_tokens=False).ids


def test_round_trip(spark, library, tmp_path):
    texts = llm_frames.ODD_TEXTS + [None] + list(llm_frames.texts().values())[:60]
    ids = random.Random(3).sample(range(1000), len(texts))
    docs = llm_frames.documents(spark, texts, ids)
    bit_packing.write(docs, str(tmp_path / "ids"), shards=5)
    expected, start = [], 0
    for i, text in sorted(zip(ids, texts, strict=True), key=lambda p: p[0]):
        doc = whole(library, text or "")
        expected.append((i, start, len(doc), checksum(doc)))
        start += len(doc)
    back = bit_packing.read_documents(spark, str(tmp_path / "ids"))
    assert sorted(map(tuple, bit_packing.digest(back).collect())) == expected
    stream = [x for _, t in sorted(zip(ids, texts, strict=True), key=lambda p: p[0]) for x in whole(library, t or "")]
    for a, n in ((0, 10), (start - 7, 7), (start // 2, 5000), (start, 0)):
        assert bit_packing.read_range(spark, str(tmp_path / "ids"), a, n).tolist() == stream[a : a + n]
    blocks = bit_packing.read_blocks(spark, str(tmp_path / "ids")).collect()
    assert {b.width for b in blocks} == {16} and sum(b.n_ids for b in blocks) == start


def test_long_documents_make_blocks_of_their_own(spark, library, monkeypatch, tmp_path):
    texts = ["the quick brown fox " * n for n in (1, 30_000, 2, 40_000, 3)]
    bit_packing.write(llm_frames.documents(spark, texts), str(tmp_path / "ids"), shards=2)
    rows = bit_packing.digest(bit_packing.read_documents(spark, str(tmp_path / "ids"))).collect()
    assert {r.doc_id: r.ids_crc32 for r in rows} == {i: checksum(whole(library, t)) for i, t in enumerate(texts)}


def test_null_repeated_and_empty(spark, library):
    docs = llm_frames.documents(spark, ["b", "a", "a", None, "c"], [None, 2, 2, 1, None])
    rows = sorted(map(tuple, bit_packing.digest(bit_packing.round_trip(docs)).collect()), key=lambda r: r[1])
    assert [r[0] for r in rows] == [None, None, 1, 2, 2]
    assert [r[1] for r in rows] == [0, 2, 4, 5, 7]
    assert bit_packing.round_trip(llm_frames.empty_documents(spark)).count() == 0


def test_ids_query(spark, library):
    rows = queries.token_ids(spark, llm_frames.FOLDER).collect()
    found = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in rows}
    start = 0
    for i, text in sorted(llm_frames.texts().items()):
        ids = whole(library, text)
        assert found.pop(i) == (start, len(ids), checksum(ids))
        start += len(ids)
    assert not found


@pytest.mark.parametrize("longest", [1, 8, 1024])
def test_cuts(longest):
    for n in range(1, 5000, 7):
        cut = length_packing.cut(n, longest)
        assert sum(cut) == n and all(x & (x - 1) == 0 and x <= longest for x in cut)
        assert len(cut) == n // longest + (n % longest).bit_count()


def check_pieces(rows, expected):
    """Pieces by document give its ids back; expected is a list of id lists by doc_id."""
    assert len({r.sequence_id for r in rows}) == len(rows)
    by_doc = {}
    for r in rows:
        assert r.offset == 0 and r.length <= 1024 and r.length & (r.length - 1) == 0
        by_doc.setdefault(r.doc_id, []).append(r)
    assert set(by_doc) == set(expected)
    for i, ids in expected.items():
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == checksum(ids[at : at + r.length])
            at += r.length
        assert at == len(ids)


def test_packing_query(spark, library):
    expected = {i: whole(library, t) for i, t in llm_frames.texts().items()}
    check_pieces(queries.packed(spark, llm_frames.FOLDER).collect(), expected)


def test_packing_odd_texts_and_buckets(spark, library, tmp_path):
    texts = [*llm_frames.ODD_TEXTS, None, "word " * 20_000]
    docs = llm_frames.documents(spark, texts).repartition(6)
    expected = {i: whole(library, t or "") for i, t in enumerate(texts)}
    check_pieces(length_packing.digest(length_packing.bucketed(docs)).collect(), expected)
    path = tmp_path / "buckets"
    length_packing.write(length_packing.sequences(docs), str(path))
    lengths = {f"length={n}" for ids in expected.values() for n in length_packing.cut(len(ids), 1024)}
    assert {p.name for p in path.glob("length=*")} == lengths
    # Every file has one length; small lengths of many tasks lie in few files.
    rows = length_packing.read(spark, str(path)).selectExpr(
        "length", "input_file_name() AS file", "octet_length(ids) = 4 * length AS whole", "sequence_id"
    ).collect()
    assert all(r.whole and f"length={r.length}/" in r.file for r in rows)
    assert len({r.file for r in rows}) < 2 * len(lengths)
    by_file = {}
    for r in rows:
        by_file.setdefault(r.file, []).append(r.sequence_id)
    assert all(max(ids) - min(ids) == len(ids) - 1 for ids in by_file.values())


def test_packing_nulls_repeats_and_nothing(spark):
    assert length_packing.bucketed(llm_frames.empty_documents(spark)).count() == 0
    nulls = length_packing.bucketed(llm_frames.documents(spark, ["a", "a"], [None, None])).collect()
    assert len(nulls) == 2 and len({r.sequence_id for r in nulls}) == 2
    with pytest.raises(ValueError):
        length_packing.sequences(llm_frames.documents(spark, ["a"]), longest=1000)
