import hashlib

import llm_frames
import numpy as np
import pytest
import sentencepiece

from txnrisk.llm import merge_batches, merge_dropout, queries


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=merge_dropout.default_path())


def ids_of(frame):
    return {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in frame.collect()}


TEXTS = [t for t in llm_frames.ODD_TEXTS if "▁" not in t]


def test_without_dropout_the_ids_are_the_librarys(spark, library):
    texts = TEXTS + list(llm_frames.texts().values())
    found = ids_of(merge_dropout.encode(llm_frames.documents(spark, texts), rate=0.0))
    for i, text in enumerate(texts):
        assert found[i] == library.encode(text), text[:50]


@pytest.mark.parametrize("rate", [0.1, 0.5, 1.0])
def test_decoding_gives_the_text_back(spark, library, rate):
    texts = llm_frames.ODD_TEXTS + list(llm_frames.texts().values())[:50]
    encoded = merge_dropout.encode(llm_frames.documents(spark, texts), rate=rate)
    decoded = {r.doc_id: r for r in merge_dropout.decode(encoded).collect()}
    assert [decoded[i].text for i in range(len(texts))] == texts
    for i, text in enumerate(texts):
        ids = np.frombuffer(decoded[i].ids, "<u4").tolist()
        if "▁" not in text and "\x00" not in text:
            assert library.decode(ids) == text


def test_cuts_vary_and_are_repeatable(spark, library):
    text = "internationalization of considerable importance " * 40
    docs = llm_frames.documents(spark, [text, text])
    one = ids_of(merge_dropout.encode(docs, seed=1))
    assert one == ids_of(merge_dropout.encode(docs.repartition(2), seed=1))
    plain = library.encode(text)
    assert one[0] != plain and one[1] != one[0]
    assert one[0] != ids_of(merge_dropout.encode(docs, seed=2))[0]
    assert len(one[0]) > len(plain)


def test_more_dropout_gives_more_pieces(spark):
    docs = llm_frames.documents(spark, list(llm_frames.texts().values())[:20])
    sizes = [
        sum(map(len, ids_of(merge_dropout.encode(docs, rate=rate)).values()))
        for rate in (0.0, 0.1, 0.5, 1.0)
    ]
    assert sizes == sorted(sizes) and len(set(sizes)) == 4


def test_skips_follow_the_keyed_hash():
    """A plain list of merges, the best candidate picked anew each time, gives the same ids."""
    import xxhash

    pieces = merge_dropout.Pieces(merge_dropout.default_path())

    def plain(chunk, rate, key):
        symbols = [(i, "▁" if c == " " else c) for i, c in enumerate(chunk)]
        skipped = set()
        while True:
            best = None
            for a, b in zip(symbols, symbols[1:], strict=False):
                piece = a[1] + b[1]
                score = pieces.scores.get(piece)
                if score is None or (a[0], b[0], piece) in skipped:
                    continue
                if best is None or (-score, a[0], piece) < best[:3]:
                    best = (-score, a[0], piece, a, b)
            if best is None:
                break
            _, left, piece, a, b = best
            if xxhash.xxh64_intdigest(f"{left} {piece}", key) < rate * 2**64:
                skipped.add((a[0], b[0], piece))
                continue
            at = symbols.index(a)
            symbols[at : at + 2] = [(left, piece)]
        out = []
        for _, s in symbols:
            known = pieces.ids.get(s)
            out += [known] if known is not None else [pieces.byte_ids[x] for x in s.encode()]
        return out

    for key, chunk in enumerate([" international", " considerable", " aaaaaa", "straße", "  xx", " 日本"] * 6):
        for rate in (0.0, 0.2, 0.6):
            assert pieces.encode(chunk, rate, key) == plain(chunk, rate, key), (chunk, rate)


def test_frequent_words_vary_at_the_rate():
    """A word keeps its plain cut as often as with keys of its own, not in whole quarters of all cases."""
    for seed in range(6):
        encoder = merge_dropout.Encoder(merge_dropout.default_path(), 0.1, seed)
        plain = encoder.pieces.encode(" of", 0.0, 0)
        expected = sum(encoder.pieces.encode(" of", 0.1, key) == plain for key in range(4000)) / 4000
        share = sum(encoder.encode("of", doc_id).tolist() == plain for doc_id in range(4000)) / 4000
        assert 0.85 < expected < 0.93 and abs(share - expected) < 0.03, (seed, share)


def test_a_word_gets_more_cuts_than_a_few():
    encoder = merge_dropout.Encoder(merge_dropout.default_path(), 0.1, 2)
    text = " ".join(["considerable"] * 20_000)
    names = b"|".join(encoder.pieces.bytes[i] for i in encoder.encode(text, 1)).decode()
    cuts = {c.replace("| ", "") for c in names.split("| ")}
    assert len(cuts) > 20


def test_remembered_trees_change_nothing(monkeypatch):
    """Whatever is remembered and forgotten, each occurrence gets the cut of its own key."""
    texts = list(llm_frames.texts().values())[:60] + TEXTS
    seen = []
    for remembered in (merge_dropout.REMEMBERED, 50, 0):
        monkeypatch.setattr(merge_dropout, "REMEMBERED", remembered)
        encoder = merge_dropout.Encoder(merge_dropout.default_path(), 0.3, 5)
        seen.append([encoder.encode(t, i).tolist() for _ in range(2) for i, t in enumerate(texts)])
        if not remembered:
            encoder._cut = lambda chunk, key, e=encoder: merge_dropout.array(
                "H", whole(e.pieces, chunk, 0.3, key)
            ).tobytes()
            encoder._young = {}
            seen.append([encoder.encode(t, i).tolist() for _ in range(2) for i, t in enumerate(texts)])
    assert seen[0] == seen[1] == seen[2] == seen[3]


def whole(pieces, chunk, rate, key):
    """The chunk's cut, nothing remembered."""
    import xxhash

    parts = pieces.parts(chunk)
    keys = [xxhash.xxh64_intdigest(str(i), key) for i in range(len(parts))] if len(parts) > 1 else [key]
    return [i for p, k in zip(parts, keys, strict=True) for i in pieces.encode(p, rate, k)]


@pytest.mark.parametrize("rate", [0.0, 0.1, 0.6, 1.0])
def test_occurrences_cut_at_once_are_cut_as_one_by_one(rate):
    texts = [*llm_frames.ODD_TEXTS, "日本語" * 100 + "x, y! " * 50 + "a" * 70 + "、。" * 80]
    texts += list(llm_frames.texts().values())[:40]
    encoder = merge_dropout.Encoder(merge_dropout.default_path(), rate, 5)
    ids, ends = encoder.encode_all(texts, list(range(len(texts))))
    for doc_id, (text, found) in enumerate(zip(texts, np.split(ids, ends[:-1]), strict=True)):
        chunks = merge_dropout._CHUNK.findall(f" {text}") if text else []
        keys = encoder._keys(np.array([len(chunks)]), [doc_id]).tolist()
        one_by_one = [i for c, k in zip(chunks, keys, strict=True) for i in whole(encoder.pieces, c, rate, k)]
        assert found.tolist() == one_by_one, text[:50]


def test_short_chunks_are_merged_at_once(monkeypatch):
    """No occurrence of an ordinary word is merged by itself."""
    encoder = merge_dropout.Encoder(merge_dropout.default_path(), 0.3, 5)
    monkeypatch.setattr(encoder.pieces, "encode", None)
    for doc_id, text in llm_frames.texts().items():
        words = " ".join(w for w in text.split() if len(w) < merge_batches.SHORT)
        assert bool(words) == bool(len(encoder.encode(words, doc_id)))


def test_however_many_are_merged_at_once(monkeypatch):
    texts = list(llm_frames.texts().values())[:20]
    found = []
    for at_once in (merge_batches.AT_ONCE, 7):
        monkeypatch.setattr(merge_batches, "AT_ONCE", at_once)
        monkeypatch.setattr(merge_dropout, "HASHED_AT_ONCE", at_once)
        encoder = merge_dropout.Encoder(merge_dropout.default_path(), 0.3, 5)
        found.append(encoder.encode_all(texts, list(range(len(texts))))[0].tolist())
    assert found[0] == found[1]


def test_labels_are_hashed_as_the_library_hashes_them():
    import xxhash

    names = [bytes(range(1, n + 1)) for n in range(50)]
    rows, seeds = np.arange(50).repeat(3), np.array([0, 7, 2**64 - 1] * 50, dtype=np.uint64)
    found = merge_batches.Labels(names).hashes(rows, seeds)
    pairs = zip(rows.tolist(), seeds.tolist(), strict=True)
    assert found.tolist() == [xxhash.xxh64_intdigest(names[r], s) for r, s in pairs]


def test_characters_that_are_no_pieces_and_equal_scores():
    """A vocabulary whose pieces hold characters that are none, and scores of which many are equal."""
    pieces = merge_dropout.Pieces(merge_dropout.default_path())
    pieces.ids = {n: i for n, i in pieces.ids.items() if n not in "aet"}
    pieces.scores = {n: round(s / 4000) for n, s in pieces.scores.items() if n in pieces.ids}
    merger = merge_batches.Merger(
        pieces.ids, pieces.scores, len(pieces.bytes), pieces.byte_ids, "▁", merge_dropout._STAND_IN
    )
    chunks = [" international", " considerable", " aaaaaa", " straße", "  xx", " 日本", "▁a▁", " tea"] * 20
    sizes = np.array([len(c) for c in chunks])
    keys, symbols = np.arange(len(chunks), dtype=np.uint64), merger.symbols("".join(chunks))
    for rate in (0.1, 0.5):
        ids, counts, _ = merger.merged(symbols, np.cumsum(sizes) - sizes, sizes, keys, int(rate * 2**64))
        for key, (chunk, found) in enumerate(zip(chunks, np.split(ids, np.cumsum(counts)[:-1]), strict=True)):
            assert found.tolist() == pieces.encode(chunk, rate, key), (chunk, rate)


def test_null_and_empty(spark):
    docs = llm_frames.documents(spark, [None, "", "a b"], [None, 1, None])
    rows = merge_dropout.digest(merge_dropout.decode(merge_dropout.encode(docs))).collect()
    assert sorted(r.n_pieces for r in rows) == [0, 0, 2]
    assert merge_dropout.decode(merge_dropout.encode(llm_frames.empty_documents(spark))).count() == 0


def test_query(spark):
    texts = llm_frames.texts()
    rows = queries.pieces(spark, llm_frames.FOLDER).collect()
    assert len(rows) == len(texts)
    assert {r.doc_id: r.text_md5 for r in rows} == {
        i: hashlib.md5(t.encode()).hexdigest() for i, t in texts.items()
    }
