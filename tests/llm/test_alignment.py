import hashlib
import random
from collections import Counter, defaultdict
from itertools import product

import llm_frames
import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from txnrisk.llm import alignment, bytes_bpe, queries

A_PATH, B_PATH = alignment.default_paths()
NO_TOKENS = (0, 0, 0, 0)


class Libraries:
    def __init__(self):
        self.a = Tokenizer.from_file(A_PATH)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
        self.marks = {mark: byte for byte, mark in bytes_bpe._MARKS.items()}

    def a_bytes(self, number):
        return bytes(self.marks[c] for c in self.a.id_to_token(number))

    def b_bytes(self, number):
        piece = self.b.id_to_piece(number)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(number) else piece.replace("▁", " ").encode()

    def groups(self, text):
        """[(A ids, B ids)] by walking along both sequences."""
        if not text:
            return []
        a = self.a.encode(" " + text, add_special_tokens=False).ids
        b = self.b.encode(text)
        a_parts, b_parts = [self.a_bytes(i) for i in a], [self.b_bytes(i) for i in b]
        whole = (" " + text).encode()
        if b"".join(a_parts) != whole or b"".join(b_parts) != whole:
            return []
        found, start_a, start_b, i, j, at_a, at_b = [], 0, 0, 0, 0, 0, 0
        while i < len(a) or j < len(b):
            if at_a <= at_b:
                at_a, i = at_a + len(a_parts[i]), i + 1
            else:
                at_b, j = at_b + len(b_parts[j]), j + 1
            if at_a == at_b:
                found.append((a[start_a:i], b[start_b:j]))
                start_a, start_b = i, j
        return found


@pytest.fixture(scope="module")
def libraries():
    return Libraries()


def expected(libraries, rows):
    """One row for each (doc_id, text), and the pairs' counts."""
    found, documents, times = [], Counter(), Counter()
    for doc, text in rows:
        groups = libraries.groups(text)
        links = Counter(pair for a, b in groups for pair in product(a, b))
        documents.update(links.keys())
        times += links
        found.append((doc, groups, links))
    best = defaultdict(int)
    for (a, _), n in documents.items():
        best[a] = max(best[a], n)
    out = []
    for doc, groups, links in found:
        line = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
        out.append(
            (
                doc,
                sum(len(a) for a, _ in groups),
                sum(len(b) for _, b in groups),
                len(groups),
                sum(links.values()),
                sum(n for pair, n in links.items() if documents[pair] == best[pair[0]]),
                sum(n * documents[pair] for pair, n in links.items()),
                hashlib.sha256(line.encode()).hexdigest() if groups else "",
            )
        )
    pairs = {pair: (n, times[pair], n == best[pair[0]]) for pair, n in documents.items()}
    return sorted(out, key=str), pairs


ODD = [*llm_frames.ODD_TEXTS, "<|endoftext|>", "a <|endoftext|> b <s>", " lead", "x\n", "ﬁ ligature", "é", "tab\tend", "▁", "\r\n\r\n", "a" * 5000, "日本語" * 300]


def test_documents_and_pairs_against_loops(spark, libraries):
    draw = random.Random(2)
    texts = [None, *ODD, *list(llm_frames.texts().values())[:70]]
    rows = [(None if i == 9 else i % 90, t) for i, t in enumerate(texts + texts[5:20])]
    draw.shuffle(rows)
    docs = llm_frames.documents(spark, [t for _, t in rows], [i for i, _ in rows]).repartition(4)
    result = alignment.scored(docs, buckets=7)
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert result.columns == columns
    wanted, pairs = expected(libraries, rows)
    assert sorted(map(tuple, result.collect()), key=str) == wanted
    got = {(r.a, r.b): (r.n_docs, r.n_links, r.best) for r in alignment.pair_counts(docs, buckets=7).collect()}
    assert got == pairs


def test_small_blocks_and_steps_change_nothing(spark, libraries, monkeypatch):
    """Blocks close after few links, large groups are listed by distinct ids, buckets go to many tasks."""
    rows = list(enumerate([*ODD, *list(llm_frames.texts().values())[:25]]))
    wanted, _ = expected(libraries, rows)
    tool = alignment.aligner(alignment.default_paths())
    texts = pa.array([t for _, t in rows])
    whole = Counter()
    found = tool.align(texts)
    for text, pair, times in alignment.links(found, tool.b.n):
        times = [1] * len(pair) if times is None else times.tolist()
        for t, p, n in zip(text.tolist(), pair.tolist(), times, strict=True):
            whole[t, p] += n
    monkeypatch.setattr(alignment, "STEP_LINKS", 3)
    parts = Counter()
    for text, pair, times in alignment.links(found, tool.b.n):
        times = [1] * len(pair) if times is None else times.tolist()
        for t, p, n in zip(text.tolist(), pair.tolist(), times, strict=True):
            parts[t, p] += n
    assert whole == parts
    assert [w[4] for w in sorted(wanted)] == found.n_links.tolist()
    monkeypatch.setattr(alignment, "BLOCK_LINKS", 50)
    block = alignment.Block(3, tool.b.n, 4)
    block.add(pa.array([i for i, _ in rows]), found)
    rows_of = [r for b in block.batches(pa.int64()) for r in b.to_pylist()]
    again = Counter()
    for row in rows_of[1:]:
        postings = alignment.postings_of(row)
        assert set((postings.pair // tool.b.n % 4).tolist()) == {row["bucket"]}
        for p, d, n in zip(postings.pair.tolist(), postings.doc.tolist(), postings.times.tolist(), strict=True):
            again[d, p] += n
    assert again == whole


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 300), st.data())
def test_containers_and_planes(docs, data):
    keys = data.draw(st.sets(st.tuples(st.integers(0, 5), st.integers(0, docs - 1)), min_size=1, max_size=400))
    keys = sorted(keys)
    times = data.draw(st.lists(st.integers(1, 5000), min_size=len(keys), max_size=len(keys)))
    pair, doc = (np.array(c, dtype=np.int64) for c in zip(*keys, strict=True))
    row = alignment.Postings(docs, pair, doc, np.array(times)).columns() | {"docs": docs}
    pairs, _, _, counts = alignment._containers(row)
    assert dict(zip(pairs.tolist(), counts.tolist(), strict=True)) == Counter(pair.tolist())
    back = alignment.postings_of(row)
    assert (back.pair.tolist(), back.doc.tolist(), back.times.tolist()) == (pair.tolist(), doc.tolist(), times)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab'sé \n\t\x1f\x85 日1_.<|>Ⅷ", max_size=30), min_size=1, max_size=8))
def test_spaced_ids_are_the_librarys(texts):
    tool = alignment.SpacedEncoder(A_PATH)
    flat, borders = tool.encode(pa.array(texts))
    for text, a, b in zip(texts, borders, borders[1:], strict=False):
        assert flat[a:b].tolist() == tool._tokenizer.encode(" " + text, add_special_tokens=False).ids


def test_a_pair_in_most_documents(spark, libraries):
    rows = [(i, "the same words " * (1 + i % 3) + (f"and {i}" if i % 3 else "")) for i in range(300)]
    docs = llm_frames.documents(spark, [t for _, t in rows]).repartition(6)
    assert sorted(map(tuple, alignment.scored(docs).collect()), key=str) == expected(libraries, rows)[0]


def test_empty_table(spark):
    assert alignment.scored(llm_frames.empty_documents(spark)).count() == 0
    assert alignment.pair_counts(llm_frames.empty_documents(spark)).count() == 0


def test_query(spark, libraries):
    rows = sorted(llm_frames.texts().items())
    got = queries.queries()["op11_alignment"](spark, llm_frames.FOLDER)
    assert sorted(map(tuple, got.collect()), key=str) == expected(libraries, rows)[0]
