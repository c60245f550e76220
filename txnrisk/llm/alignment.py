"""Links between the tokens of two tokenizers, scored by how many documents hold them.

A text is encoded by a byte-level BPE (A) and a SentencePiece model (B). Byte
offsets at which tokens of both end cut the text into groups; every A token of a
group is linked with every B token of it.

For each pair of ids there is an inverted index of documents. Documents lie in
blocks; a block has one container for each pair it holds: a bitmap over the
block's documents or, where shorter, a sorted list of them. Bit planes hold how
often a document has the pair beyond once. No two blocks share a document, so
the containers of a pair are or-ed by standing side by side, and its document
count is the sum of their popcounts; its link count adds the planes' popcounts,
each at its weight. Ids of A deal the pairs into buckets, so that a bucket knows
the best count of each A id.

Counts then meet the containers again, bucket by bucket, and each container
returns its documents' scores to their block. Containers are shuffled once.
Neither a pair's containers nor a block's scores are collected: both stream
through tasks in sorted order. What a task holds is a block's documents, or the
counts of a bucket's pairs, whose number the vocabularies bound.

Defined results: a text that is null or empty, or whose joined A or B bytes are
not a space and the text (where B's normalisation changes it), has no tokens:
zeros and an empty hash; strings of special tokens are plain text; repeated rows
are documents of their own; a null id stays null; an empty table gives an empty
result; only ``doc_id`` and ``text`` are looked at.
"""

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnrisk.llm import bytes_bpe
from txnrisk.llm.tables import for_tasks, steps, stored, with_text

BUCKETS = 64
#: Links of a block before it is closed, and the most documents of one.
BLOCK_LINKS = 4_000_000
BLOCK_DOCS = 1 << 16
#: Text that is encoded, and links that are listed, at once.
STEP_BYTES = 1 << 20
STEP_LINKS = 1 << 20


def default_paths() -> tuple[str, str]:
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


class SpacedEncoder(bytes_bpe.Encoder):
    """Ids of texts with a space before them, so that a first word is like any other."""

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        lists = pc.split_pattern(texts, " ")
        ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        words = lists.flatten().dictionary_encode()
        if not len(words):
            return np.zeros(0, dtype="<u4"), np.zeros(len(texts) + 1, dtype=np.int64)
        at, distinct = words.indices.to_numpy(), bytes_bpe._strings(words.dictionary)
        odd = [not w.isalpha() and bytes_bpe._odd_ends(w) for w in distinct]
        whole = np.logical_or.reduceat(np.array(odd)[at], ends[:-1])
        counts = np.diff(ends)
        parts = [b"" if o else self._ids_after_space(w) for w, o in zip(distinct, odd, strict=True)]
        place = np.where(np.repeat(whole, counts), -1, at)
        place[ends[:-1][whole]] = np.arange(len(parts), len(parts) + whole.sum())
        parts += [self._ids_of_chunk(f" {texts[i].as_py()}") for i in np.flatnonzero(whole).tolist()]
        return bytes_bpe._gathered(parts, place[place >= 0], np.where(whole, 1, counts))


class Side:
    """One tokenizer's vocabulary: each id's bytes, and its number as text."""

    def __init__(self, pieces: list[bytes], last: str):
        self.n = len(pieces)
        self._blob = np.frombuffer(b"".join(pieces), np.uint8)
        self.sizes = np.array([len(p) for p in pieces], dtype=np.int64)
        self._starts = np.cumsum(self.sizes) - self.sizes
        self._inside, self._last = self._numbers(","), self._numbers(last)

    def _numbers(self, mark: str) -> np.ndarray:
        """Every id and a mark as 8 bytes, filled up with zeros."""
        return np.frombuffer(b"".join(f"{i}{mark}".encode().ljust(8, b"\0") for i in range(self.n)), np.uint64)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of all ids end to end."""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        shift = np.repeat(self._starts[ids] - ends + sizes, sizes)
        return self._blob[shift + np.arange(len(shift))]

    def listed(self, ids: np.ndarray, last: np.ndarray) -> np.ndarray:
        return np.where(last, self._last[ids], self._inside[ids])


@dataclass
class Aligned:
    """The groups of a batch of texts; per text: tokens of both sides, groups, links, hash."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    hashes: list[str]
    # Tokens of the texts that have any, in order, and each one's text; tokens of each group.
    a: np.ndarray
    b: np.ndarray
    text_of_group: np.ndarray
    a_in_group: np.ndarray
    b_in_group: np.ndarray


class Aligner:
    def __init__(self, a_path: str, b_path: str):
        import sentencepiece

        self._encoder = SpacedEncoder(a_path)
        self._pieces = sentencepiece.SentencePieceProcessor(model_file=b_path)
        marked = {ord(mark): byte for byte, mark in bytes_bpe._MARKS.items()}
        vocabulary = self._encoder._tokenizer.get_vocab()
        names = {number: piece.translate(marked).encode("latin-1") for piece, number in vocabulary.items()}
        self.a = Side([names.get(i, b"") for i in range(max(names) + 1)], "|")
        self.b = Side([self._piece(i) for i in range(self._pieces.get_piece_size())], ";")

    def _piece(self, number: int) -> bytes:
        piece = self._pieces.id_to_piece(number)
        if self._pieces.is_byte(number):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def align(self, texts: pa.Array) -> Aligned:
        """Texts without nulls."""
        n = len(texts)
        sizes = pc.binary_length(texts).to_numpy().astype(np.int64) + 1
        a, borders = self._encoder.encode(texts)
        a_counts = np.diff(borders)
        lists = self._pieces.encode(texts.to_pylist(), num_threads=1)
        b_counts = np.fromiter(map(len, lists), np.int64, n)
        b = np.fromiter(chain.from_iterable(lists), np.int32, int(b_counts.sum()))
        whole = sizes > 1
        for side, ids, counts in ((self.a, a, a_counts), (self.b, b, b_counts)):
            of = np.repeat(np.arange(n), counts)
            whole &= np.bincount(of, weights=side.sizes[ids], minlength=n) == sizes
        # Sizes agree; now the bytes.
        at = np.flatnonzero(whole)
        spaced = pc.binary_join_element_wise("", texts.take(pa.array(at)), " ")
        true = np.frombuffer("".join(spaced.to_pylist()).encode(), np.uint8)
        of_byte = np.repeat(at, sizes[at])
        for side, ids, counts in ((self.a, a, a_counts), (self.b, b, b_counts)):
            other = side.joined(ids[np.repeat(whole, counts)]) != true
            whole[of_byte[other]] = False
            if other.any():
                # Only the texts that fit both ways go on to the other side's check.
                kept = whole[of_byte]
                true, of_byte = true[kept], of_byte[kept]
        a, b = a[np.repeat(whole, a_counts)], b[np.repeat(whole, b_counts)]
        a_counts, b_counts = np.where(whole, a_counts, 0), np.where(whole, b_counts, 0)
        return self._grouped(a, b, a_counts, b_counts)

    def _grouped(self, a: np.ndarray, b: np.ndarray, a_counts: np.ndarray, b_counts: np.ndarray) -> Aligned:
        n = len(a_counts)
        a_ends, b_ends = np.cumsum(self.a.sizes[a]), np.cumsum(self.b.sizes[b])
        ends = np.zeros((2, int(a_ends[-1]) + 1 if len(a) else 1), dtype=bool)
        ends[0, a_ends], ends[1, b_ends] = True, True
        a_last, b_last = ends[1, a_ends], ends[0, b_ends]
        a_group, b_group = np.cumsum(a_last) - a_last, np.cumsum(b_last) - b_last
        groups = int(a_last.sum())
        a_in, b_in = np.bincount(a_group, minlength=groups), np.bincount(b_group, minlength=groups)
        text = np.repeat(np.arange(n), a_counts)[a_last]
        links = np.zeros(n, dtype=np.int64)
        np.add.at(links, text, a_in * b_in)
        # All tokens in order of groups, A before B, as their numbers in text.
        listed = np.empty(len(a) + len(b), dtype=np.uint64)
        a_done, b_done = np.cumsum(a_in), np.cumsum(b_in)
        listed[np.arange(len(a)) + (b_done - b_in)[a_group]] = self.a.listed(a, a_last)
        listed[np.arange(len(b)) + a_done[b_group]] = self.b.listed(b, b_last)
        stops = np.cumsum(a_counts + b_counts).tolist()
        hashes, start = [], 0
        for stop in stops:
            line = listed[start:stop].tobytes().translate(None, b"\0")[:-1]
            hashes.append(hashlib.sha256(line).hexdigest() if line else "")
            start = stop
        return Aligned(
            a_counts, b_counts, np.bincount(text, minlength=n), links, hashes, a, b, text, a_in, b_in
        )


def links(found: Aligned, n_b: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray | None]]:
    """(text, pair, times): links in order of texts, about ``STEP_LINKS`` at a time; a * n_b + b is a pair.

    Without ``times`` each is one link.
    """
    a_done, b_done = np.cumsum(found.a_in_group), np.cumsum(found.b_in_group)
    a_start, b_start = a_done - found.a_in_group, b_done - found.b_in_group
    sizes = found.a_in_group * found.b_in_group
    done = np.cumsum(sizes)
    first = 0
    while first < len(sizes):
        before = done[first] - sizes[first]
        last = max(first + 1, int(np.searchsorted(done, before + STEP_LINKS, side="right")))
        if sizes[first] > STEP_LINKS:
            yield from _large(found, first, a_start, b_start, n_b)
            first += 1
            continue
        part = slice(first, last)
        of = np.repeat(np.arange(first, last), found.a_in_group[part])
        times = found.b_in_group[of]
        a = np.repeat(found.a[a_start[first] : a_done[last - 1]].astype(np.int64), times)
        ends = np.cumsum(times)
        b = found.b[np.repeat(b_start[of] - ends + times, times) + np.arange(len(a))]
        yield np.repeat(found.text_of_group[of], times), a * n_b + b, None
        first = last


def _large(found: Aligned, group: int, a_start: np.ndarray, b_start: np.ndarray, n_b: int):
    """The links of one group that has very many, by its distinct ids."""
    a = found.a[a_start[group] : a_start[group] + found.a_in_group[group]]
    b = found.b[b_start[group] : b_start[group] + found.b_in_group[group]]
    a, a_times = np.unique(a.astype(np.int64), return_counts=True)
    b, b_times = np.unique(b, return_counts=True)
    step = max(1, STEP_LINKS // len(b))
    for at in range(0, len(a), step):
        part = slice(at, at + step)
        pair = (a[part, None] * n_b + b).reshape(-1)
        times = (a_times[part, None] * b_times).reshape(-1)
        yield np.full(len(pair), found.text_of_group[group]), pair, times


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(paths: tuple[str, str]) -> Aligner:
    """One for each worker process and pair of files."""
    if paths not in _aligners:
        _aligners[paths] = Aligner(*paths)
    return _aligners[paths]


def _packed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).tobytes())


def _unpacked(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


@dataclass
class Postings:
    """Some pairs' documents in one block of ``docs``: for each posting a pair, a document, times."""

    docs: int
    pair: np.ndarray
    doc: np.ndarray
    times: np.ndarray

    def columns(self) -> dict[str, bytes]:
        """As containers and planes. Postings are in order of pairs, then documents."""
        new = np.flatnonzero(np.diff(self.pair, prepend=-1))
        counts = np.diff(np.append(new, len(self.pair)))
        # A bitmap of all documents, where that is shorter than two bytes for each of them.
        dense = counts * 16 > self.docs
        of = np.repeat(np.arange(len(new)), counts)
        bits = np.zeros((int(dense.sum()), self.docs), dtype=bool)
        in_map = dense[of]
        bits[(np.cumsum(dense) - 1)[of[in_map]], self.doc[in_map]] = True
        more = self.times - 1
        planes = int(more.max()).bit_length() if len(more) else 0
        lines = [np.packbits(more >> k & 1, bitorder="little") for k in range(planes)]
        return {
            "pairs": _packed(self.pair[new].astype("<u4")),
            "sizes": _packed(np.where(dense, 0, counts).astype("<u4")),
            "lists": _packed(self.doc[~in_map].astype("<u2")),
            "maps": _packed(np.packbits(bits, axis=1, bitorder="little")),
            "planes": _packed(np.concatenate([np.zeros(0, np.uint8), *lines])),
        }


def _containers(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs, sizes of their lists (0 for a bitmap), bitmaps as rows of bytes, popcounts."""
    pairs, sizes = _unpacked(row["pairs"], "<u4").astype(np.int64), _unpacked(row["sizes"], "<u4").astype(np.int64)
    dense = sizes == 0
    maps = _unpacked(row["maps"], np.uint8).reshape(int(dense.sum()), -1) if dense.any() else np.zeros((0, 1), np.uint8)
    counts = sizes.copy()
    counts[dense] = np.bitwise_count(maps).sum(axis=1, dtype=np.int64)
    return pairs, sizes, maps, counts


def _planes(row: dict, postings: int) -> list[np.ndarray]:
    raw = _unpacked(row["planes"], np.uint8)
    return list(raw.reshape(-1, -(-postings // 8))) if len(raw) else []


def postings_of(row: dict) -> Postings:
    """Containers and planes as single postings again."""
    pairs, sizes, maps, counts = _containers(row)
    dense = sizes == 0
    of = np.repeat(np.arange(len(pairs)), counts)
    doc, in_map = np.empty(len(of), dtype=np.int64), dense[of]
    doc[~in_map] = _unpacked(row["lists"], "<u2")
    doc[in_map] = np.nonzero(np.unpackbits(maps, axis=1, count=row["docs"], bitorder="little"))[1]
    times = np.ones(len(of), dtype=np.int64)
    for k, plane in enumerate(_planes(row, len(of))):
        times += np.unpackbits(plane, count=len(of), bitorder="little").astype(np.int64) << k
    return Postings(row["docs"], pairs[of], doc, times)


def _summed(pairs: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct pairs in order, their values added up."""
    order = np.argsort(pairs, kind="stable")
    pairs = pairs[order]
    new = np.flatnonzero(np.diff(pairs, prepend=-1))
    if not len(new):
        return (pairs, *columns)
    return (pairs[new], *(np.add.reduceat(c[order], new) for c in columns))


class Block:
    """Documents that go into one block, and their links."""

    def __init__(self, number: int, n_b: int, buckets: int):
        self.number, self._n_b, self._buckets = number, n_b, buckets
        self.docs, self.size = 0, 0
        # Single links, and links with their times.
        self._single, self._counted, self._most = [], [], BLOCK_LINKS
        self._rows: list[tuple] = []

    def add(self, ids: pa.Array, found: Aligned) -> None:
        for text, pair, times in links(found, self._n_b):
            bucket = pair // self._n_b % self._buckets
            keys = (bucket << 48) | (pair << 16) | (text + self.docs)
            if times is None:
                self._single.append(keys)
            else:
                self._counted.append((keys, times))
            self.size += len(pair)
            if self.size > self._most:
                self._merge()
                self._most = max(BLOCK_LINKS, 2 * self.size)
        self._rows.append((ids, found.n_a, found.n_b, found.n_groups, found.n_links, found.hashes))
        self.docs += len(ids)

    def _merge(self) -> None:
        """All links as distinct keys in order, with their times."""
        if self._single:
            keys, self._single = np.concatenate(self._single), []
            keys.sort()
            new = np.flatnonzero(np.diff(keys, prepend=-1))
            self._counted.append((keys[new], np.diff(np.append(new, len(keys)))))
        if len(self._counted) > 1:
            self._counted = [_summed(*(np.concatenate(c) for c in zip(*self._counted, strict=True)))]
        self.size = len(self._counted[0][0]) if self._counted else 0

    def batches(self, id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
        """A row of documents, then a row of containers for each bucket."""
        ids, *numbers, hashes = zip(*self._rows, strict=True)
        yield self._batch(
            id_type,
            ids=pa.concat_arrays(ids).to_pylist(),
            numbers=_packed(np.stack([np.concatenate(x) for x in numbers]).astype("<i8")),
            hashes=list(chain.from_iterable(hashes)),
        )
        self._merge()
        if not self.size:
            return
        keys, times = self._counted[0]
        starts = np.searchsorted(keys, np.arange(self._buckets + 1) << 48)
        for bucket, (a, b) in enumerate(zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)):
            if a < b:
                pair, doc = keys[a:b] >> 16 & 0xFFFFFFFF, keys[a:b] & 0xFFFF
                columns = Postings(self.docs, pair, doc, times[a:b]).columns()
                yield self._batch(id_type, bucket=bucket, **columns)

    def _batch(self, id_type: pa.DataType, **values: object) -> pa.RecordBatch:
        row = {"block": self.number, "docs": self.docs, **values}
        return pa.RecordBatch.from_pylist([row], schema=_block_schema(id_type))


_CONTAINERS = "pairs binary, sizes binary, lists binary, maps binary, planes binary"


def _block_schema(id_type: pa.DataType) -> pa.Schema:
    binary = [(c.split()[0], pa.binary()) for c in _CONTAINERS.split(", ")]
    return pa.schema(
        [
            ("block", pa.int64()),
            ("docs", pa.int32()),
            ("bucket", pa.int32()),
            *binary,
            ("ids", pa.list_(id_type)),
            ("numbers", pa.binary()),
            ("hashes", pa.list_(pa.string())),
        ]
    )


def index(docs: DataFrame, paths: tuple[str, str] | None = None, buckets: int = BUCKETS) -> DataFrame:
    """The documents and their inverted index, block by block, stored.

    Rows without a ``bucket`` hold a block's documents, the others the
    containers of the pairs whose A id falls into the bucket.
    """
    for_tasks(docs.sparkSession)
    paths = paths or default_paths()

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tool, number, block = aligner(paths), TaskContext.get().partitionId() << 32, None
        for batch in steps(batches, most=STEP_BYTES):
            kind = batch.column("doc_id").type
            if block and (block.size >= BLOCK_LINKS or block.docs + batch.num_rows > BLOCK_DOCS):
                yield from block.batches(kind)
                number, block = number + 1, None
            block = block or Block(number, tool.b.n, buckets)
            block.add(batch.column("doc_id"), tool.align(batch.column("text")))
        if block:
            yield from block.batches(kind)

    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"block long, docs int, bucket int, {_CONTAINERS}, ids array<{id_type}>, numbers binary,"
        " hashes array<string>"
    )
    # A smaller batch than a block's documents would cut blocks, a larger one cannot be.
    return stored(with_text(docs).mapInArrow(blocks, schema), "align-index")


#: Distinct pairs that a task keeps of one bucket before it hands them on.
HELD = 1 << 20

_COUNTS = "bucket int, pairs binary, n_docs binary, n_links binary, best binary"


def _count_rows(bucket: int, pairs: np.ndarray, docs: np.ndarray, times: np.ndarray, n_b: int) -> Iterator[pa.RecordBatch]:
    """Counts of one bucket, whose pairs are whole and in order, with the best count of each pair's A id."""
    if not len(pairs):
        return
    a = pairs // n_b
    new = np.flatnonzero(np.diff(a, prepend=-1))
    best = np.repeat(np.maximum.reduceat(docs, new), np.diff(np.append(new, len(a))))
    for at in range(0, len(pairs), HELD):
        part = slice(at, at + HELD)
        columns = (pairs[part], docs[part], times[part], best[part])
        names = ("pairs", "n_docs", "n_links", "best")
        row = {n: pa.array([_packed(c.astype("<i8"))], pa.binary()) for n, c in zip(names, columns, strict=True)}
        yield pa.record_batch({"bucket": pa.array([bucket], pa.int32()), **row})


def _counts(containers: DataFrame, n_b: int) -> DataFrame:
    """Documents and links of each pair, in rows of many pairs of one bucket.

    Tasks add up popcounts before anything is shuffled.
    """

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for row in (r for batch in batches for r in batch.to_pylist()):
            pairs, _, _, counts = _containers(row)
            postings = int(counts.sum())
            times = counts.copy()
            if len(counts):
                starts = np.cumsum(counts) - counts
                for k, plane in enumerate(_planes(row, postings)):
                    ones = np.unpackbits(plane, count=postings, bitorder="little")
                    times += np.add.reduceat(ones, starts, dtype=np.int64) << k
            parts = held.setdefault(row["bucket"], [])
            parts.append((pairs, counts, times))
            if sum(len(p[0]) for p in parts) > HELD:
                parts[:] = [merged(parts)]
                if len(parts[0][0]) > HELD // 2:
                    yield batch_of(row["bucket"], *held.pop(row["bucket"])[0])
        for bucket, parts in held.items():
            yield batch_of(bucket, *merged(parts))

    def merged(parts: list) -> tuple[np.ndarray, ...]:
        return _summed(*(np.concatenate(c) for c in zip(*parts, strict=True)))

    def batch_of(bucket: int, *columns: np.ndarray) -> pa.RecordBatch:
        names = ("pairs", "n_docs", "n_links")
        row = {n: pa.array([_packed(c.astype("<i8"))], pa.binary()) for n, c in zip(names, columns, strict=True)}
        return pa.record_batch({"bucket": pa.array([bucket], pa.int32()), **row})

    def all_of_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, parts, size, most = None, [], 0, 8 * HELD
        for row in (r for batch in batches for r in batch.to_pylist()):
            if row["bucket"] != bucket:
                if parts:
                    yield from _count_rows(bucket, *merged(parts), n_b)
                bucket, parts, size, most = row["bucket"], [], 0, 8 * HELD
            parts.append(tuple(_unpacked(row[c], "<i8") for c in ("pairs", "n_docs", "n_links")))
            size += len(parts[-1][0])
            if size > most:
                parts = [merged(parts)]
                size = len(parts[0][0])
                most = max(8 * HELD, 2 * size)
        if parts:
            yield from _count_rows(bucket, *merged(parts), n_b)

    partial = containers.mapInArrow(own, "bucket int, pairs binary, n_docs binary, n_links binary")
    parts = int(containers.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = partial.repartition(parts, "bucket").sortWithinPartitions("bucket")
    return stored(dealt.mapInArrow(all_of_bucket, _COUNTS), "align-counts")


def _scores(containers: DataFrame, counts: DataFrame, salts: int) -> DataFrame:
    """(block, at, sums, best): what each container row returns to its block's documents."""
    salt = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt")
    names = [c.split()[0] for c in _CONTAINERS.split(", ")]
    first = counts.select(F.lit(0).alias("kind"), "bucket", salt, "pairs", "n_docs", "best")
    rest = containers.select(
        F.lit(1).alias("kind"), "bucket", F.pmod(F.xxhash64("block"), F.lit(salts)).cast("int").alias("salt"), "block", "docs", *names
    )
    both = first.unionByName(rest, allowMissingColumns=True)
    parts = int(containers.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["bucket", "salt", "kind", "block"]
    dealt = both.repartition(parts, "bucket", "salt").sortWithinPartitions(*order)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts, known = None, [], None
        for row in (r for batch in batches for r in batch.to_pylist()):
            if (row["bucket"], row["salt"]) != key:
                key, parts, known = (row["bucket"], row["salt"]), [], None
            if row["kind"] == 0:
                parts.append([_unpacked(row[c], "<i8") for c in ("pairs", "n_docs", "best")])
                continue
            if known is None:
                pairs, n, best = (np.concatenate(c) for c in zip(*parts, strict=True))
                order = np.argsort(pairs)
                known, parts = (pairs[order], n[order], (n == best)[order]), []
            found = postings_of(row)
            place = np.searchsorted(known[0], found.pair)
            sums, best = np.zeros(row["docs"], np.int64), np.zeros(row["docs"], np.int64)
            np.add.at(sums, found.doc, found.times * known[1][place])
            np.add.at(best, found.doc, found.times * known[2][place])
            at = np.flatnonzero(sums)
            yield pa.record_batch(
                {
                    "block": [row["block"]],
                    "at": pa.array([_packed(at.astype("<u2"))], pa.binary()),
                    "sums": pa.array([_packed(sums[at])], pa.binary()),
                    "best": pa.array([_packed(best[at].astype("<i4"))], pa.binary()),
                }
            )

    return dealt.mapInArrow(scored, "block long, at binary, sums binary, best binary")


def _documents(rows: DataFrame, scores: DataFrame) -> DataFrame:
    """A row for each document, from its block's row and the scores returned to the block."""
    blocks = rows.filter(F.col("bucket").isNull()).select(F.lit(0).alias("kind"), "block", "ids", "numbers", "hashes")
    both = blocks.unionByName(scores.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = both.repartition(parts, "block").sortWithinPartitions("block", "kind")
    id_type = rows.schema["ids"].dataType.elementType.simpleString()

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            kind = batch.schema.field("ids").type.value_type
            for row in batch.to_pylist():
                if row["kind"] == 0:
                    if held:
                        yield out(kind, *held)
                    n = len(row["ids"])
                    held = (row, np.zeros(n, np.int64), np.zeros(n, np.int64))
                    continue
                at = _unpacked(row["at"], "<u2")
                held[1][at] += _unpacked(row["best"], "<i4")
                held[2][at] += _unpacked(row["sums"], "<i8")
        if held:
            yield out(kind, *held)

    def out(kind: pa.DataType, row: dict, best: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
        n_a, n_b, n_groups, n_links = _unpacked(row["numbers"], "<i8").reshape(4, -1)
        columns = {"n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_links, "n_best": best, "count_sum": sums}
        return pa.record_batch({"doc_id": pa.array(row["ids"], kind), **columns, "groups_sha256": row["hashes"]})

    return dealt.mapInArrow(
        documents,
        f"doc_id {id_type}, n_a long, n_b long, n_groups long, n_links long, n_best long,"
        " count_sum long, groups_sha256 string",
    )


def _piece_count(paths: tuple[str, str]) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=paths[1]).get_piece_size()


def _indexed(docs: DataFrame, paths: tuple[str, str] | None, buckets: int) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    paths = paths or default_paths()
    rows, n_b = index(docs, paths, buckets), _piece_count(paths)
    containers = rows.filter(F.col("bucket").isNotNull())
    return rows, containers, _counts(containers, n_b), n_b


def pair_counts(docs: DataFrame, paths: tuple[str, str] | None = None, buckets: int = BUCKETS) -> DataFrame:
    """(a, b, n_docs, n_links, best): every linked pair of ids; ``best``: no pair of its A id has more documents."""
    _, _, counts, n_b = _indexed(docs, paths, buckets)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for batch in batches for r in batch.to_pylist()):
            pair, n_docs, n_links, best = (_unpacked(row[c], "<i8") for c in ("pairs", "n_docs", "n_links", "best"))
            for at in range(0, len(pair), 10_000):
                part = slice(at, at + 10_000)
                yield pa.record_batch(
                    {
                        "a": (pair[part] // n_b).astype(np.int32),
                        "b": (pair[part] % n_b).astype(np.int32),
                        "n_docs": n_docs[part],
                        "n_links": n_links[part],
                        "best": (n_docs == best)[part],
                    }
                )

    return counts.mapInArrow(pairs, "a int, b int, n_docs long, n_links long, best boolean")


def scored(docs: DataFrame, paths: tuple[str, str] | None = None, buckets: int = BUCKETS, salts: int = 2) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of each document.

    ``salts`` spreads a bucket's containers over so many tasks.
    """
    rows, containers, counts, _ = _indexed(docs, paths, buckets)
    return _documents(rows, _scores(containers, counts, salts))
