"""SentencePiece BPE with seeded merge-dropout, and its decoding.

Encoding keeps an agenda of candidate merges, the best score first, then the
leftmost. With dropout, a candidate taken from the agenda is skipped when a
keyed hash of (seed, document, position of the chunk, place, piece) falls below
the rate. The same seed gives the same ids on every machine; every occurrence of
a chunk is cut anew. A worker remembers of each chunk the cut without dropout and
the candidates that lead to it. An occurrence none of whose hashes falls below the
rate has that cut; the others, about a quarter at a rate of 0.1, are merged from the
start. Hashes and merges are worked out for many occurrences at once (``merge_batches``).

No piece of the vocabulary goes on after a space begins, so a text is cut into
chunks before the spaces, and these where two characters follow each other in no
piece; each is encoded by itself. Characters outside the
vocabulary, and the space mark itself where a text holds it, become bytes, so
decoding gives back every text exactly.

Defined results: a null text is empty and has no ids; a null id is hashed
like id 0; repeated rows get equal ids; an empty table gives an empty
result; only ``doc_id`` and ``text`` are looked at.
"""

import heapq
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnrisk.llm.merge_batches import SHORT, Labels, Merger, slices
from txnrisk.llm.tables import for_tasks, steps, with_text

RATE, SEED = 0.1, 2
#: Chunks that a worker remembers at most, but for those of the texts at hand.
REMEMBERED = 500_000
#: Text that a worker encodes at once, and occurrences that it hashes at once.
TEXT_BYTES, HASHED_AT_ONCE = 1 << 20, 1 << 16
#: The mark that stands for a space in pieces.
SPACE = "▁"
#: Stands for a space mark that is part of a text; a private character in no piece.
_STAND_IN = "\U0010fffe"
_NEVER = float("-inf")
_CHUNK = re.compile(r" *[^ \n]+| +|\n")


def default_path() -> str:
    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    """The vocabulary: scores for merging, and bytes for decoding."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(n)]
        special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(n)]
        usable = [i for i in range(n) if not special[i] and not model.is_byte(i)]
        self.ids = {names[i]: i for i in usable}
        self.scores = {names[i]: model.get_score(i) for i in usable}
        self._pairs = {name[i : i + 2] for name in self.ids for i in range(len(name) - 1)}
        self.byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.bytes = [names[i].replace(SPACE, " ").encode() for i in range(n)]
        for b, i in enumerate(self.byte_ids):
            self.bytes[i] = bytes([b])
        for i in range(n):
            if special[i]:
                self.bytes[i] = b""
        if any(SPACE in name.lstrip(SPACE) or "\n" in name[1:] or "\n" in name[:-1] for name in self.ids):
            raise ValueError("this vocabulary has pieces that go on after a space or line feed")

    def parts(self, chunk: str) -> list[str]:
        """The chunk cut between characters that follow each other in no piece; words stay whole.

        No merge crosses such a place, so the parts' ids side by side are the chunk's.
        """
        if chunk[1:].isalpha():
            return [chunk]
        marked = chunk.replace(" ", SPACE)
        pairs = self._pairs
        cuts = [i for i in range(1, len(chunk)) if marked[i - 1 : i + 1] not in pairs]
        if not cuts:
            return [chunk]
        return [chunk[a:b] for a, b in zip([0, *cuts], [*cuts, len(chunk)], strict=True)]

    def encode(
        self, chunk: str, rate: float, key: int, path: list[tuple[str, bool]] | None = None
    ) -> list[int]:
        """The ids of one chunk; a leading space is a space mark.

        ``key`` seeds the hash by which candidates are skipped. With dropout, ``path``
        gets what was hashed of each, in order, and whether it was skipped.
        """
        body = chunk.lstrip(" ")
        spaces = len(chunk) - len(body)
        # The mark as a character of the text gets a stand-in that is in no piece.
        symbols = [SPACE] * spaces + list(body.replace(SPACE, _STAND_IN))
        limit = int(rate * 2**64)
        merge = self._merged_short if len(symbols) <= SHORT else self._merged_long
        ids: list[int] = []
        for symbol in merge(symbols, limit, key, path):
            known = self.ids.get(symbol)
            if known is None:
                text = SPACE if symbol == _STAND_IN else symbol
                ids += [self.byte_ids[b] for b in text.encode()]
            else:
                ids.append(known)
        return ids

    def _merged_short(
        self, symbols: list[str], limit: int, key: int, path: list[tuple[str, bool]] | None
    ) -> list[str]:
        """The agenda as a list with a place for each neighbouring pair; its best is its maximum."""
        score, digest = self.scores.get, xxhash.xxh64_intdigest
        places = list(range(len(symbols)))
        agenda = [score(a + b, _NEVER) for a, b in zip(symbols, symbols[1:], strict=False)]
        while agenda:
            best = max(agenda)
            if best == _NEVER:
                break
            at = agenda.index(best)
            piece = symbols[at] + symbols[at + 1]
            if limit:
                label = f"{places[at]} {piece}"
                skipped = digest(label, key) < limit
                if path is not None:
                    path.append((label, skipped))
                if skipped:
                    agenda[at] = _NEVER
                    continue
            symbols[at : at + 2] = [piece]
            del places[at + 1], agenda[at]
            if at:
                agenda[at - 1] = score(symbols[at - 1] + piece, _NEVER)
            if at < len(agenda):
                agenda[at] = score(piece + symbols[at + 1], _NEVER)
        return symbols

    def _merged_long(
        self, symbols: list[str], limit: int, key: int, path: list[tuple[str, bool]] | None
    ) -> list[str]:
        """The agenda as a heap, for chunks of any length."""
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda: list[tuple[float, int, str]] = []

        def offer(left: int, right: int) -> None:
            piece = symbols[left] + symbols[right]
            score = self.scores.get(piece)
            if score is not None:
                heapq.heappush(agenda, (-score, left, piece))

        for i in range(n - 1):
            offer(i, i + 1)
        while agenda:
            _, left, piece = heapq.heappop(agenda)
            right = after[left] if symbols[left] else n
            # Outdated: one of the two has been merged meanwhile.
            if right >= n or symbols[left] + symbols[right] != piece:
                continue
            if limit:
                label = f"{left} {piece}"
                skipped = xxhash.xxh64_intdigest(label, key) < limit
                if path is not None:
                    path.append((label, skipped))
                if skipped:
                    continue
            symbols[left], symbols[right] = piece, ""
            after[left] = after[right]
            if after[left] < n:
                before[after[left]] = left
                offer(left, after[left])
            if before[left] >= 0:
                offer(before[left], left)
        return [symbol for symbol in symbols if symbol]

    def decode(self, ids: np.ndarray) -> str:
        """The text; the space that encoding puts before it is taken off."""
        joined = b"".join(map(self.bytes.__getitem__, ids.tolist()))
        return joined.decode("utf-8", "replace")[1:]


@lru_cache(maxsize=1)
def _vocabulary(path: str) -> Pieces:
    return Pieces(path)


def _mixed(keys: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64: each bit of a key moves each bit of the result."""
    keys = (keys ^ (keys >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    keys = (keys ^ (keys >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return keys ^ (keys >> np.uint64(31))


class _Store:
    """Slices of one array, which are added in batches."""

    def __init__(self):
        self.flat, self.starts, self.counts = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, flat: np.ndarray, counts: np.ndarray) -> None:
        starts = len(self.flat) + np.cumsum(counts) - counts
        self.starts = np.concatenate([self.starts, starts])
        self.counts = np.concatenate([self.counts, counts])
        self.flat = np.concatenate([self.flat, flat], dtype=np.int32)


class _Chunks(dict):
    """Numbers of chunks: of a whole one from 0 up, of one that has several parts from -1 down.

    Parts longer than ``SHORT`` have numbers from ``LONG`` up, in ``long``, and are not remembered.
    """

    LONG = 1 << 40

    def __init__(self, pieces: Pieces):
        self._pieces = pieces
        self._whole = 0
        #: Parts of longer chunks, which are not met again by their numbers.
        self.spare = 0
        self.new: list[str] = []
        self.long: list[str] = []
        self.parts: list[list[int]] = []
        #: Of the whole chunks: symbols, ids without dropout, and its merges: piece times ``SHORT`` plus place.
        self.symbols, self.ids, self.merges = _Store(), _Store(), _Store()

    def __missing__(self, chunk: str) -> int:
        parts = self._pieces.parts(chunk)
        if len(parts) == 1:
            return self._numbered(chunk)
        self.parts.append([self[part] if part in self else self._numbered(part) for part in parts])
        number = -len(self.parts)
        if len(chunk) <= SHORT:
            self[chunk] = number
        else:
            self.spare += len(parts)
        return number

    def _numbered(self, chunk: str) -> int:
        if len(chunk) > SHORT:
            self.long.append(chunk)
            return self.LONG + len(self.long) - 1
        self.new.append(chunk)
        self[chunk] = number = self._whole
        self._whole += 1
        return number

    def learn(self, merger: Merger) -> None:
        """Merge the chunks met since without dropout."""
        if not self.new:
            return
        symbols = merger.symbols("".join(self.new))
        sizes = np.fromiter(map(len, self.new), dtype=np.int64, count=len(self.new))
        ids, counts, trace = merger.merged(symbols, np.cumsum(sizes) - sizes, sizes, None, 0)
        self.symbols.add(symbols, sizes)
        self.ids.add(ids, counts)
        rows, places, merges = (
            map(np.concatenate, zip(*trace, strict=True)) if trace else [np.zeros(0, np.int32)] * 3
        )
        order = np.argsort(rows, kind="stable")
        self.merges.add((merges * SHORT + places)[order], np.bincount(rows, minlength=len(self.new)))
        self.new = []


class Encoder:
    """Encodes texts with one seed and rate, remembering chunks."""

    def __init__(self, path: str, rate: float, seed: int):
        self.pieces = _vocabulary(path)
        self._rate, self._seed, self._limit = rate, seed, int(rate * 2**64)
        p = self.pieces
        self._merger = Merger(p.ids, p.scores, len(p.bytes), p.byte_ids, SPACE, _STAND_IN)
        self._numerals = Labels(str(i).encode() for i in range(SHORT))
        self._known = _Chunks(self.pieces)

    def _cut(self, chunk: str, key: int) -> bytes:
        """The ids of an occurrence of a chunk of any length in one part."""
        return array("i", self.pieces.encode(chunk, self._rate, key)).tobytes()

    def _keys(self, counts: np.ndarray, doc_ids: list) -> np.ndarray:
        """The key of each occurrence, by seed, document and position."""
        streams = [xxhash.xxh64_intdigest(str(i or 0), self._seed) for i in doc_ids]
        positions = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        places = positions.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return _mixed(places + np.repeat(np.array(streams, dtype=np.uint64), counts))

    def _in_parts(self, numbers: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers and keys of all occurrences' parts, and how many each occurrence has."""
        counts = np.ones(len(numbers), dtype=np.int64)
        divided = np.flatnonzero(numbers < 0)
        if not divided.size:
            return numbers, keys, counts
        parts = self._known.parts
        lists = [parts[-1 - i] for i in numbers[divided].tolist()]
        counts[divided] = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
        ends = np.cumsum(counts)
        spread = np.repeat(np.arange(len(numbers)), counts)
        numbers, keys, of_divided = numbers[spread], keys[spread], (numbers < 0)[spread]
        numbers[of_divided] = np.fromiter(chain.from_iterable(lists), dtype=np.int64)
        index = (np.arange(len(spread)) - np.repeat(ends - counts, counts))[of_divided]
        while len(self._numerals.names) <= index.max():
            self._numerals = Labels(str(i).encode() for i in range(2 * len(self._numerals.names)))
        keys[of_divided] = self._numerals.hashes(index, keys[of_divided])
        return numbers, keys, counts

    def _with_skips(self, numbers: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Which occurrences of whole chunks skip a merge of the cut without dropout."""
        known, found = self._known, np.zeros(len(numbers), dtype=bool)
        for start in range(0, len(numbers) if self._limit else 0, HASHED_AT_ONCE):
            some = numbers[start : start + HASHED_AT_ONCE]
            starts, counts = known.merges.starts[some], known.merges.counts[some]
            owner = np.repeat(np.arange(start, start + len(some)), counts)
            merges = slices(known.merges.flat, starts, counts)
            skipped = self._merger.skipped(merges % SHORT, merges // SHORT, keys[owner], self._limit)
            found[owner[skipped]] = True
        return found

    def encode_all(self, texts: list[str], doc_ids: list) -> tuple[np.ndarray, np.ndarray]:
        """Little-endian ids of all texts, each with a space before it, and where each text's ids end."""
        if len(self._known) + self._known.spare > REMEMBERED:
            self._known = _Chunks(self.pieces)
        known = self._known
        known.long = []
        cut = [_CHUNK.findall(f" {text}") if text else [] for text in texts]
        per_text = np.fromiter(map(len, cut), dtype=np.int64, count=len(cut))
        numbers = np.fromiter(map(known.__getitem__, chain.from_iterable(cut)), dtype=np.int64, count=per_text.sum())
        known.learn(self._merger)
        numbers, keys, per_chunk = self._in_parts(numbers, self._keys(per_text, doc_ids))

        starts, counts = np.empty_like(numbers), np.empty_like(numbers)
        short = np.flatnonzero(numbers < known.LONG)
        starts[short], counts[short] = known.ids.starts[numbers[short]], known.ids.counts[numbers[short]]
        again = short[self._with_skips(numbers[short], keys[short])]
        of = known.symbols
        merged, counts[again], _ = self._merger.merged(
            of.flat, of.starts[numbers[again]], of.counts[numbers[again]], keys[again], self._limit
        )
        starts[again] = len(known.ids.flat) + np.cumsum(counts[again]) - counts[again]
        long = np.flatnonzero(numbers >= known.LONG)
        cuts = [
            np.frombuffer(self._cut(known.long[number - known.LONG], key), dtype=np.int32)
            for number, key in zip(numbers[long].tolist(), keys[long].tolist(), strict=True)
        ]
        counts[long] = [len(c) for c in cuts]
        starts[long] = len(known.ids.flat) + len(merged) + np.cumsum(counts[long]) - counts[long]

        ids = slices(np.concatenate([known.ids.flat, merged, *cuts]), starts, counts).astype("<u4")
        ends = np.concatenate([[0], np.cumsum(counts)])[np.cumsum(per_chunk)] if len(per_chunk) else per_chunk
        return ids, np.concatenate([[0], ends])[np.cumsum(per_text)]

    def encode(self, text: str, doc_id: int | None) -> np.ndarray:
        """Little-endian ids of a text, which gets a space before it."""
        return self.encode_all([text], [doc_id])[0]


_encoders: dict[tuple, Encoder] = {}


def _encoder(*settings) -> Encoder:
    if settings not in _encoders:
        _encoders.clear()
        _encoders[settings] = Encoder(*settings)
    return _encoders[settings]


def encode(
    docs: DataFrame,
    model: str | None = None,
    rate: float = RATE,
    seed: int = SEED,
) -> DataFrame:
    """doc_id and ``ids``, little-endian unsigned 32-bit integers, of every row."""
    for_tasks(docs.sparkSession)
    settings = (model or default_path(), rate, seed)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = _encoder(*settings)
        for batch in steps(batches, most=TEXT_BYTES):
            names, texts = batch.column("doc_id"), batch.column("text").to_pylist()
            ids, ends = tool.encode_all(texts, names.to_pylist())
            cut = [ids[a:b].tobytes() for a, b in zip([0, *ends.tolist()], ends.tolist(), strict=False)]
            yield pa.record_batch({"doc_id": names, "ids": pa.array(cut, pa.binary())})

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return with_text(docs).mapInArrow(encoded, f"doc_id {id_type}, ids binary")


def decode(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """The rows with ``text``, decoded from ``ids``, beside the ids."""
    for_tasks(encoded.sparkSession)
    path = model or default_path()

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _vocabulary(path)
        for batch in steps(batches, "ids"):
            texts = [
                pieces.decode(np.frombuffer(ids, dtype="<u4")) if ids else ""
                for ids in batch.column("ids").to_pylist()
            ]
            yield pa.record_batch(
                {**dict(zip(batch.schema.names, batch.columns, strict=True)), "text": pa.array(texts, pa.string())}
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(decoded, f"{schema}, text string")


def digest(decoded: DataFrame) -> DataFrame:
    """Number and checksum of the ids, and the checksum of the decoded text."""
    return decoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_pieces"),
        F.crc32("ids").alias("ids_crc32"),
        F.md5("text").alias("text_md5"),
    )
