"""Byte-level BPE ids of many texts, with the tokenizers library.

The library's pre-tokenizer always cuts before a space between two other
characters. So a text is cut at such spaces, the distinct chunks of a batch are
encoded once, and a text's ids are put together from its chunks' by numpy. The
library splits each new chunk and merges each new piece; both are remembered.
Texts in which a space lies next to white space or control characters are split
by the library whole, and texts that hold an added token, such as
``<|endoftext|>``, are encoded by it whole. The ids are those that the library
gives for whole texts, the added tokens' own ids included.
"""

import re
from array import array
from collections.abc import Callable

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc

#: Words and other pieces that the younger half of a memory holds. A worker keeps these from task to task.
REMEMBERED, REMEMBERED_PIECES = 200_000, 40_000
#: Fixed value: the id that ends a document.
END_ID = 0

#: Letters below this have been letters in every version of Unicode.
_PLAIN_END = "\u0180"


def _byte_marks() -> dict[int, str]:
    """The character that stands for each byte: printable ones for themselves, the rest from 256 on."""
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in kept]
    return {b: chr(b) for b in kept} | {b: chr(256 + i) for i, b in enumerate(others)}


_MARKS = _byte_marks()
_SPACE_MARK, _LINE_MARK = _MARKS[0x20], _MARKS[0x0A]


def _plain(text: str) -> bool:
    return text.isascii() or max(text) < _PLAIN_END


def _marked(piece: str) -> str:
    """The bytes of a piece as the characters that stand for them."""
    return piece.encode().decode("latin-1").translate(_MARKS)


#: ASCII letters, symbols but the apostrophe, and line feeds.
_SIMPLE = re.compile(r"[!-&(-/:-~\n]+")
_PARTS = re.compile(rf"[A-Za-z]+|{_LINE_MARK}|[!-&(-/:-@\[-`{{-~]+")


#: Visible ASCII characters, as most chunks begin and end.
_VISIBLE = frozenset(map(chr, range(0x21, 0x7F)))


def _odd(char: str) -> bool:
    """White space or a control character."""
    return char <= " " or "\x7f" <= char <= "\xa0" or char.isspace()


def _odd_ends(chunk: str) -> bool:
    """Whether a chunk is empty or begins or ends with an odd character."""
    if not chunk:
        return True
    first, last = chunk[0], chunk[-1]
    return not (first in _VISIBLE and last in _VISIBLE) and (_odd(first) or _odd(last))


def _strings(chunks: pa.StringArray) -> list[str]:
    """Strings without a space as Python's: one long string cut again is quicker than one object at a time."""
    if not len(chunks):
        return []
    whole = pa.LargeListArray.from_arrays(pa.array([0, len(chunks)], pa.int64()), chunks)
    return pc.binary_join(whole, " ")[0].as_py().split(" ")


def default_path() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


class Memory:
    """What a function gave for its latest arguments: two halves, of which the older is dropped."""

    def __init__(self, function: Callable[[str], bytes], entries: int = REMEMBERED):
        self._function, self._entries = function, entries
        self._young: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}

    def __call__(self, key: str) -> bytes:
        value = self._young.get(key)
        return self._fetch(key) if value is None else value

    def recent(self) -> Callable[[str], bytes | None]:
        """A quick look into the younger half as it is now; None for what it lacks."""
        return self._young.get

    def _fetch(self, key: str) -> bytes:
        value = self._old.get(key)
        if value is None:
            value = self._function(key)
        if len(self._young) >= self._entries:
            self._old, self._young = self._young, {}
        self._young[key] = value
        return value


class Encoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._added = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        # These two know no added tokens.
        self._split = self._tokenizer.pre_tokenizer.pre_tokenize_str
        self._model = self._tokenizer.model
        self.n_ids = self._tokenizer.get_vocab_size()
        self._piece = Memory(self._ids_of_piece, REMEMBERED_PIECES)
        self._word = Memory(self._ids_of_word)
        self._tails = {mark: self._ids_of_chunk(mark) for mark in ".,"}

    def _ids_of_piece(self, piece: str) -> bytes:
        return array("I", [t.id for t in self._model.tokenize(piece)]).tobytes()

    def _ids_of_chunk(self, chunk: str) -> bytes:
        return b"".join([self._piece(piece) for piece, _ in self._split(chunk)])

    def _ids_of_word(self, word: str) -> bytes:
        """A space and letters: one piece, if they are letters in every version of Unicode."""
        if word.isascii():
            return self._ids_of_piece(_SPACE_MARK + word)
        if not _plain(word):
            return self._ids_of_chunk(f" {word}")
        return self._ids_of_piece(_marked(f" {word}"))

    def _ids_after_space(self, chunk: str) -> bytes:
        """Words are remembered without a comma or full stop behind them."""
        if chunk.isalpha():
            return self._word(chunk)
        tail = self._tails.get(chunk[-1])
        if tail and chunk[:-1].isalpha() and _plain(chunk):
            return self._word(chunk[:-1]) + tail
        if _SIMPLE.fullmatch(chunk) and "\n\n" not in chunk:
            # Words, single line feeds and symbols, each a piece; symbols after the space take it along.
            # Letters and symbols stand for themselves.
            first, *others = _PARTS.findall(chunk.replace("\n", _LINE_MARK))
            start = self._word(first) if first.isalpha() else self._piece(_SPACE_MARK + first)
            known, other = self._piece.recent(), self._piece
            return start + b"".join([known(p) or other(p) for p in others])
        return self._ids_of_chunk(f" {chunk}")

    def ids(self, text: str) -> np.ndarray:
        """The ids of one text, split by the library whole."""
        return np.frombuffer(self._ids_of_chunk(text), dtype="<u4") if text else _NONE

    def _ids_by_library(self, text: str) -> bytes:
        return array("I", self._tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _with_added(self, texts: pa.Array, words: pa.DictionaryArray, first: np.ndarray) -> np.ndarray:
        """Which texts hold an added token; one without a space is looked for in the distinct chunks."""
        found = np.zeros(len(texts), dtype=bool)
        for token in self._added:
            if " " in token:
                found |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
                continue
            held = pc.match_substring(words.dictionary, token).to_numpy(zero_copy_only=False)
            if held.any():
                found |= np.logical_or.reduceat(held[words.indices.to_numpy()], first)
        return found

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids in a row, and where each text begins, with the end of the last."""
        lists = pc.split_pattern(texts, " ")
        ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        words = lists.flatten().dictionary_encode()
        if not len(words):
            return _NONE, np.zeros(len(texts) + 1, dtype=np.int64)
        at, distinct = words.indices.to_numpy(), _strings(words.dictionary)
        odd = [not w.isalpha() and _odd_ends(w) for w in distinct]
        first, chunks = ends[:-1], np.diff(ends)
        # A text of one chunk is encoded as it is, whatever its ends.
        odd_text = np.logical_or.reduceat(np.array(odd)[at], first) & (chunks > 1)
        added = self._with_added(texts, words, first)
        odd_text |= added
        inner = np.repeat(~odd_text, chunks)
        inner[first] = False
        known, other = self._word.recent(), self._ids_after_space
        parts = [b"" if o else known(w) or other(w) for w, o in zip(distinct, odd, strict=True)]
        place = np.where(inner, at, -1)
        place[first] = np.arange(len(parts), len(parts) + len(first))
        for i, (word, whole) in enumerate(zip(at[first].tolist(), odd_text.tolist(), strict=True)):
            parts.append(self._ids_of_chunk(texts[i].as_py() if whole else distinct[word]))
        for i in np.flatnonzero(added).tolist():
            parts[len(distinct) + i] = self._ids_by_library(texts[i].as_py())
        return _gathered(parts, place[place >= 0], np.where(odd_text, 1, chunks))


_NONE = np.zeros(0, dtype="<u4")


def _gathered(
    parts: list[bytes], place: np.ndarray, counts: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The parts named by ``place`` end to end, and the border of each run of ``counts`` parts."""
    table = np.frombuffer(b"".join(parts), dtype="<u4")
    sizes = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) // 4
    starts = np.cumsum(sizes) - sizes
    lengths = sizes[place]
    ends = np.cumsum(lengths)
    # One number for each id: half the width where it suffices.
    width = np.int32 if max(len(table), ends[-1]) < 1 << 31 else np.int64
    at = np.repeat((starts[place] - ends + lengths).astype(width), lengths)
    at += np.arange(ends[-1], dtype=width)
    ids = table[at]
    borders = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
    return ids, borders


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One for each worker process and file, so that what it remembers serves later tasks."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
