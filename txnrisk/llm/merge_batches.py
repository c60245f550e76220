"""Merges of many chunks at once: the agenda of ``merge_dropout`` as numpy arrays.

A column holds one chunk's symbols as whole numbers, and its candidates as numbers
that are larger for a better score and, among equal scores, further left. Each
step takes every column's largest, hashes it where candidates may be skipped, and
skips or merges it. The hash is XXH64 of the same label as the scalar code's,
worked out for all columns together.
"""

from collections.abc import Iterable

import numpy as np
import xxhash

#: Symbols up to which a chunk is merged here; also the place numbers in a candidate.
SHORT = 64
#: Chunks merged at once, so that a text of any length needs memory for so many.
AT_ONCE = 1 << 16
# Chunks are merged with those of like length, in columns of these lengths.
_WIDTHS = [0, 4, 6, 8, 10, 13, 18, 32, SHORT]
_P1, _P2, _P3, _P4, _P5 = map(
    np.uint64,
    (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5),
)


def slices(flat: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The slices of an array one after another."""
    ends = np.cumsum(counts)
    if not ends.size or not ends[-1]:
        return flat[:0]
    return flat[np.arange(ends[-1]) + np.repeat(starts - (ends - counts), counts)]


def _turned(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


class Labels:
    """XXH64 of short byte strings under many seeds; what the seed has no part in is worked out once."""

    def __init__(self, names: Iterable[bytes]):
        self.names = list(names)
        self.sizes = np.array([len(n) for n in self.names], dtype=np.uint64)
        padded = np.frombuffer(b"".join(n[:32].ljust(36, b"\0") for n in self.names), np.uint8).reshape(-1, 36)
        words = np.ascontiguousarray(padded[:, :32]).view("<u8")
        self.word = words[:, 0].copy()
        self.rounds = [_turned(words[:, j] * _P2, 31) * _P1 for j in (1, 2)]
        rows = np.arange(len(self.names))
        sizes = np.minimum(self.sizes, 31).astype(np.int64)
        four = sizes // 8 * 8
        parts = [padded[rows, four + i].astype(np.uint64) << np.uint64(8 * i) for i in range(4)]
        self.four = (parts[0] | parts[1] | parts[2] | parts[3]) * _P1
        self.ones = [padded[rows, sizes // 4 * 4 + i].astype(np.uint64) * _P5 for i in range(3)]
        self._any_long = bool((self.sizes >= 32).any())

    def hashes(self, rows: np.ndarray, seeds: np.ndarray, heads: np.ndarray | None = None) -> np.ndarray:
        """The hashes of these names; ``heads`` fills in up to the first three bytes, zeros in the names."""
        size, word = self.sizes[rows], self.word[rows]
        if heads is not None:
            word |= heads
        h = seeds + _P5 + size
        at = np.flatnonzero(size >= 8)
        h[at] = _turned(h[at] ^ (_turned(word[at] * _P2, 31) * _P1), 27) * _P1 + _P4
        for least, term in zip((16, 24), self.rounds, strict=True):
            at = np.flatnonzero(size >= least)
            if at.size:
                h[at] = _turned(h[at] ^ term[rows[at]], 27) * _P1 + _P4
        at = np.flatnonzero(size & np.uint64(4))
        first = (word[at] & np.uint64(0xFFFFFFFF)) * _P1
        term = np.where(size[at] < 8, first, self.four[rows[at]])
        h[at] = _turned(h[at] ^ term, 23) * _P2 + _P3
        ones = size & np.uint64(3)
        for i, term in enumerate(self.ones):
            at = np.flatnonzero(ones > i)
            if at.size:
                h[at] = _turned(h[at] ^ term[rows[at]], 11) * _P1
        h = (h ^ (h >> np.uint64(33))) * _P2
        h = (h ^ (h >> np.uint64(29))) * _P3
        h ^= h >> np.uint64(32)
        if self._any_long:
            for i in np.flatnonzero(size >= 32).tolist():
                name = self.names[rows[i]]
                if heads is not None:
                    head = int(heads[i]).to_bytes(8, "little").rstrip(b"\0")
                    name = head + name[len(head) :]
                h[i] = xxhash.xxh64_intdigest(name, int(seeds[i]))
        return h


class PairTable:
    """Which piece two symbols make: a hash table with open addressing."""

    def __init__(self, lefts: np.ndarray, rights: np.ndarray, pieces: np.ndarray):
        self._bits = max(4, int(4 * len(pieces)).bit_length())
        self._keys = np.full(1 << self._bits, -1, dtype=np.int64)
        self._pieces = np.full(1 << self._bits, -1, dtype=np.int32)
        keys, left = self._key(lefts, rights), np.arange(len(pieces))
        slots = self._slot(keys)
        while left.size:
            free = left[self._keys[slots[left]] == -1]
            _, first = np.unique(slots[free], return_index=True)
            placed = free[first]
            self._keys[slots[placed]], self._pieces[slots[placed]] = keys[placed], pieces[placed]
            left = left[self._keys[slots[left]] != keys[left]]
            taken = left
            slots[taken] = (slots[taken] + 1) & ((1 << self._bits) - 1)

    @staticmethod
    def _key(lefts: np.ndarray, rights: np.ndarray) -> np.ndarray:
        return (lefts.astype(np.int64) << 32) | (rights.astype(np.int64) & 0xFFFFFFFF)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return (mixed >> np.uint64(64 - self._bits)).astype(np.int64)

    def get(self, lefts: np.ndarray, rights: np.ndarray) -> np.ndarray:
        """The piece of each pair, -1 where there is none. Symbol -1 is in no pair."""
        keys = self._key(lefts, rights)
        slots = self._slot(keys)
        held = self._keys[slots]
        found = np.where(held == keys, self._pieces[slots], np.int32(-1))
        left = np.flatnonzero((held != keys) & (held != -1))
        while left.size:
            slots[left] = (slots[left] + 1) & ((1 << self._bits) - 1)
            held = self._keys[slots[left]]
            hit = held == keys[left]
            found[left[hit]] = self._pieces[slots[left[hit]]]
            left = left[~hit & (held != -1)]
        return found


class Merger:
    """A vocabulary's merges. Symbols are piece ids, and numbers above them for other characters."""

    def __init__(
        self, ids: dict[str, int], scores: dict[str, float], n: int, byte_ids: list[int], mark: str, stand_in: str
    ):
        """``mark`` stands for a space; where a text holds it, or its stand-in, it is in no piece."""
        self._n, self._byte_ids = n, np.array(byte_ids, dtype=np.int32)
        self._symbols = np.full(0x110000, -1, dtype=np.int32)
        self._others: list[str] = []
        for name, i in ids.items():
            if len(name) == 1:
                self._symbols[ord(name)] = i
        kept = {name: i for name, i in ids.items() if len(name) > 1}
        singles = {c: self._symbol(c) for name in kept for c in name}
        pairs = [
            (a, b, i)
            for name, i in kept.items()
            for cut in range(1, len(name))
            if (a := _number(name[:cut], ids, singles)) is not None
            and (b := _number(name[cut:], ids, singles)) is not None
        ]
        lefts, rights, pieces = np.array(pairs, dtype=np.int32).reshape(-1, 3).T
        self._pairs = PairTable(lefts, rights, pieces)
        # Equal scores have equal ranks; -1 as an index finds the last, which is no rank.
        self._ranks = np.full(n + 1, -1, dtype=np.int32)
        at = np.fromiter(ids.values(), dtype=np.int64, count=len(ids))
        _, ranks = np.unique([scores[name] for name in ids], return_inverse=True)
        self._ranks[at] = ranks
        names = [b""] * n
        for name, i in ids.items():
            names[i] = name.encode()
        # A label is place, space, piece; places have one or two digits.
        self._labels = Labels([b"\0" * head + name for head in (2, 3) for name in names])
        self._heads = np.array(
            [int.from_bytes(f"{place} ".encode(), "little") for place in range(SHORT)], dtype=np.uint64
        )
        self._symbols[ord(" ")] = self._symbol(mark)
        self._symbols[[ord(mark), ord(stand_in)]] = self._symbol(mark, anew=True)

    def _symbol(self, c: str, anew: bool = False) -> int:
        """The number of a character."""
        number = -1 if anew else int(self._symbols[ord(c)])
        if number < 0:
            number = self._symbols[ord(c)] = self._n + len(self._others)
            self._others.append(c)
        return number

    def symbols(self, text: str) -> np.ndarray:
        """The symbols of a text's characters."""
        points = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
        found = self._symbols[points]
        if (found < 0).any():
            for point in np.unique(points[found < 0]).tolist():
                self._symbol(chr(point))
            found = self._symbols[points]
        return found

    def skipped(self, places: np.ndarray, pieces: np.ndarray, keys: np.ndarray, limit: int) -> np.ndarray:
        """Whether candidates are skipped under the keys of their occurrences."""
        if limit >= 2**64:
            return np.ones(len(places), dtype=bool)
        rows = np.where(places < 10, pieces, pieces + self._n)
        return self._labels.hashes(rows, keys, self._heads[places]) < np.uint64(limit)

    def merged(
        self, flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, keys: np.ndarray | None, limit: int
    ) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
        """The ids of chunks of up to ``SHORT`` symbols, side by side, and how many each has.

        Without skips, what was merged too: chunks, places and pieces in the order of merging.
        """
        trace: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        found, counts, begins, before = [], np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64), 0
        for low, width in zip(_WIDTHS, _WIDTHS[1:], strict=False):
            alike = np.flatnonzero((sizes > low) & (sizes <= width))
            for rows in (alike[i : i + AT_ONCE] for i in range(0, len(alike), AT_ONCE)):
                columns = self._columns(flat, starts[rows], sizes[rows], width)
                left = self._group(columns, None if keys is None else keys[rows], limit, rows, trace).T
                kept = left >= 0
                found.append(left[kept])
                counts[rows] = kept.sum(axis=1)
                begins[rows] = before + np.cumsum(counts[rows]) - counts[rows]
                before += len(found[-1])
        if not found:
            return np.zeros(0, np.int32), counts, trace
        return *self._written(slices(np.concatenate(found), begins, counts), counts), trace

    @staticmethod
    def _columns(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, width: int) -> np.ndarray:
        """Chunks as columns, with two more cells that stand for what is beyond their ends."""
        columns = np.full((width + 2, len(sizes)), -1, dtype=np.int32)
        ends = np.cumsum(sizes)
        column = np.repeat(np.arange(len(sizes)), sizes)
        place = np.arange(ends[-1]) - np.repeat(ends - sizes, sizes)
        columns[place, column] = flat[place + np.repeat(starts, sizes)]
        return columns

    def _candidates(self, pieces: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Larger for a better score, then further left; -1 where there is no piece."""
        return np.where(pieces >= 0, self._ranks[pieces] * SHORT + (SHORT - 1) - places, -1).astype(np.int32)

    def _group(
        self, cells: np.ndarray, keys: np.ndarray | None, limit: int, rows: np.ndarray, trace: list
    ) -> np.ndarray:
        """Merge columns to their end; merged symbols stand at their first place, -1 at the others."""
        width, n = len(cells) - 2, cells.shape[1]
        out = np.empty((width, n), dtype=np.int32)
        places = np.arange(width + 2, dtype=np.int32)[:, None]
        after = np.repeat(places + 1, n, axis=1)
        before = np.repeat(places - 1, n, axis=1)
        after[(cells[:width] >= 0).sum(axis=0) - 1, np.arange(n)] = width
        before[0] = width + 1
        made = np.full_like(cells, -1)
        made[: width - 1] = self._pairs.get(cells[: width - 1].ravel(), cells[1:width].ravel()).reshape(width - 1, n)
        agenda = self._candidates(made, places)
        live = np.arange(n)
        while True:
            best = agenda[:width].max(axis=0)
            on = np.flatnonzero(best >= 0)
            if 4 * on.size < 3 * n:
                out[:, live] = cells[:width]
                if not on.size:
                    return out
                live, best, n = live[on], best[on], on.size
                cells, after, before, made, agenda = (
                    np.take(a, on, axis=1) for a in (cells, after, before, made, agenda)
                )
                on = np.arange(n)
            symbols, following, preceding, piece_at, order = (
                a.reshape(-1) for a in (cells, after, before, made, agenda)
            )
            place = SHORT - 1 - (best[on] & (SHORT - 1))
            cell = place * np.int64(n) + on
            piece = piece_at[cell]
            if keys is None:
                trace.append((rows[live[on]], place, piece))
            else:
                skip = self.skipped(place, piece, keys[live[on]], limit)
                order[cell[skip]] = -1
                go = ~skip
                on, place, cell, piece = on[go], place[go], cell[go], piece[go]
            right = following[cell] * np.int64(n) + on
            far = following[right]
            symbols[cell], symbols[right], order[right] = piece, -1, -1
            following[cell] = far
            far_cell = far * np.int64(n) + on
            preceding[far_cell] = place
            near = preceding[cell]
            cell = np.concatenate([near * np.int64(n) + on, cell])
            found = self._pairs.get(
                np.concatenate([symbols[cell[: on.size]], piece]), np.concatenate([piece, symbols[far_cell]])
            )
            piece_at[cell] = found
            order[cell] = self._candidates(found, np.concatenate([near, place]))

    def _written(self, symbols: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters that are no pieces as the ids of their bytes."""
        other = symbols >= self._n
        if not other.any():
            return symbols, counts
        at, inverse = np.unique(symbols[other], return_inverse=True)
        names = [self._others[i - self._n].encode() for i in at.tolist()]
        lengths = np.array([len(name) for name in names], dtype=np.int64)
        written = self._byte_ids[np.frombuffer(b"".join(names), dtype=np.uint8)]
        wide, starts = np.ones(len(symbols), np.int64), np.arange(len(symbols))
        wide[other] = lengths[inverse]
        starts[other] = len(symbols) + (np.cumsum(lengths) - lengths)[inverse]
        ends = np.concatenate([[0], np.cumsum(wide)])
        edges = np.concatenate([[0], np.cumsum(counts)])
        return slices(np.concatenate([symbols, written]), starts, wide), np.diff(ends[edges])


def _number(name: str, ids: dict[str, int], singles: dict[str, int]) -> int | None:
    return ids.get(name) if len(name) > 1 else singles[name]
