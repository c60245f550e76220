"""Phrases of two and three words that occur together, per language, by tiles of word pairs.

Texts are lower-cased in A-Z, cut into pieces at punctuation and line ends, and
pieces into words at blanks and tabs. The words of each language that occur
often enough are numbered by falling frequency. The grid of number pairs is cut
into tiles whose rows and columns hold about equal shares of all occurrences, so
tiles of frequent words are small and those of rare words wide. A tile in which
many cells are taken is counted by a dense numpy bincount addressed by the cell;
the others are sorted lists of (cell, count). The frequent pairs of a tile are
ranked anew and become the rows of the next grid, (pair, third word), which is
counted in the same way.

Nothing is broadcast but a bitmap of fixed size. Words get their numbers by
joins: a chunk of text shuffles each of its distinct words once. The bitmap of
frequent pairs only keeps most hopeless triples from being shuffled; a tile
checks the pairs themselves. A chunk sends one row to a tile, and a tile's rows
are added up as a stream, so memory is bounded by a tile's distinct cells. Where
there are very many chunks, a tile's rows are first added up in groups.

Counts are exact, as are scores (decimals of 38 digits: counts up to 10**14).

Defined results: a null text is empty; a null language is ``und``; empty and
blank texts and empty pieces have no words; repeated rows count each; a language
without candidates has no rows; an empty table gives none; only ``text`` and
``lang`` are looked at.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnrisk.llm.tables import for_tasks, steps, stored

#: Text of a chunk. Larger chunks shuffle fewer cells and need more memory.
CHUNK_BYTES = 16 << 20
#: Occurrences of a tile on average.
TILE_TOKENS = 2_000_000
#: Cells of a tile that are counted by address, if at least a quarter is taken.
DENSE_CELLS = 1 << 22
#: Cells that a tile keeps before it adds equal ones up.
HELD = 1 << 22
#: Bits of the map of frequent pairs, a power of two.
MAP_BITS = 1 << 26
#: Chunks whose cells are added up at once; beyond, in two steps.
CHUNKS_AT_ONCE = 4096

NO_LANGUAGE = "und"

_BORDER = b"\n"
_FOLDED = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz " + _BORDER * 10
)


def _cut(text: bytes, size: int) -> Iterator[bytes]:
    """A folded text in parts of about ``size`` bytes, cut between pieces."""
    while len(text) > size and (end := text.find(_BORDER, size)) >= 0:
        yield text[:end]
        text = text[end:]
    yield text


def words_of(text: bytes) -> tuple[pa.Array, np.ndarray]:
    """Distinct words of a folded text, and each occurrence's place among them, -1 between pieces."""
    spaced = text.replace(_BORDER, b" " + _BORDER + b" ").decode()
    coded = pc.split_pattern(pa.array([spaced]), " ").flatten().dictionary_encode()
    at, words = coded.indices.to_numpy(), coded.dictionary
    plain = np.ones(len(words), dtype=bool)
    place = np.full(len(words), -2, dtype=np.int32)
    for mark, value in (("", -2), ("\n", -1)):
        found = pc.index(words, mark).as_py()
        if found >= 0:
            plain[found], place[found] = False, value
    place[plain] = np.arange(plain.sum())
    tokens = place[at]
    return words.filter(pa.array(plain)), tokens[tokens > -2]


def _packed(values: np.ndarray, kind: str = "<i4") -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(values.astype(kind).tobytes())


def _unpacked(data: bytes, kind: str = "<i4") -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def _chunks(docs: DataFrame, chunk_bytes: int) -> DataFrame:
    """Texts as rows of two kinds, told apart by which columns are null.

    A chunk is text of one language. It has a row (chunk, lang, place, word, n)
    for each distinct word, and one row (chunk, lang, tokens).
    """
    for_tasks(docs.sparkSession)
    schema = "chunk long, lang string, place int, word string, n long, tokens binary"

    def chunk_rows(number: int, lang: str, texts: list[bytes]) -> Iterator[pa.RecordBatch]:
        words, tokens = words_of(_BORDER.join(texts))
        n = len(words)
        counts = np.bincount(tokens[tokens >= 0], minlength=n)
        for at in range(0, n + 1, 10_000):
            part, last = words.slice(at, 10_000), at + 10_000 > n
            nothing = [None] * (1 if last else 0)
            rows = len(part) + len(nothing)
            yield pa.record_batch(
                {
                    "chunk": np.full(rows, number),
                    "lang": pa.array([lang] * rows, pa.string()),
                    "place": pa.array([*range(at, at + len(part)), *nothing], pa.int32()),
                    "word": pa.concat_arrays([part, pa.array(nothing, pa.string())]),
                    "n": pa.array([*counts[at : at + len(part)].tolist(), *nothing], pa.int64()),
                    "tokens": pa.array([None] * len(part) + [_packed(tokens)] * len(nothing), pa.binary()),
                }
            )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, held, size = TaskContext.get().partitionId() << 32, {}, 0
        for batch in steps(batches):
            pairs = zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True)
            for lang, text in pairs:
                for part in _cut(text.encode().translate(_FOLDED), chunk_bytes):
                    held.setdefault(lang, []).append(part)
                    size += len(part)
                    if size >= chunk_bytes:
                        for name, texts in held.items():
                            yield from chunk_rows(number, name, texts)
                            number += 1
                        held, size = {}, 0
        for name, texts in held.items():
            yield from chunk_rows(number, name, texts)
            number += 1

    chosen = docs.select(
        F.coalesce("text", F.lit("")).alias("text"), F.coalesce("lang", F.lit(NO_LANGUAGE)).alias("lang")
    )
    return chosen.mapInArrow(rows, schema)


def _vocabulary(words: DataFrame, totals: DataFrame, least: int, tile_tokens: int) -> DataFrame:
    """(lang, word, f, id, stripe): words that occur ``least`` times, ids by falling frequency.

    Ids and running totals are counted within sorted ranges; a row for each
    range and language tells what lies before it. A stripe of the grid holds an
    equal share of a language's occurrences.
    """
    counts = words.groupBy("lang", "word").agg(F.sum("n").alias("f")).filter(F.col("f") >= least)
    order = ["lang", F.desc("f"), "word"]
    parts = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = counts.repartitionByRange(parts, *order).sortWithinPartitions(*order)

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, lang, number, mass = TaskContext.get().partitionId(), None, 0, 0
        for batch in batches:
            f = batch.column("f").to_numpy()
            names = batch.column("lang").dictionary_encode()
            at = names.indices.to_numpy()
            starts = [0, *(np.flatnonzero(np.diff(at)) + 1).tolist(), batch.num_rows]
            for a, b in zip(starts, starts[1:], strict=False):
                if a == b:
                    continue
                name = names.dictionary[int(at[a])].as_py()
                if name != lang:
                    lang, number, mass = name, 0, 0
                sums = np.cumsum(f[a:b])
                yield pa.record_batch(
                    {
                        "lang": batch.column("lang").slice(a, b - a),
                        "word": batch.column("word").slice(a, b - a),
                        "f": f[a:b],
                        "part": np.full(b - a, part, dtype=np.int32),
                        "number": np.arange(number, number + b - a),
                        "mass": mass + sums - f[a:b],
                    }
                )
                number, mass = number + b - a, mass + int(sums[-1])

    schema = "lang string, word string, f long, part int, number long, mass long"
    rows = stored(ranged.mapInArrow(numbered, schema), "phrase-words")
    ranges = rows.groupBy("lang", "part").agg(F.count("*").alias("words"), F.sum("f").alias("all"))
    before = Window.partitionBy("lang").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("lang")
    bases = ranges.select(
        "lang",
        "part",
        F.coalesce(F.sum("words").over(before), F.lit(0)).alias("base"),
        F.coalesce(F.sum("all").over(before), F.lit(0)).alias("lower"),
        F.sum("all").over(whole).alias("kept"),
    )
    stripes = F.ceil(F.sqrt(F.col("n") / tile_tokens))
    # Doubles: only where a word's stripe begins depends on them.
    stripe = F.floor((F.col("mass") + F.col("lower")) * stripes / F.col("kept")).cast("int")
    return rows.join(bases, ["lang", "part"]).join(totals, "lang").select(
        "lang", "word", "f", (F.col("number") + F.col("base")).cast("int").alias("id"), stripe.alias("stripe")
    )


def _numbered(chunks: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(chunk, lang, ids, first, stripes): each chunk with its words' ids, -1 where a phrase ends.

    ``first`` has the smallest id of the chunk in each of its ``stripes``.
    """
    words = chunks.filter(F.col("word").isNotNull()).select("chunk", "lang", "place", "word")
    known = words.join(vocabulary, ["lang", "word"]).select(
        F.col("chunk").alias("of_chunk"), "place", "id", "stripe"
    )
    texts = chunks.filter(F.col("tokens").isNotNull()).select("chunk", "lang", "tokens")

    def ids(text: pa.Table, words: pa.Table) -> pa.Table:
        if not len(text) or not len(words):
            return schema.empty_table()
        tokens = _unpacked(text["tokens"][0].as_py())
        number = words["id"].to_numpy()
        of = np.full(max(tokens.max(), 0) + 2, -1, dtype=np.int32)
        of[words["place"].to_numpy()] = number
        row = of[tokens]
        # One gap is as good as many.
        kept = row >= 0
        kept[1:] |= kept[:-1]
        stripes, place = np.unique(words["stripe"].to_numpy(), return_inverse=True)
        first = np.full(len(stripes), np.iinfo(np.int32).max)
        np.minimum.at(first, place, number)
        return pa.table(
            {
                "chunk": text["chunk"],
                "lang": text["lang"],
                "ids": [_packed(row[kept])],
                "first": [_packed(first)],
                "stripes": [_packed(stripes)],
            },
            schema=schema,
        )

    schema = pa.schema(
        [("chunk", pa.int64()), ("lang", pa.string()), ("ids", pa.binary()), ("first", pa.binary()), ("stripes", pa.binary())]
    )
    together = texts.groupBy("chunk").cogroup(known.groupBy("of_chunk"))
    return together.applyInArrow(ids, "chunk long, lang string, ids binary, first binary, stripes binary")


def summed(a: np.ndarray, b: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct cells (a, b) in order, with their counts added up.

    By a bincount over the cells' box where it is small and well filled, else by
    sorting.
    """
    if not len(a):
        return a, b, n
    left, top = int(a.min()), int(b.min())
    width = int(b.max()) - top + 1
    cells = (int(a.max()) - left + 1) * width
    if cells <= min(DENSE_CELLS, 4 * len(a)):
        # Sums of whole numbers below 2**53 are exact.
        counts = np.bincount((a - left) * width + (b - top), weights=n, minlength=cells)
        at = np.flatnonzero(counts)
        return at // width + left, at % width + top, counts[at].astype(np.int64)
    if cells < 2**62:
        order = np.argsort((a.astype(np.int64) - left) * width + (b - top), kind="stable")
    else:
        order = np.lexsort((b, a))
    a, b, n = a[order], b[order], n[order]
    new = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
    return a[new], b[new], np.add.reduceat(n, new)


class Cells:
    """Counts of one tile, added up whenever ``HELD`` cells have gathered."""

    def __init__(self):
        self._parts, self._size, self._held = [], 0, HELD

    def add(self, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> None:
        self._parts.append((a, b, n))
        self._size += len(a)
        if self._size > self._held:
            # Twice what is left, so that few new cells do not mean one more sum for each row.
            self._held = max(HELD, 2 * len(self.total()[0]))

    def total(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if len(self._parts) > 1:
            columns = zip(*self._parts, strict=True)
            self._parts = [summed(*(np.concatenate(c) for c in columns))]
            self._size = len(self._parts[0][0])
        return self._parts[0] if self._parts else (np.zeros(0, np.int64),) * 3


_TILE = "lang string, row int, column int"
_CELLS = f"{_TILE}, salt int, a binary, b binary, n binary"
_KINDS = ("<i8", "<i4", "<i8")


def _tile_rows(lang: str, rows: np.ndarray, columns: np.ndarray, salt: int, *cells: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row for each tile that has cells."""
    order = np.lexsort((columns, rows))
    rows, columns = rows[order], columns[order]
    cells = [c[order] for c in cells]
    if not len(rows):
        return
    starts = np.flatnonzero(
        np.concatenate([[True], (rows[1:] != rows[:-1]) | (columns[1:] != columns[:-1])])
    )
    ends = [*starts[1:].tolist(), len(rows)]
    spans = list(zip(starts.tolist(), ends, strict=True))
    for at in range(0, len(spans), 1000):
        some = spans[at : at + 1000]
        yield pa.record_batch(
            {
                "lang": [lang] * len(some),
                "row": rows[[s for s, _ in some]].astype(np.int32),
                "column": columns[[s for s, _ in some]].astype(np.int32),
                "salt": np.full(len(some), salt, dtype=np.int32),
                **{
                    name: pa.array([_packed(c[s:e], kind) for s, e in some], pa.binary())
                    for name, c, kind in zip("abn", cells, _KINDS, strict=True)
                },
            }
        )


def _of_chunk(row: dict) -> tuple[np.ndarray, Callable[[np.ndarray], np.ndarray]]:
    first, stripes = _unpacked(row["first"]), _unpacked(row["stripes"])
    return _unpacked(row["ids"]), lambda ids: stripes[np.searchsorted(first, ids, side="right") - 1]


def _pair_cells(numbered: DataFrame, salts: int) -> DataFrame:
    """The pairs of each chunk, a row for each tile that they touch."""

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for batch in batches for r in batch.to_pylist()):
            ids, stripe = _of_chunk(row)
            real = (ids[:-1] >= 0) & (ids[1:] >= 0)
            a, b, n = _counted(ids[:-1][real], ids[1:][real])
            yield from _tile_rows(row["lang"], stripe(a), stripe(b), row["chunk"] % salts, a, b, n)

    return numbered.mapInArrow(cells, _CELLS)


#: Ids below this, the most frequent words of a language, are counted by address in a chunk.
HEAD = 1024


def _counted(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of a chunk's occurrences, with counts."""
    head = (a < HEAD) & (b < HEAD)
    dense = np.bincount(a[head].astype(np.int64) * HEAD + b[head], minlength=1)
    at = np.flatnonzero(dense)
    key, n = np.unique((a[~head].astype(np.int64) << 32) | b[~head], return_counts=True)
    return (
        np.concatenate([at // HEAD, key >> 32]),
        np.concatenate([at % HEAD, key & 0xFFFFFFFF]),
        np.concatenate([dense[at], n]),
    )


def _in_tiles(cells: DataFrame, *, final: bool) -> DataFrame:
    """Rows of one tile (and salt) in one partition, one after the other."""
    keys = ["lang", "row", "column"] if final else ["lang", "row", "column", "salt"]
    parts = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [*keys, "kind"] if "kind" in cells.columns else keys
    return cells.repartition(parts, *keys).sortWithinPartitions(*order)


def _arrays(row: dict) -> list[np.ndarray]:
    return [_unpacked(row[c], kind) for c, kind in zip("abn", _KINDS, strict=True)]


def _added(cells: DataFrame, *, final: bool, least: int = 1) -> DataFrame:
    """The rows of each tile (and salt, unless this is the last step) in one: cells with ``least``."""

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, None
        for row in (r for batch in batches for r in batch.to_pylist()):
            own = (row["lang"], row["row"], row["column"], 0 if final else row["salt"])
            if own != key:
                if key:
                    yield from one(key, held)
                key, held = own, Cells()
            held.add(*_arrays(row))
        if key:
            yield from one(key, held)

    def one(key: tuple, held: Cells) -> Iterator[pa.RecordBatch]:
        a, b, n = held.total()
        enough = n >= least
        a, b, n = a[enough], b[enough], n[enough]
        lang, row, column, salt = key
        yield from _tile_rows(lang, np.full(len(a), row), np.full(len(a), column), salt, a, b, n)

    return _in_tiles(cells, final=final).mapInArrow(added, _CELLS)


def _spots(lang: str, a: np.ndarray, b: np.ndarray, bits: int) -> np.ndarray:
    """Each pair's place in the bitmap."""
    seed = np.uint64(xxhash.xxh64_intdigest(lang.encode()))
    with np.errstate(over="ignore"):
        x = (a.astype(np.uint64) << np.uint64(32)) ^ b.astype(np.uint64) ^ seed
        # The mixing of splitmix64.
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) & np.uint64(bits - 1)).astype(np.int64)


def _rows(tiles: DataFrame, bits: int) -> DataFrame:
    """(lang, a, b, n, spot): a row for each pair of the tiles."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for batch in batches for r in batch.to_pylist()):
            a, b, n = _arrays(row)
            spots = _spots(row["lang"], a, b, bits)
            for at in range(0, len(a), 10_000):
                part = slice(at, at + 10_000)
                yield pa.record_batch(
                    {
                        "lang": pa.array([row["lang"]] * len(a[part]), pa.string()),
                        "a": a[part].astype(np.int32),
                        "b": b[part],
                        "n": n[part],
                        "spot": spots[part],
                    }
                )

    return tiles.mapInArrow(rows, "lang string, a int, b int, n long, spot long")


def _bitmap(pairs: DataFrame, bits: int) -> np.ndarray:
    """The pairs' spots as 64-bit words; at most ``bits`` / 64 rows reach the driver."""
    mask = F.expr("shiftleft(1L, cast(spot % 64 AS int))")
    marked = pairs.groupBy(F.shiftright("spot", 6).alias("at")).agg(F.bit_or(mask).alias("mask"))
    rows = marked.toArrow()
    words = np.zeros(max(1, bits // 64), dtype=np.int64)
    words[rows["at"].to_numpy()] = rows["mask"].to_numpy()
    return words


def _triple_cells(numbered: DataFrame, bitmap: np.ndarray, salts: int) -> DataFrame:
    """Triples of each chunk both of whose pairs are in the bitmap, by the tile of their first pair.

    Cells are (first pair as one number, third word).
    """
    shared, bits = numbered.sparkSession.sparkContext.broadcast(bitmap), len(bitmap) * 64

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        for row in (r for batch in batches for r in batch.to_pylist()):
            ids, stripe = _of_chunk(row)
            a, b = ids[:-1], ids[1:]
            spot = _spots(row["lang"], a, b, bits)
            hit = (a >= 0) & (b >= 0) & (words[spot >> 6] >> (spot & 63) & 1).astype(bool)
            at = np.flatnonzero(hit[:-1] & hit[1:])
            pair = (ids[at].astype(np.int64) << 32) | ids[at + 1]
            distinct, place = np.unique(pair, return_inverse=True)
            rank, third, n = summed(place, ids[at + 2], np.ones(len(at), dtype=np.int64))
            pair = distinct[rank] if len(rank) else distinct[:0]
            first, second = stripe(pair >> 32), stripe(pair & 0xFFFFFFFF)
            yield from _tile_rows(row["lang"], first, second, row["chunk"] % salts, pair, third, n)

    return numbered.mapInArrow(cells, _CELLS)


def _triples(cells: DataFrame, tiles: DataFrame, least: int) -> DataFrame:
    """(lang, a, b, c, n): the triples that occur ``least`` times.

    A tile's frequent pairs come first and are ranked by frequency; then its
    triples are counted by (rank of the pair, third word).
    """
    both = tiles.withColumn("kind", F.lit(0)).unionByName(cells.withColumn("kind", F.lit(1)))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, pairs, ranks = None, Cells(), np.zeros(0, np.int64), np.zeros(0, np.int64)
        for row in (r for batch in batches for r in batch.to_pylist()):
            own = (row["lang"], row["row"], row["column"])
            if own != key:
                if key:
                    yield from some(key[0], held, pairs, ranks)
                key, held, pairs, ranks = own, Cells(), np.zeros(0, np.int64), np.zeros(0, np.int64)
            a, b, n = _arrays(row)
            if row["kind"] == 0:
                pairs = (a << 32) | b
                order = np.argsort(pairs)
                pairs, by_frequency = pairs[order], np.argsort(-n[order], kind="stable")
                ranks = np.empty(len(pairs), dtype=np.int64)
                ranks[by_frequency] = np.arange(len(pairs))
            elif len(pairs):
                place = np.minimum(np.searchsorted(pairs, a), len(pairs) - 1)
                real = pairs[place] == a
                held.add(ranks[place[real]], b[real], n[real])
        if key:
            yield from some(key[0], held, pairs, ranks)

    def some(lang: str, held: Cells, pairs: np.ndarray, ranks: np.ndarray) -> Iterator[pa.RecordBatch]:
        rank, third, n = held.total()
        enough = n >= least
        if not enough.any():
            return
        of_rank = np.empty_like(pairs)
        of_rank[ranks] = pairs
        pair, third, n = of_rank[rank[enough]], third[enough], n[enough]
        for at in range(0, len(n), 10_000):
            part = slice(at, at + 10_000)
            yield pa.record_batch(
                {
                    "lang": pa.array([lang] * len(n[part]), pa.string()),
                    "a": (pair[part] >> 32).astype(np.int32),
                    "b": (pair[part] & 0xFFFFFFFF).astype(np.int32),
                    "c": third[part].astype(np.int32),
                    "n": n[part].astype(np.int64),
                }
            )

    return _in_tiles(both, final=True).mapInArrow(counted, "lang string, a int, b int, c int, n long")


def score(a: str, left: str, right: str) -> Column:
    """floor(1000000 * a * a / (left * right)) of three columns, exactly."""
    a, left, right = (f"CAST({name} AS DECIMAL(14, 0))" for name in (a, left, right))
    return F.expr(f"({a} * {a} * CAST(1000000 AS DECIMAL(7, 0))) DIV ({left} * {right})")


def phrases(
    docs: DataFrame,
    least: int = 10,
    covered_percent: int = 50,
    most: int = 2000,
    chunk_bytes: int = CHUNK_BYTES,
    tile_tokens: int = TILE_TOKENS,
    map_bits: int = MAP_BITS,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``most`` best phrases.

    ``a`` counts the phrase, ``l`` and ``r`` the parts at its lowest-scoring cut,
    ``n`` all words of the language. A pair goes if a triple around it has at
    least ``covered_percent`` of its count.
    """
    chunks = stored(_chunks(docs, chunk_bytes), "phrase-chunks")
    words = chunks.filter(F.col("word").isNotNull()).select("lang", "word", "n")
    totals = stored(words.groupBy("lang").agg(F.sum("n").alias("n")), "phrase-totals")
    vocabulary = stored(_vocabulary(words, totals, least, tile_tokens), "phrase-vocabulary")
    numbered = stored(_numbered(chunks, vocabulary.select("lang", "word", "id", "stripe")), "phrase-ids")
    salts = -(-numbered.count() // CHUNKS_AT_ONCE) or 1

    def in_groups(cells: DataFrame) -> DataFrame:
        return _added(cells, final=False) if salts > 1 else cells

    tiles = stored(_added(in_groups(_pair_cells(numbered, salts)), final=True, least=least), "phrase-tiles")
    found = stored(_rows(tiles, map_bits), "phrase-pairs")
    triple_cells = in_groups(_triple_cells(numbered, _bitmap(found, map_bits), salts))
    triples = stored(_triples(triple_cells, tiles, least), "phrase-triples")

    known = vocabulary.select("lang", "id", "word", "f")
    first = known.toDF("lang", "a", "first", "first_n")
    last = known.toDF("lang", "b", "last", "last_n")
    pairs = found.select("lang", "a", "b", "n").join(first, ["lang", "a"]).join(last, ["lang", "b"])
    pairs = stored(pairs, "phrase-named")

    around = triples.select("lang", "a", "b", "n").unionByName(
        triples.select("lang", F.col("b").alias("a"), F.col("c").alias("b"), "n")
    )
    longest = around.groupBy("lang", "a", "b").agg(F.max("n").alias("longer"))
    covered = F.coalesce(F.col("longer"), F.lit(0)) * 100 >= F.col("n") * covered_percent
    two = pairs.join(longest, ["lang", "a", "b"], "left").filter(~covered)
    two = two.select(
        "lang",
        F.concat_ws(" ", "first", "last").alias("phrase"),
        F.col("n").alias("a"),
        F.col("first_n").alias("l"),
        F.col("last_n").alias("r"),
        score("n", "first_n", "last_n").alias("score"),
    )
    left = pairs.select("lang", "a", "b", "first", "first_n", F.col("n").alias("left_n"))
    right = pairs.select(
        "lang",
        F.col("a").alias("b"),
        F.col("b").alias("c"),
        F.col("first").alias("middle"),
        "last",
        "last_n",
        F.col("n").alias("right_n"),
    )
    three = triples.join(left, ["lang", "a", "b"]).join(right, ["lang", "b", "c"])
    three = three.withColumns({"one": score("n", "first_n", "right_n"), "two": score("n", "left_n", "last_n")})
    early = F.col("one") <= F.col("two")
    three = three.select(
        "lang",
        F.concat_ws(" ", "first", "middle", "last").alias("phrase"),
        F.col("n").alias("a"),
        F.when(early, F.col("first_n")).otherwise(F.col("left_n")).alias("l"),
        F.when(early, F.col("right_n")).otherwise(F.col("last_n")).alias("r"),
        F.least("one", "two").alias("score"),
    )
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = two.unionByName(three).withColumn("rank", F.row_number().over(best).cast("long"))
    listed = ranked.filter(F.col("rank") <= most).join(totals, "lang")
    return listed.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
