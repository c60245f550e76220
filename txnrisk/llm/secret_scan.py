"""Secrets in texts: fixed patterns, and random-looking strings by two Markov models.

A string of token characters is a secret of kind ``markov`` when a character
Markov model of random strings explains it better than one of ordinary
identifiers: the log-likelihood ratio has to reach ``Model.least`` in total and
``Model.least_per_char`` per character. If the whole string does not reach them,
its best-scoring segments are judged by the same limits, with separators as
borders of words, so a name or path around a random string does not hide it.
Base spans are cut out first. Rulers such as a row of dashes, with less
than ``Model.least_distinct`` different characters, are no random strings. Both models are trained by counting
transitions in labelled samples; ``fit`` labels the corpus by the fixed patterns.

Defined results: a null text is empty and has no spans; rows are judged one by
one, so repeated rows repeat their result; null ids stay null; an empty table
gives an empty result; only ``doc_id`` and ``text`` are looked at.
"""

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnrisk.llm.tables import for_tasks, steps, with_text

# The base patterns, and the kinds in the order in which spans of one start are listed.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ASSIGN_CHARS, ACCESS_CHARS, HEX_CHARS = 12, 18, 16
KINDS = ("assign", "access", "hex", "markov")

#: Shortest string that the models judge.
MARKOV_CHARS = 16
#: Letters and digits by which a segment inside a string is widened at each end.
MARGIN = 8
_TOKEN = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-="
#: State 0 is any character outside the alphabet, and so the border of a string.
STATES = len(_TOKEN) + 1
_STATE = np.zeros(256, dtype=np.int32)
_STATE[np.frombuffer(_TOKEN, dtype=np.uint8)] = np.arange(1, STATES)
_SEPARATOR = np.array([False] + [not chr(c).isalnum() for c in _TOKEN])
_IS_HEX = bytes(120 if chr(c) in "0123456789abcdef" else 32 for c in range(256))
_IS_TOKEN = bytes(120 if c in _TOKEN else 32 for c in range(256))
_RUN = re.compile(b"x" * 16 + b"+")
assert HEX_CHARS == MARKOV_CHARS == 16

SPANS = "array<struct<kind:string,start:int,end:int>>"


@dataclass(frozen=True)
class Model:
    """Log probabilities of transitions, state by state, and the limits of a finding."""

    random: np.ndarray = field(repr=False)
    ordinary: np.ndarray = field(repr=False)
    least: float = 12.0
    least_per_char: float = 0.5
    least_distinct: int = 6

    @property
    def ratio(self) -> np.ndarray:
        return self.random - self.ordinary


def _one_byte(text: str) -> bytes:
    """One byte for each code point, so that offsets are the text's; ``?`` for what has none."""
    return text.encode("latin-1", "replace")


def base_spans(text: str, one_byte: bytes) -> list[tuple[int, int, int]]:
    """(start, place of the kind in KINDS, end) of the fixed patterns' matches."""
    found = []
    small = text.lower()
    if any(word in small for word in ASSIGN_WORDS):
        found += [
            (m.start(), 0, m.end())
            for m in ASSIGN.finditer(text)
            if len(m.group(2)) >= ASSIGN_CHARS
        ]
    if "AKIA" in text:
        found += [
            (m.start(), 1, m.end())
            for m in ACCESS.finditer(text)
            if m.end() - m.start() >= ACCESS_CHARS
        ]
    # A run of hex digits is a match whole, so it can be found by its length at once.
    found += [(m.start(), 2, m.end()) for m in _RUN.finditer(one_byte.translate(_IS_HEX))]
    return found


def _states(one_byte: bytes) -> np.ndarray:
    return _STATE[np.frombuffer(one_byte, dtype=np.uint8)]


def segments(values: list[float]) -> list[tuple[int, int]]:
    """All maximal segments of positive sum, as Ruzzo and Tompa find them in one pass."""
    # Of each: begin, end, and the sums of all values before its begin and up to its end.
    found: list[tuple[int, int, float, float]] = []
    total = 0.0
    for at, value in enumerate(values):
        before, total = total, total + value
        if value <= 0:
            continue
        begin, low = at, before
        place = len(found)
        while True:
            place -= 1
            while place >= 0 and found[place][2] >= low:
                place -= 1
            if place < 0 or found[place][3] >= total:
                break
            begin, low = found[place][0], found[place][2]
            del found[place:]
        found.append((begin, at + 1, low, total))
    return [(begin, end) for begin, end, _, _ in found]


def _left_of(start: int, end: int, base: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """The parts of a run that no base span covers."""
    for s, _, e in sorted(base):
        if s < end and start < e:
            if start < s:
                yield start, s
            start = max(start, e)
    if start < end:
        yield start, end


def _random_parts(one_byte: bytes, ratio: np.ndarray, model: Model) -> list[tuple[int, int]]:
    """Where the random model wins in a string of token characters: all of it, or its best segments."""
    n = len(one_byte)
    states = np.zeros(n + 2, dtype=np.int32)
    states[1:-1] = _states(one_byte)
    gains = ratio[states[:-1], states[1:]]

    def wins(score: float, start: int, end: int) -> bool:
        return (
            end - start >= MARKOV_CHARS
            and score >= max(model.least, model.least_per_char * (end - start))
            and len(set(one_byte[start:end])) >= model.least_distinct
        )

    if wins(float(gains.sum()), 0, n):
        return [(0, n)]
    # Separators inside are judged as the borders of words, which is how texts teach them.
    states[_SEPARATOR[states]] = 0
    gains = ratio[states[:-1], states[1:]]
    if gains[gains > 0].sum() < model.least:
        return []
    won = []
    # Segments of the gains, and of what is over the limit per character: the first keep weak
    # strings whole, the second are not thinned by a stretch that is only a little odd.
    for values in (gains, gains - model.least_per_char):
        for a, b in segments(values.tolist()):
            # The transitions a to b - 1 join the characters a - 1 to b - 1. At an end of the
            # string the border counts, whatever it says.
            start, end = max(a - 1, 0), min(b, n)
            score = gains[a if start else 0 : b if end < n else n + 1].sum()
            if wins(float(score), start, end):
                won.append((start, end))
    parts: list[tuple[int, int]] = []
    for start, end in sorted(won):
        # A random string's last characters can look ordinary: take a few more of the same word.
        for _ in range(MARGIN):
            start -= start > 0 and one_byte[start : start + 1].isalnum() and one_byte[start - 1 : start].isalnum()
            end += end < n and one_byte[end - 1 : end].isalnum() and one_byte[end : end + 1].isalnum()
        if parts and start <= parts[-1][1]:
            start, end = parts[-1][0], max(end, parts.pop()[1])
        parts.append((start, end))
    return parts


def markov_spans(
    one_byte: bytes, base: list[tuple[int, int, int]], ratio: np.ndarray, model: Model
) -> list[tuple[int, int, int]]:
    """Stretches in runs of token characters that the random model wins, apart from the base spans."""
    found = []
    for m in _RUN.finditer(one_byte.translate(_IS_TOKEN)):
        for start, end in _left_of(*m.span(), base):
            if end - start < MARKOV_CHARS:
                continue
            parts = _random_parts(one_byte[start:end], ratio, model)
            found += [(start + a, 3, start + b) for a, b in parts]
    return found


def spans_of(text: str, model: Model, ratio: np.ndarray) -> list[tuple[int, int, int]]:
    one_byte = _one_byte(text)
    base = base_spans(text, one_byte)
    return sorted(base + markov_spans(one_byte, base, ratio, model))


def _transitions(states: np.ndarray) -> np.ndarray:
    """How often each state follows each, as one flat array."""
    pairs = states[:-1] * STATES + states[1:]
    return np.bincount(pairs, minlength=STATES * STATES)


def _bordered(strings: list[bytes]) -> np.ndarray:
    return _states(b" " + b" ".join(strings) + b" ")


def sample_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Transitions of the text's secrets by the fixed patterns, and of its short other strings."""
    one_byte = _one_byte(text)
    base = base_spans(text, one_byte)
    secrets = [one_byte[s:e] for s, kind, e in base if kind]
    secrets += [m.group(2).encode() for m in ASSIGN.finditer(text) if base and len(m.group(2)) >= 12]
    rest = bytearray(one_byte)
    for start, _, end in base:
        rest[start:end] = b" " * (end - start)
    for m in _RUN.finditer(rest.translate(_IS_TOKEN)):
        rest[m.start() : m.end()] = b" " * (m.end() - m.start())
    return _transitions(_bordered(secrets)), _transitions(_bordered([bytes(rest)]))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums = np.zeros((2, STATES * STATES), dtype=np.int64)
    for batch in steps(batches):
        for text in batch.column("text").to_pylist():
            secret, other = sample_counts(text)
            sums[0] += secret
            sums[1] += other
    label, pair = np.nonzero(sums)
    yield pa.record_batch(
        {"secret": pa.array(label == 0), "pair": pa.array(pair, pa.int32()), "n": sums[label, pair]}
    )


def model_of(
    counts: list[tuple[bool, int, int]], smoothing: float = 0.5, even: float = 0.1, **limits: float
) -> Model:
    """Both models from summed transition counts: (secret, pair of states, count).

    A share ``even`` of each is the even distribution, so that no transition
    which the samples lack weighs much, however many samples there were.
    """
    sums = np.full((2, STATES * STATES), smoothing)
    for secret, pair, n in counts:
        sums[0 if secret else 1, pair] += n
    sums = sums.reshape(2, STATES, STATES)
    mixed = (1 - even) * sums / sums.sum(axis=2, keepdims=True) + even / STATES
    random, ordinary = np.log(mixed)
    return Model(random, ordinary, **limits)


def fit(docs: DataFrame, **limits: float) -> Model:
    """Both models from all texts: what the fixed patterns find is random, shorter other
    strings are ordinary. What reaches the driver is at most two counts per pair of states."""
    for_tasks(docs.sparkSession)
    counts = with_text(docs).mapInArrow(_count, "secret boolean, pair int, n long")
    rows = counts.groupBy("secret", "pair").agg(F.sum("n").alias("n")).collect()
    return model_of([tuple(r) for r in rows], **limits)


def scan(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and ``spans``, an array of (kind, start, end) in order of start, then kind."""
    for_tasks(docs.sparkSession)

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratio = model.ratio
        kind = pa.list_(
            pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
        )
        for batch in steps(batches):
            found = [
                [{"kind": KINDS[k], "start": s, "end": e} for s, k, e in spans_of(t, model, ratio)]
                for t in batch.column("text").to_pylist()
            ]
            yield pa.record_batch(
                {"doc_id": batch.column("doc_id"), "spans": pa.array(found, kind)}
            )

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, spans {SPANS}"
    return with_text(docs).mapInArrow(spans, schema)


def hidden(text: str, spans: list[tuple[int, int, int]], mark: str) -> str:
    """The text with every stretch that spans cover replaced by the mark."""
    parts, at = [], 0
    for start, _, end in spans:
        if start >= at:
            parts += [text[at:start], mark]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def redact(docs: DataFrame, model: Model, mark: str = "[SECRET]") -> DataFrame:
    """All rows and columns, with the secrets in ``text`` replaced and ``n_chars`` counted
    anew, if there is one. Null texts stay null."""
    for_tasks(docs.sparkSession)

    def replaced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratio = model.ratio
        for batch in steps(batches):
            texts = [
                t and hidden(t, spans_of(t, model, ratio), mark)
                for t in batch.column("text").to_pylist()
            ]
            columns = {name: batch.column(name) for name in batch.schema.names}
            columns["text"] = pa.array(texts, pa.string())
            yield pa.record_batch(columns)

    clean = docs.mapInArrow(replaced, docs.schema)
    if "n_chars" not in docs.columns:
        return clean
    kind = docs.schema["n_chars"].dataType
    return clean.withColumn("n_chars", F.length("text").cast(kind)).select(docs.columns)


def joined(spans: Column) -> Column:
    """Spans as text: kind:start:end, comma-joined."""
    parts = F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end))
    return F.array_join(parts, ",")


def digest(found: DataFrame) -> DataFrame:
    """Counts by kind and the spans as text, of the rows of ``scan``; what the models added comes last."""
    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s.kind != "markov")
    return found.select(
        "doc_id",
        *[count(kind) for kind in KINDS if kind != "markov"],
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        count("markov"),
    )
