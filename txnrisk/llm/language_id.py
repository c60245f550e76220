"""Language of a text: word frequencies first, shorter and shorter character n-grams after.

A word that the model knows scores, in each language, the log of its relative
frequency there. An unseen word falls back to its character n-grams of the
longest order, of which those that are known are averaged, then to the next
shorter order while none is known. What a language lacks costs ``missing``.
A text's score for a language is the sum over its words; the probability of
the best language under these scores is reported.

Every word and n-gram that occurs at least twice in a language's sample is
learned. What occurs once there is no evidence of a frequency, and unseen words
of that kind are what the fallback is for.

Defined results: a null text or one without a letter is ``und`` with score 0,
and so is every text when nothing could be learned; ties go to the language
first in code point order; a null id is held out; repeated rows repeat their
result; an empty table gives an empty result; only ``doc_id``, ``text`` and,
for learning, ``lang`` are looked at.
"""

import re
from collections import Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnrisk.llm.tables import for_tasks, steps, stored, with_text

UNKNOWN = "und"
FOLDS = 5
#: Expected number of documents that each language learns from.
SAMPLE = 4000
#: How often a word or n-gram has to occur in a language's sample.
LEAST = 2
ORDERS = (5, 4, 3, 2, 1)
#: Distinct words whose scores a worker remembers.
REMEMBERED = 200_000
#: Text whose new words are looked up at once.
LOOKUP_BYTES = 1 << 20

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    """Runs of letters, lower-cased."""
    return _WORD.findall(text.lower())


def grams_of(word: str, order: int) -> list[str]:
    """The n-grams of a word between border marks."""
    marked = f" {word} "
    return [marked[i : i + order] for i in range(len(marked) - order + 1)]


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document is kept from learning, by its id's checksum."""
    remainder = F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS
    return F.coalesce(remainder == 0, F.lit(True))


class Terms(Mapping):
    """Terms of one order and their rows, which follow each other from ``first`` on.

    Arrow holds them: a worker needs a few bytes for each, and no objects.
    """

    def __init__(self, terms: pa.StringArray, first: int):
        self._terms, self._first = terms, first

    def rows(self, wanted: list[str]) -> np.ndarray:
        """The row of each wanted term, -1 for what is not there. Many at once: each call hashes all terms."""
        found = pc.index_in(pa.array(wanted, pa.string()), value_set=self._terms)
        rows = found.fill_null(-1).to_numpy().astype(np.int64)
        return np.where(rows < 0, -1, rows + self._first)

    def __getitem__(self, term: str) -> int:
        row = int(self.rows([term])[0])
        if row < 0:
            raise KeyError(term)
        return row

    def __iter__(self) -> Iterator[str]:
        return iter(self._terms.to_pylist())

    def __len__(self) -> int:
        return len(self._terms)


@dataclass(frozen=True)
class Model:
    """Log10 relative frequencies: the rows of terms by order, 0 for words, and a column a language."""

    languages: tuple[str, ...]
    rows: dict[int, Terms]
    table: np.ndarray

    def scores(self, words: list[str]) -> np.ndarray:
        """Each word's score for each language; zeros if nothing of it is known."""
        at = self.rows[0].rows(words)
        scores = np.zeros((len(words), len(self.languages)), dtype=np.float32)
        scores[at >= 0] = self.table[at[at >= 0]]
        left = np.flatnonzero(at < 0)
        for order in ORDERS:
            if not len(left):
                break
            grams = [grams_of(words[i], order) for i in left.tolist()]
            owner = np.repeat(np.arange(len(left)), [len(g) for g in grams])
            at = self.rows[order].rows([g for found in grams for g in found])
            owner, at = owner[at >= 0], at[at >= 0]
            some, first, n = np.unique(owner, return_index=True, return_counts=True)
            if len(some):
                means = np.add.reduceat(self.table[at], first) / n[:, None].astype(np.float32)
                scores[left[some]] = means
                left = np.delete(left, some)
        return scores

    def score(self, word: str) -> np.ndarray:
        """One word's score for each language."""
        return self.scores([word])[0]


def model_of(counts: pa.Table, missing: float = -7.0) -> Model:
    """From rows of lang, order, term, n, and total, the count of all terms of that order there."""
    languages = tuple(sorted(pc.unique(counts["lang"]).to_pylist()))
    place = pc.index_in(counts["lang"], pa.array(languages, pa.string())).to_numpy()
    values = np.log10(counts["n"].to_numpy() / counts["total"].to_numpy())
    orders = counts["order"].to_numpy()
    rows: dict[int, Terms] = {}
    n_rows = 0
    at = np.zeros(len(values), dtype=np.int64)
    for order in (0, *ORDERS):
        chosen = np.flatnonzero(orders == order)
        terms = counts["term"].take(pa.array(chosen)).cast(pa.string())
        rows[order] = Terms(pc.unique(terms), n_rows)
        at[chosen] = rows[order].rows(terms.to_pylist())
        n_rows += len(rows[order])
    table = np.full((n_rows, len(languages)), missing, dtype=np.float32)
    table[at, place] = values
    return Model(languages, rows, table)


def _sampled(docs: DataFrame, sample: int) -> DataFrame:
    """lang and text of the labelled documents to learn from, about ``sample`` for each language.

    Documents are taken by a hash of their id, at a rate by language, so nothing
    is shuffled. The driver gets a count for each language, as it gets the model.
    """
    usable = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    counts = usable.groupBy("lang").count().collect()
    share = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 30)) / (1 << 30)
    rate = F.lit(None).cast("double")
    if counts:
        pairs = [F.lit(x) for row in counts for x in (row["lang"], sample / row["count"])]
        rate = F.element_at(F.create_map(*pairs), F.col("lang"))
    return usable.filter(share < rate).select("lang", "text")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in steps(batches):
        words: dict[str, Counter] = {}
        for lang, text in zip(
            batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True
        ):
            words.setdefault(lang, Counter()).update(words_of(text))
        for lang, counted in words.items():
            yield pa.record_batch(
                {
                    "lang": pa.array([lang] * len(counted), pa.string()),
                    "word": pa.array(list(counted), pa.string()),
                    "n": pa.array(list(counted.values()), pa.int64()),
                }
            )


def _terms(words: DataFrame) -> DataFrame:
    """The words (order 0) and their n-grams, each as often as its words: (lang, order, term, n)."""
    marked = F.concat(F.lit(" "), "word", F.lit(" "))

    def grams(order: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.length(marked) - order + 1, F.lit(1)))
        return F.transform(
            starts,
            lambda i: F.struct(
                F.lit(order).alias("order"), F.substring(marked, i, F.lit(order)).alias("term")
            ),
        )

    whole = F.array(F.struct(F.lit(0).alias("order"), F.col("word").alias("term")))
    found = words.select("lang", F.inline(F.concat(whole, *map(grams, ORDERS))), "n")
    # Words shorter than an order leave what is no n-gram of it.
    exact = found.filter("order = 0 or length(term) = order")
    return exact.groupBy("lang", "order", "term").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, sample: int = SAMPLE, least: int = LEAST) -> Model:
    """Learn from a bounded sample of the labelled documents that are not held out.

    What reaches the driver is the sample's terms with ``least`` occurrences.
    """
    for_tasks(docs.sparkSession)
    counted = _sampled(docs, sample).mapInArrow(_count, "lang string, word string, n long")
    per_word = counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))
    terms = stored(_terms(per_word), "terms")
    totals = terms.groupBy("lang", "order").agg(F.sum("n").alias("total"))
    return model_of(terms.filter(F.col("n") >= least).join(totals, ["lang", "order"]).toArrow())


class Scorer:
    """Scores texts, remembering the scores of the words met last."""

    def __init__(self, model: Model):
        self._model = model
        self._place: dict[str, int] = {}
        self._table = np.zeros((0, len(model.languages)))
        self._letters = np.zeros(0, dtype=bool)

    def _learn(self, words: list[str]) -> None:
        at = len(self._place)
        self._place.update((word, at + i) for i, word in enumerate(words))
        need = at + len(words)
        if need > len(self._table):
            room = max(need, 2 * len(self._table))
            table = np.zeros((room, len(self._model.languages)))
            letters = np.zeros(room, dtype=bool)
            table[:at], letters[:at] = self._table[:at], self._letters[:at]
            self._table, self._letters = table, letters
        self._letters[at:need] = [any(map(str.isalpha, word)) for word in words]
        self._table[at:need] = self._model.scores(words) * self._letters[at:need, None]

    def predict(self, text: str) -> tuple[str, float]:
        return self.predict_all([text])[0]

    def predict_all(self, texts: list[str]) -> list[tuple[str, float]]:
        """The language of each text. What is new in all of them is looked up at once."""
        counted = [Counter(words_of(text)) for text in texts]
        new = {word: None for words in counted for word in words if word not in self._place}
        if new and len(self._place) + len(new) > REMEMBERED:
            self._place, self._table, self._letters = {}, self._table[:0], self._letters[:0]
            new = dict.fromkeys(word for words in counted for word in words)
        if new:
            self._learn(list(new))
        return [self._best(words) for words in counted]

    def _best(self, counted: Counter) -> tuple[str, float]:
        at = np.fromiter(map(self._place.__getitem__, counted), np.int64, len(counted))
        if not self._model.languages or not self._letters[at].any():
            return UNKNOWN, 0.0
        times = np.fromiter(counted.values(), float, len(counted))
        sums = times @ self._table[at] * np.log(10)
        best = int(sums.argmax())
        return self._model.languages[best], float(1 / np.exp(sums - sums[best]).sum())


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred and score (0 to 1) of every row."""
    for_tasks(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in steps(batches, most=LOOKUP_BYTES):
            pairs = scorer.predict_all(batch.column("text").to_pylist())
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "lang_pred": pa.array([p[0] for p in pairs], pa.string()),
                    "score": pa.array([p[1] for p in pairs], pa.float64()),
                }
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, lang_pred string, score double"
    return with_text(docs).mapInArrow(predicted, schema)


def accepted(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """All columns of the rows whose language is recognised with at least that probability."""
    for_tasks(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in steps(batches, most=LOOKUP_BYTES):
            pairs = scorer.predict_all([t or "" for t in batch.column("text").to_pylist()])
            yield batch.filter(pa.array([p[0] != UNKNOWN and p[1] >= least for p in pairs]))

    return docs.mapInArrow(kept, docs.schema)
