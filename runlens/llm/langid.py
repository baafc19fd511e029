"""Language identification by words first, then by ever shorter character n-grams.

A word seen in training scores by its log frequency in each language. An unseen word falls back to
the longest n-grams of which training knows one: 5, 4, 3, 2, then single letters, with the word's
borders marked. A document's score is the sum over all its words.

Every language is learned from its own bounded sample and keeps its own share of the words and n-grams, so a rare
language is learned beside a frequent one.

Defined results: text that is null or holds no letter gives `und` with score 0, and so does every
document when there are no labelled rows to learn from; `accepted` then keeps documents with letters. Rows with
a null lang teach nothing. Equal scores go to the alphabetically first language. Repeated rows are separate rows;
a null doc_id is kept.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runlens.llm.shared import BATCH_BYTES, SMALL_BATCH, held_out, map_arrow, stored

UNKNOWN = "und"
# Documents of one language that training reads at most, in expectation; a sample by hash of the id.
TRAINING_DOCUMENTS = 2_500
# Words and n-grams kept in the model, shared out evenly: the most frequent of every language.
MODEL_WORDS = 50_000
MODEL_NGRAMS = 50_000
# Languages kept, by number of labelled documents.
MODEL_LANGUAGES = 1024
ORDERS = (5, 4, 3, 2, 1)
SMOOTHING = 0.5
# Counts that a task hands over at a time.
COUNTED_ROWS = 20_000
# Word scores, one for each language, that a task remembers.
MEMO_SCORES = 400_000

_WORD = regex.compile(r"\p{L}+")


def _grams(word: str, n: int) -> list[str]:
    if n == 1:
        return list(word)
    marked = f" {word} "
    return [marked[i : i + n] for i in range(len(marked) - n + 1)] or [marked]


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, kind, term, count) of some batches at a time: kind 0 counts documents, 1 words, 2 n-grams."""
    words: dict[str, Counter] = defaultdict(Counter)
    documents: Counter = Counter()
    held = 0
    for batch in batches:
        for text, lang in zip(batch.column("text"), batch.column("lang"), strict=True):
            documents[lang.as_py()] += 1
            words[lang.as_py()].update(_WORD.findall(text.as_py().lower()))
        held += batch.nbytes
        if held >= BATCH_BYTES:
            yield from _counts(documents, words)
            documents, held = Counter(), 0
    yield from _counts(documents, words)


def _counts(documents: Counter, words: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
    for lang in list(documents):
        counts = words.pop(lang)
        yield from _counted(lang, 0, {"": documents[lang]})
        yield from _counted(lang, 1, counts)
        grams: Counter = Counter()
        for word, n in counts.items():
            for order in ORDERS:
                for gram in _grams(word, order):
                    grams[gram] += n
        yield from _counted(lang, 2, grams)


def _counted(lang: str, kind: int, counts: dict[str, int]) -> Iterator[pa.RecordBatch]:
    """The counts of one language and kind, some at a time, so that a worker holds few of them as rows."""
    held = iter(counts.items())
    while part := list(islice(held, COUNTED_ROWS)):
        terms, n = zip(*part, strict=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(part)), pa.array([kind] * len(part), pa.int32()), pa.array(terms), pa.array(n, pa.int64())],
            names=["lang", "kind", "term", "n"],
        )


class Model:
    """Log frequencies of known words and n-grams, as a sparse matrix of terms and languages.

    `unseen` holds, by order, what a language gives to a term it does not have; order 0 is that of words. A term's
    row holds the differences from it of the languages that have the term.
    """

    def __init__(self, languages: list[str], unseen: np.ndarray, places: list[dict[str, int]], begins: np.ndarray, at: np.ndarray, more: np.ndarray):
        self.languages, self.unseen, self.places = languages, unseen, places
        self.begins, self.at, self.more = begins, at, more

    def of_words(self, words: list[str]) -> np.ndarray:
        """One row of scores for each word; zeros where nothing of it is known."""
        known, grams = self.places
        terms, orders, sizes = [], [], []
        for word in words:
            place = known.get(word)
            if place is not None:
                terms.append(place)
                orders.append(0)
                sizes.append(1)
                continue
            found = 0
            for n in ORDERS:
                for gram in _grams(word, n):
                    place = grams.get(gram)
                    if place is not None:
                        terms.append(place)
                        orders.append(len(gram))
                        found += 1
                if found:
                    break
            sizes.append(found)
        width, counts = len(self.languages), np.array(sizes, np.int64)
        out = np.zeros((len(words), width))
        if not terms:
            return out
        rows, owner = np.array(terms, np.int64), np.repeat(np.arange(len(words)), counts)
        lengths = self.begins[rows + 1] - self.begins[rows]
        first = np.cumsum(lengths) - lengths
        cells = np.repeat(self.begins[rows] - first, lengths) + np.arange(int(lengths.sum()))
        out += np.bincount(np.repeat(owner, lengths) * width + self.at[cells], self.more[cells], out.size).reshape(out.shape)
        some = counts > 0
        out[some] += np.add.reduceat(self.unseen[np.array(orders)], (np.cumsum(counts) - counts)[some], axis=0)
        return out / np.maximum(counts, 1)[:, None]


def train(docs: DataFrame, documents: int = TRAINING_DOCUMENTS) -> Model:
    """Learn from `text` and `lang` of the rows that are not held out, up to `documents` of each language."""
    spark = docs.sparkSession
    known = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out("doc_id"))
    sizes = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(MODEL_LANGUAGES).collect()
    languages = sorted(r["lang"] for r in sizes)
    if not languages:
        return Model([], np.zeros((len(ORDERS) + 1, 0)), [{}, {}], *[np.zeros(1, np.int64)] * 3)
    parts = spark.createDataFrame([(r["lang"], int((1 << 30) * min(1.0, documents / r["n"]))) for r in sizes], "of_lang string, part long")
    drawn = F.pmod(F.xxhash64("doc_id", F.lit("langid")), F.lit(1 << 30)) < F.col("part")
    sample = known.select("doc_id", "lang", "text").join(F.broadcast(parts), F.col("lang") == F.col("of_lang")).where(drawn).select("text", "lang")
    counted = map_arrow(sample, _count_batches, "lang string, kind int, term string, n long", SMALL_BATCH)
    counts = counted.where("kind > 0").groupBy("kind", "term", "lang").agg(F.sum("n").alias("n"))
    # Words are one order of their own, n-grams one order for each length.
    counts = stored(counts.withColumn("order", F.when(F.col("kind") == 1, 0).otherwise(F.length("term"))), "langid")
    share = F.when(F.col("kind") == 1, max(1, MODEL_WORDS // len(languages))).otherwise(max(1, MODEL_NGRAMS // len(languages)))
    place = F.row_number().over(Window.partitionBy("kind", "lang").orderBy(F.desc("n"), "term"))
    kept = counts.withColumn("place", place).where(F.col("place") <= share).select("kind", "term").distinct()
    rows = counts.join(kept, ["kind", "term"]).groupBy("kind", "order", "term").agg(F.sort_array(F.collect_list(F.struct("lang", "n"))).alias("by_lang")).collect()

    number = {lang: i for i, lang in enumerate(languages)}
    lengths = np.array([0, *[len(r["by_lang"]) for r in rows]])
    at = np.array([number[lang] for r in rows for lang, _ in r["by_lang"]], np.int64)
    n = np.array([float(n) for r in rows for _, n in r["by_lang"]])
    orders = np.array([r["order"] for r in rows], np.int64)
    of_cell = np.repeat(orders, lengths[1:])
    total = np.zeros((len(ORDERS) + 1, len(languages)))
    np.add.at(total, (of_cell, at), n)
    terms = np.bincount(orders, minlength=len(total))
    whole = np.log(total + SMOOTHING * np.maximum(terms, 1)[:, None])
    unseen = math.log(SMOOTHING) - whole
    more = np.log(n + SMOOTHING) - math.log(SMOOTHING)
    places: list[dict[str, int]] = [{}, {}]
    for place, r in enumerate(rows):
        places[r["kind"] - 1][r["term"]] = place
    return Model(languages, unseen, places, np.cumsum(lengths), at, more)


class Scorer:
    """Scores texts, remembering a bounded number of word vectors."""

    def __init__(self, model: Model):
        self.model, self.width = model, len(model.languages)
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.vectors = np.zeros((1024, self.width))

    def _places(self, words: list[str]) -> np.ndarray:
        """Rows of the words' scores; those of new words are added."""
        new = [w for w in words if w not in self.place]
        if new:
            held = len(self.place)
            while held + len(new) > len(self.vectors):
                self.vectors = np.concatenate([self.vectors, np.zeros_like(self.vectors)])
            self.vectors[held : held + len(new)] = self.model.of_words(new)
            self.place.update(zip(new, range(held, held + len(new)), strict=True))
        return np.fromiter(map(self.place.__getitem__, words), dtype=np.int64, count=len(words))

    def predict(self, text: str | None) -> tuple[str, float]:
        words = Counter(_WORD.findall(text.lower())) if text else None
        if not words or not self.width:
            return UNKNOWN, 0.0
        if len(self.place) * self.width > MEMO_SCORES:
            self._forget()
        places = self._places(list(words))
        counts = np.fromiter(words.values(), dtype=np.float64, count=len(words))
        # Words of a text depend on each other; the root keeps scores of long texts from all running to 1.
        scaled = (counts @ self.vectors[places]) / math.sqrt(counts.sum())
        best = int(np.argmax(scaled))
        return self.model.languages[best], float(1.0 / np.exp(scaled - scaled[best]).sum())


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shipped.value)
        for batch in batches:
            found = [scorer.predict(text.as_py()) for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array([lang for lang, _ in found], pa.string()),
                    pa.array([score for _, score in found], pa.float64()),
                ],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out("doc_id").alias("held_out"), "text")
    return map_arrow(rows, score, "doc_id long, held_out boolean, lang_pred string, score double", SMALL_BATCH)


def identify(docs: DataFrame) -> DataFrame:
    """Learn from the labelled rows of `docs` and predict all of them."""
    return predict(docs, train(docs))


def accepted(docs: DataFrame) -> DataFrame:
    """The rows of `docs` whose language is told; rows that predict to `und` go. All columns stay.

    Without a labelled row no language can be told; then the rows with letters stay.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model.value)
        place = names.index("text")
        for batch in batches:
            if scorer.width:
                kept = [scorer.predict(text.as_py())[0] != UNKNOWN for text in batch.column(place)]
            else:
                kept = [_WORD.search(text.as_py() or "") is not None for text in batch.column(place)]
            yield batch.filter(pa.array(kept, pa.bool_()))

    names = docs.columns
    return map_arrow(docs, keep, docs.schema, SMALL_BATCH)
