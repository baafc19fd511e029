"""Document quality by gradient-boosted trees over histograms of document statistics.

Statistics come straight from the bytes of a text. Their values are binned by quantiles of the training
rows; trees grow level by level from gradient and hessian sums per bin. The trained trees are flattened
into arrays, one row per tree, and a batch of documents walks down all of them together.

Training reads a bounded sample of the labelled rows, `TRAINING_ROWS` in expectation, drawn by a hash of
the id; scoring reads every row.

Defined results: null text has the statistics of an empty one, and both are scored like any other; labels
without a document, null labels and rows held out teach nothing; a document labelled more than once
teaches each label. Without labels of both kinds every score is the share of label 1, or 0.5 without
labels. Repeated rows are scored each for itself; a null doc_id is kept and not held out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runlens.llm.shared import held_out, map_arrow
from runlens.llm.shingles import words_of_rows

TRAINING_ROWS = 12_000
BINS = 64
TREES = 60
DEPTH = 4
RATE = 0.15
LEAST_HESSIAN = 1.0
RIDGE = 1.0
GOOD = 0.7

_CLASSES = {
    "upper": range(65, 91),
    "lower": range(97, 123),
    "digit": range(48, 58),
    "blank": (32, 9),
    "line": (10,),
    "stop": (46, 33, 63),
    "comma": (44, 59, 58),
    "exclamation": (33,),
    "bar": (124,),
    "symbol": (35, 36, 37, 38, 42, 43, 60, 61, 62, 64, 94, 95, 126),
    "bracket": (40, 41, 91, 93, 123, 125),
    "quote": (34, 39, 96),
    "beyond": range(128, 256),
}
STATISTICS = (
    "log_bytes", "log_words", "bytes_per_word", "distinct_words", "top_word", "distinct_triples", "long_run",
    "distinct_lines", "bytes_per_line", *_CLASSES,
)


def _table() -> np.ndarray:
    table = np.zeros((256, len(_CLASSES)), dtype=np.int64)
    for column, values in enumerate(_CLASSES.values()):
        table[list(values), column] = 1
    return table


_CLASS_OF = _table()


def _row(raw: bytes, words: np.ndarray) -> list[float]:
    """The statistics of one text, from its bytes and the hashes of its words in order."""
    size, n = max(len(raw), 1), max(len(words), 1)
    classes = (np.bincount(np.frombuffer(raw, np.uint8), minlength=256) @ _CLASS_OF) / size
    lines = raw.split(b"\n")
    if len(words):
        kinds, counts = np.unique(words, return_counts=True)
        distinct, top = len(kinds) / n, counts.max() / n
    else:
        distinct, top = 1.0, 0.0
    triples = words[:-2] * np.uint64(3) + words[1:-1] * np.uint64(5) + words[2:] * np.uint64(7) if len(words) > 2 else words
    run = (words[1:] == words[:-1]).sum() / n if len(words) > 1 else 0.0
    return [
        float(np.log1p(len(raw))), float(np.log1p(len(words))), len(raw) / n, distinct, top,
        len(np.unique(triples)) / max(len(triples), 1), run, len(set(lines)) / len(lines), len(raw) / len(lines), *classes,
    ]


def statistics(column: pa.Array) -> np.ndarray:
    """One row of `STATISTICS` per text; null counts as empty."""
    out = np.zeros((len(column), len(STATISTICS)))
    for start, end, hashes, counts in words_of_rows(column):
        stops = np.cumsum(counts).tolist()
        for i, a, b in zip(range(start, end), [0, *stops], stops, strict=False):
            raw = column[i].as_py()
            out[i] = _row(raw.encode() if raw else b"", hashes[a:b])
    return out


class Forest:
    """Trees as arrays: for each tree the feature, the bin and the value of its nodes, level by level."""

    def __init__(self, edges: np.ndarray, base: float, feature: np.ndarray, split: np.ndarray, value: np.ndarray):
        self.edges, self.base, self.feature, self.split, self.value = edges, base, feature, split, value

    def binned(self, rows: np.ndarray) -> np.ndarray:
        binned = [np.searchsorted(e, rows[:, j], side="right") for j, e in enumerate(self.edges)]
        return np.array(binned, dtype=np.int16).reshape(len(self.edges), -1).T

    def score(self, rows: np.ndarray) -> np.ndarray:
        binned, total = self.binned(rows), np.full(len(rows), self.base)
        at_row = np.arange(len(rows))
        for feature, split, value in zip(self.feature, self.split, self.value, strict=True):
            node = np.zeros(len(rows), dtype=np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (binned[at_row, feature[node]] > split[node])
            total += value[node - (2**DEPTH - 1)]
        return 1 / (1 + np.exp(-total))


def _grow(binned: np.ndarray, gradient: np.ndarray, hessian: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One tree; a node that gains nothing sends all its rows to the left."""
    inner = 2**DEPTH - 1
    feature, split = np.zeros(inner, dtype=np.int64), np.full(inner, BINS, dtype=np.int64)
    node = np.zeros(len(binned), dtype=np.int64)
    for level in range(DEPTH):
        first, width = 2**level - 1, 2**level
        local = node - first
        best = np.full(width, 1e-6)
        for j in range(binned.shape[1]):
            key = local * BINS + binned[:, j]
            g = np.bincount(key, gradient, width * BINS).reshape(width, BINS)
            h = np.bincount(key, hessian, width * BINS).reshape(width, BINS)
            left_g, left_h = np.cumsum(g, axis=1), np.cumsum(h, axis=1)
            all_g, all_h = left_g[:, -1:], left_h[:, -1:]
            right_g, right_h = all_g - left_g, all_h - left_h
            gain = left_g**2 / (left_h + RIDGE) + right_g**2 / (right_h + RIDGE) - all_g**2 / (all_h + RIDGE)
            gain[(left_h < LEAST_HESSIAN) | (right_h < LEAST_HESSIAN)] = 0
            place = gain.argmax(axis=1)
            better = gain[np.arange(width), place] > best
            best[better] = gain[np.arange(width), place][better]
            feature[first : first + width][better] = j
            split[first : first + width][better] = place[better]
        node = 2 * node + 1 + (binned[np.arange(len(binned)), feature[node]] > split[node])
    leaf = node - inner
    g, h = np.bincount(leaf, gradient, 2**DEPTH), np.bincount(leaf, hessian, 2**DEPTH)
    return feature, split, -RATE * g / (h + RIDGE), leaf


def boosted(rows: np.ndarray, labels: np.ndarray) -> Forest:
    """Fit trees to labels 0 and 1 by log loss."""
    width = rows.shape[1]
    share = float(labels.mean()) if len(labels) else 0.5
    constant = len(labels) == 0 or share in (0.0, 1.0)
    base = float(np.log(share / (1 - share))) if not constant else 0.0 if len(labels) == 0 else 20.0 * (2 * share - 1)
    quantiles = np.linspace(0, 1, BINS)[1:-1]
    edges = [np.unique(np.quantile(rows[:, j], quantiles)) if len(rows) else np.zeros(0) for j in range(width)]
    forest = Forest(edges, base, *(np.zeros((0, 0)),) * 3)
    if constant:
        return forest
    binned, total = forest.binned(rows), np.full(len(rows), base)
    trees = []
    for _ in range(TREES):
        guess = 1 / (1 + np.exp(-total))
        feature, split, value, leaf = _grow(binned, guess - labels, guess * (1 - guess))
        total += value[leaf]
        trees.append((feature, split, value))
    forest.feature, forest.split, forest.value = (np.array(part) for part in zip(*trees, strict=True))
    return forest


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 1024):
            part = batch.slice(start, 1024)
            rows = statistics(part.column("text"))
            values = pa.ListArray.from_arrays(
                np.arange(0, rows.size + 1, len(STATISTICS)).astype(np.int32), pa.array(rows.reshape(-1))
            )
            yield pa.RecordBatch.from_arrays([part.column("label"), values], names=["label", "values"])


def train(docs: DataFrame, labels: DataFrame, most: int = TRAINING_ROWS) -> Forest:
    """Fit to `labels.quality` of the documents that are not held out."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
    known = known.where("doc_id IS NOT NULL AND label IN (0, 1)").where(~held_out("doc_id"))
    count = known.count()
    share = int((1 << 30) * min(1.0, most / max(count, 1)))
    drawn = known.where(F.pmod(F.xxhash64("doc_id", F.lit("quality")), F.lit(1 << 30)) < share)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # The sample is bounded by its parameter, whatever the size of the tables.
    found = map_arrow(
        texts.join(F.broadcast(drawn), "doc_id").select("label", "text"), _measure, "label int, values array<double>"
    ).toPandas()
    rows = np.array(found["values"].tolist()).reshape(-1, len(STATISTICS))
    labels_found = found["label"].to_numpy(dtype=np.float64)
    # The order of rows must not matter to the sums of a later run.
    order = np.lexsort(np.column_stack([rows, labels_found]).T)
    return boosted(rows[order], labels_found[order])


def scored(docs: DataFrame, forest: Forest) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    shipped = docs.sparkSession.sparkContext.broadcast(forest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                score = shipped.value.score(statistics(part.column("text")))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(score), pa.array((score >= GOOD).astype(np.int32))],
                    names=["doc_id", "held_out", "score", "predicted"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out("doc_id").alias("held_out"), "text")
    return map_arrow(rows, run, "doc_id long, held_out boolean, score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from the labelled documents and score all of them."""
    return scored(docs, train(docs, labels))
