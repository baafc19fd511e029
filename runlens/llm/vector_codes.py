"""Vector code compression by product quantisation, fitted with dual-tree Lloyd rounds.

Vectors become integers and are cut into equal parts; every part position has a codebook of its own. A block
of vectors carries, for each part position, a box tree over its parts with the sum of every node; blocks are
written once. A round sends the codebooks to all blocks. There a second tree over the entries is walked together
with the tree of the parts: bounds of node pairs rule entries out, a node with one entry left is assigned whole
by its stored sum, and parts in leaves that stay uncertain are compared with the entries left, in integers.
Only sums and counts of the entries, whose number is a parameter, reach the driver.

Defined results: rows whose vector is null or holds a null or non-finite component are dropped. All vectors have
the length of the kept vector with the smallest vec_id whose length the number of parts divides; others are
dropped. Components are kept within `vectors.limit`. Rows with the same vec_id are rows of their own; the
first entries are taken in the order of vec_id, null ids last, then of the vector. Fewer rows than entries
make smaller codebooks; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runlens.llm.shared import broadcast_if_small, map_arrow, stored
from runlens.llm.trees import Tree, build, depth_of, exact_type, nearest, nearest_nodes, starts
from runlens.llm.vectors import floor_means, integers, is_complete, list_of, matrix, totals

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
# Vectors of a block; points of a tree leaf. A leaf of entries holds one.
BLOCK, LEAF = 8192, 128

_TREE = {"order": np.int32, "points": np.int32, "low": np.int32, "high": np.int32, "sums": np.int64}


def _blocks(dimension: int, parts: int) -> Callable:
    width = dimension // parts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), BLOCK):
                rows = batch.slice(at, BLOCK)
                vectors = matrix(rows.column("vector"), dimension)
                trees = [build(vectors[:, p * width : (p + 1) * width], LEAF) for p in range(parts)]
                held = {k: pa.array([[getattr(t, k).astype(kind).tobytes() for t in trees]], pa.list_(pa.binary())) for k, kind in _TREE.items()}
                yield pa.RecordBatch.from_pydict({"ids": list_of(rows.column("vec_id")), "labels": list_of(rows.column("label"))} | held)

    return run


def _trees(batch: pa.RecordBatch, row: int, width: int) -> list[Tree]:
    """The trees of a written block, one for each part position."""
    held = [[np.frombuffer(x, kind).astype(np.int64) for x in batch.column(k)[row].as_py()] for k, kind in _TREE.items()]
    return [Tree(order, *[x.reshape(-1, width) for x in rest], depth_of(len(order), LEAF)) for order, *rest in zip(*held, strict=True)]


def _assign(tree: Tree, entries: Tree, each: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts and sums of the entries; with `each`, also the entry of every point in its former order."""
    n, k = len(tree.points), len(entries.points)
    codes = np.full(n, -1, np.int64)
    counts, sums = np.zeros(k, np.int64), np.zeros((k, tree.points.shape[1]), np.int64)
    owned, leaves, others = nearest_nodes(tree, entries)
    for level, nodes, own in owned:
        begins = starts(n, level)
        np.add.at(counts, own, begins[nodes + 1] - begins[nodes])
        np.add.at(sums, own, tree.level(tree.sums, level)[nodes])
        if each:
            for node, entry in zip(nodes, own, strict=True):
                codes[begins[node] : begins[node + 1]] = entry
    begins = starts(n, tree.depth)
    left = entries.order[starts(k, entries.depth)[others]]
    book = entries.points[np.argsort(entries.order)]
    first = np.flatnonzero(np.append(True, leaves[1:] != leaves[:-1])) if len(leaves) else np.zeros(0, np.int64)
    kind = exact_type(np.stack([tree.low[0], tree.high[0]]), book)
    points, book = tree.points.astype(kind), book.astype(kind)
    uncertain = []
    for a, b in zip(first, np.append(first, len(leaves))[1:], strict=True):
        # In their order, so that the first of equal distances has the lowest index.
        some = np.sort(left[a:b])
        lot = slice(begins[leaves[a]], begins[leaves[a] + 1])
        codes[lot] = some[nearest(points[lot], book if len(some) == k else book[some])]
        uncertain.append(np.arange(lot.start, lot.stop))
    if uncertain:
        rows = np.concatenate(uncertain)
        counts += np.bincount(codes[rows], minlength=k)
        for place in range(sums.shape[1]):
            # Doubles add integers exactly below 2**53, which a block's sums are.
            sums[:, place] += np.bincount(codes[rows], tree.points[rows, place], k).astype(np.int64)
    by_row = np.empty(n, np.int64)
    by_row[tree.order] = codes
    return counts, sums, by_row


def _sums(books: np.ndarray) -> Callable:
    parts, k, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = [build(book, 1) for book in books]
        total = np.zeros((parts, k, width + 1), np.int64)
        for batch in batches:
            for row in range(len(batch)):
                for p, tree in enumerate(_trees(batch, row, width)):
                    counts, sums, _ = _assign(tree, entries[p], each=False)
                    total[p, :, 0] += counts
                    total[p, :, 1:] += sums
        part, entry, place = (x.ravel() for x in np.indices(total.shape, dtype=np.int32))
        some = np.repeat((total[:, :, 0] > 0).ravel(), width + 1)
        yield pa.RecordBatch.from_arrays([pa.array(x[some]) for x in (part, entry, place, total.ravel())], names=["group", "entry", "place", "total"])

    return run


def _codes(books: np.ndarray) -> Callable:
    parts, k, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = [build(book, 1) for book in books]
        for batch in batches:
            for row in range(len(batch)):
                ids, labels = batch.column("ids")[row].values, batch.column("labels")[row].values
                codes, error = np.empty((len(ids), parts), np.uint8 if k <= 256 else ">u2"), np.zeros(len(ids), np.int64)
                for p, tree in enumerate(_trees(batch, row, width)):
                    codes[:, p] = _assign(tree, entries[p], each=True)[2]
                    apart = tree.points - books[p][codes[tree.order, p]]
                    error[tree.order] += np.einsum("ij,ij->i", apart, apart)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array([x.tobytes().hex() for x in codes], pa.string()), pa.array(error), labels], names=["vec_id", "code", "error", "label"]
                )

    return run


def compressed(embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, code, error, label) of every kept vector, and the codebooks as [part, entry, place].

    A code has two hex digits for each part, four with more than 256 entries.
    """
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("vector"), "label")
    rows = rows.where(is_complete(F.col("vector")))
    size = F.size("vector")
    leading = rows.where((size > 0) & (size % parts == 0)).select(size.alias("size"), "vec_id").orderBy(F.asc_nulls_last("vec_id"), "size").first()
    if leading is None:
        return embeddings.sparkSession.createDataFrame([], f"vec_id long, code string, error long, label {embeddings.schema['label'].dataType.simpleString()}"), np.zeros((parts, 0, 0), np.int64)
    dimension, width = leading["size"], leading["size"] // parts
    rows = rows.where(size == dimension).select("vec_id", integers(F.col("vector"), scale, dimension).alias("vector"), "label")
    seeds = rows.orderBy(F.asc_nulls_last("vec_id"), "vector").limit(entries).select("vector").collect()
    books = np.array([r.vector for r in seeds], np.int64).reshape(len(seeds), parts, width).transpose(1, 0, 2)
    label = rows.schema["label"].dataType.simpleString()
    trees = ", ".join(f"{k} array<binary>" for k in _TREE)
    blocks = stored(map_arrow(rows, _blocks(dimension, parts), f"ids array<bigint>, labels array<{label}>, {trees}"), "blocks", "zstd")
    for _ in range(rounds):
        found = np.zeros((*books.shape[:2], width + 1), np.int64)
        for r in totals(map_arrow(blocks.drop("ids", "labels"), _sums(books), "group int, entry int, place int, total long")):
            found[r.group, r.entry, r.place] = r.total
        books = floor_means(books, found[:, :, 1:], found[:, :, 0])
    return map_arrow(blocks, _codes(books), f"vec_id long, code string, error long, label {label}"), books


def vector_codes(embeddings: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of every kept vector."""
    found, books = compressed(embeddings)
    found = stored(found, "codes")
    named = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    by_label = stored(found.groupBy(F.col("label").alias("of_label")).agg(F.sum("error").alias("label_error")), "label-errors")
    joined = found.join(broadcast_if_small(by_label, by_label.count()), F.col("label").eqNullSafe(F.col("of_label")), "left")
    return joined.select("vec_id", "code", "error", "label_error", F.lit(named).alias("codebooks_sha256"))


def oracle() -> str:
    """The registered query in SQL: every round compares all parts with all entries of their position."""
    steps = [f"""
        kept AS (
            SELECT vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v, len(embedding) // {PARTS} AS w FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), parts AS MATERIALIZED (
            SELECT vec_id, label, p, v[p * w + 1 : p * w + w] AS x FROM kept, (SELECT unnest(range({PARTS})) AS p)
        ), seeds AS (
            SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept ORDER BY vec_id LIMIT {ENTRIES}
        ), book0 AS MATERIALIZED (SELECT p, e, x AS c FROM parts JOIN seeds USING (vec_id))"""]
    for r in range(ROUNDS + 1):
        steps.append(f"""near{r} AS MATERIALIZED (
            SELECT vec_id, label, p, any_value(x) AS x, min(d * 1024 + e)::BIGINT AS best FROM (
                SELECT parts.*, e, list_inner_product(x, x) - 2 * list_inner_product(x, c) + list_inner_product(c, c) AS d FROM parts JOIN book{r} USING (p)
            ) GROUP BY vec_id, label, p)""")
        if r < ROUNDS:
            steps.append(f"""mean{r} AS (
            SELECT p, e, list(m ORDER BY i) AS c FROM (
                SELECT p, best % 1024 AS e, i, floor(sum(x[i]) / count(*)) AS m
                FROM (SELECT p, best, x, unnest(range(1, len(x) + 1)) AS i FROM near{r}) GROUP BY ALL
            ) GROUP BY p, e
        ), book{r + 1} AS MATERIALIZED (SELECT p, e, coalesce(mean{r}.c, book{r}.c) AS c FROM book{r} LEFT JOIN mean{r} USING (p, e))""")
    return "WITH " + ", ".join(steps) + f""", coded AS (
            SELECT vec_id, label, string_agg(printf('%02x', best % 1024), '' ORDER BY p) AS code, sum(best // 1024)::BIGINT AS error FROM near{ROUNDS} GROUP BY vec_id, label
        ), named AS (
            SELECT sha256(string_agg(n, ',' ORDER BY p, e)) AS codebooks_sha256
            FROM (SELECT p, e, array_to_string(list_transform(c, lambda y: y::BIGINT::VARCHAR), ',') AS n FROM book{ROUNDS})
        )
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM coded, named
    """
