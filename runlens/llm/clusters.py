"""Centroid clustering over dictionaries of subvectors.

Vectors become integers. Each block of vectors is dictionary-encoded without loss: single dimensions first, then
neighbouring dimension blocks are joined while their distinct subvectors are few against the vectors. Blocks
are written once, as dictionaries and codes. A round computes the squared distance of every dictionary entry to
every centroid once, and a vector's distance is the sum over its codes; sums for the new centroids come from
counts of codes in the same way. A block's dictionaries are never larger than the block, whatever the data. Only
sums and counts of the centroids, whose number is a parameter, reach the driver.

Defined results: vectors that are null, have another number of components than `dimension`, or hold a null or
non-finite component are left out. Components are kept within `vectors.limit`. Rows with the same vec_id are
rows of their own; of rows with equal hashes the smaller vector comes first, and null ids come last. Fewer rows
than centroids make fewer centroids; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runlens.llm.shared import map_arrow, stored
from runlens.llm.vectors import floor_means, integers, is_complete, list_of, matrix, totals

DIMENSION, CENTROIDS, ROUNDS, SCALE, SEED = 64, 40, 5, 256, 2
# Vectors of a block; a joined dictionary holds one entry for so many of them at least; rows summed at a time.
BLOCK, SHARING, ROWS = 8192, 4, 1024


def _encoded(vectors: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(dictionary, codes) of the dimension blocks from left to right."""
    held = []
    for j in range(vectors.shape[1]):
        values, codes = np.unique(vectors[:, j], return_inverse=True)
        held.append((values[:, None], codes))
    while True:
        joined, at = [], 0
        while at < len(held):
            if at + 1 < len(held):
                (left, a), (right, b) = held[at : at + 2]
                pairs, codes = np.unique(a * len(right) + b, return_inverse=True)
                if len(pairs) * SHARING <= len(vectors):
                    joined.append((np.hstack([left[pairs // len(right)], right[pairs % len(right)]]), codes))
                    at += 2
                    continue
            joined.append(held[at])
            at += 1
        if len(joined) == len(held):
            return held
        held = joined


def _blocks(dimension: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), BLOCK):
                rows = batch.slice(at, BLOCK)
                held = _encoded(matrix(rows.column("vector"), dimension))
                yield pa.RecordBatch.from_arrays(
                    [
                        list_of(rows.column("vec_id")),
                        pa.array([[d.shape[1] for d, _ in held]], pa.list_(pa.int32())),
                        pa.array([[d.astype("<i4").tobytes() for d, _ in held]], pa.list_(pa.binary())),
                        pa.array([[c.astype("<u2").tobytes() for _, c in held]], pa.list_(pa.binary())),
                    ],
                    names=["ids", "widths", "entries", "codes"],
                )

    return run


def _dictionaries(batch: pa.RecordBatch, row: int) -> list[tuple[np.ndarray, np.ndarray]]:
    widths, entries, codes = (batch.column(c)[row].as_py() for c in ("widths", "entries", "codes"))
    return [(np.frombuffer(e, "<i4").astype(np.int64).reshape(-1, w), np.frombuffer(c, "<u2").astype(np.int64)) for w, e, c in zip(widths, entries, codes, strict=True)]


def _nearest(held: list[tuple[np.ndarray, np.ndarray]], centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of the nearest centroid of every vector of a block."""
    tables, at = [], 0
    for entries, _ in held:
        width = entries.shape[1]
        apart = entries[:, None, :] - centroids[None, :, at : at + width]
        tables.append(np.einsum("ekw,ekw->ek", apart, apart))
        at += width
    n = len(held[0][1])
    cluster, distance = np.empty(n, np.int64), np.empty(n, np.int64)
    for a in range(0, n, ROWS):
        total = np.zeros((min(ROWS, n - a), len(centroids)), np.int64)
        for table, (_, codes) in zip(tables, held, strict=True):
            total += table[codes[a : a + ROWS]]
        cluster[a : a + ROWS] = total.argmin(axis=1)
        distance[a : a + ROWS] = total.min(axis=1)
    return cluster, distance


def _sums(centroids: np.ndarray) -> Callable:
    k, dimension = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, dimension + 1), np.int64)
        for batch in batches:
            for row in range(len(batch)):
                held = _dictionaries(batch, row)
                cluster, _ = _nearest(held, centroids)
                total[:, 0] += np.bincount(cluster, minlength=k)
                at = 1
                for entries, codes in held:
                    times = np.bincount(cluster * len(entries) + codes, minlength=k * len(entries)).reshape(k, -1)
                    total[:, at : at + entries.shape[1]] += times @ entries
                    at += entries.shape[1]
        entry, place = (x.ravel() for x in np.indices(total.shape, dtype=np.int32))
        some = np.repeat(total[:, 0] > 0, dimension + 1)
        yield pa.RecordBatch.from_arrays([pa.array(x[some]) for x in (np.zeros_like(entry), entry, place, total.ravel())], names=["group", "entry", "place", "total"])

    return run


def _placed(centroids: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                cluster, distance = _nearest(_dictionaries(batch, row), centroids)
                yield pa.RecordBatch.from_arrays([batch.column("ids")[row].values, pa.array(cluster.astype(np.int32)), pa.array(distance)], names=["vec_id", "cluster", "distance"])

    return run


def clustered(
    embeddings: DataFrame, centroids: int = CENTROIDS, rounds: int = ROUNDS, scale: int = SCALE, dimension: int = DIMENSION, seed: int = SEED
) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance) of every kept vector, and the centroids in order.

    The first centroids are the vectors with the smallest sha256 of "<seed>:<vec_id>".
    """
    vector = F.col("vector")
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("vector"))
    rows = rows.where(is_complete(vector) & (F.size(vector) == dimension)).select("vec_id", integers(vector, scale, dimension).alias("vector"))
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = rows.select("vector", drawn.alias("drawn")).orderBy(F.asc_nulls_last("drawn"), "vector").limit(centroids).collect()
    held = np.array([r.vector for r in first], np.int64).reshape(len(first), dimension)
    if not first:
        return embeddings.sparkSession.createDataFrame([], "vec_id long, cluster int, distance long"), held
    blocks = stored(map_arrow(rows, _blocks(dimension), "ids array<bigint>, widths array<int>, entries array<binary>, codes array<binary>"), "blocks", "zstd")
    for _ in range(rounds):
        found = np.zeros((len(held), dimension + 1), np.int64)
        for r in totals(map_arrow(blocks.drop("ids"), _sums(held), "group int, entry int, place int, total long")):
            found[r.entry, r.place] = r.total
        held = floor_means(held, found[:, 1:], found[:, 0])
    return map_arrow(blocks, _placed(held), "vec_id long, cluster int, distance long"), held


def clusters(embeddings: DataFrame) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every kept vector."""
    found, centroids = clustered(embeddings)
    found = stored(found, "clusters")
    inertia = {r.cluster: r.inertia for r in found.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    each = [(k, inertia.get(k, 0), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for k, c in enumerate(centroids.tolist())]
    named = embeddings.sparkSession.createDataFrame(each, "number int, cluster_inertia long, centroid_sha256 string")
    joined = found.join(F.broadcast(named), F.col("cluster") == F.col("number"))
    return joined.select("vec_id", "cluster", "distance", "cluster_inertia", F.lit(sum(inertia.values())).cast("long").alias("inertia"), "centroid_sha256")


def oracle() -> str:
    """The registered query in SQL: every round compares all vectors with all centroids."""
    steps = [f"""
        kept AS MATERIALIZED (
            SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v FROM embeddings
            WHERE len(embedding) = {DIMENSION} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), cent0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY h) - 1 AS k, v AS c FROM (SELECT v, sha256('{SEED}:' || vec_id) AS h FROM kept ORDER BY h LIMIT {CENTROIDS})
        )"""]
    for r in range(ROUNDS + 1):
        steps.append(f"""near{r} AS MATERIALIZED (
            SELECT vec_id, any_value(v) AS v, min(d * 1024 + k)::BIGINT AS best FROM (
                SELECT kept.*, k, list_inner_product(v, v) - 2 * list_inner_product(v, c) + list_inner_product(c, c) AS d FROM kept, cent{r}
            ) GROUP BY vec_id)""")
        if r < ROUNDS:
            steps.append(f"""mean{r} AS (
            SELECT k, list(m ORDER BY i) AS c FROM (
                SELECT best % 1024 AS k, i, floor(sum(v[i]) / count(*)) AS m FROM (SELECT best, v, unnest(range(1, {DIMENSION + 1})) AS i FROM near{r}) GROUP BY ALL
            ) GROUP BY k
        ), cent{r + 1} AS MATERIALIZED (SELECT k, coalesce(mean{r}.c, cent{r}.c) AS c FROM cent{r} LEFT JOIN mean{r} USING (k))""")
    return "WITH " + ", ".join(steps) + f""", placed AS (
            SELECT vec_id, (best % 1024)::INTEGER AS cluster, (best // 1024)::BIGINT AS distance FROM near{ROUNDS}
        ), named AS (SELECT k, sha256(array_to_string(list_transform(c, lambda y: y::BIGINT::VARCHAR), ',')) AS centroid_sha256 FROM cent{ROUNDS})
        SELECT vec_id, cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
            (sum(distance) OVER ())::BIGINT AS inertia, centroid_sha256
        FROM placed JOIN named ON k = cluster
    """
