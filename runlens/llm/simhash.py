"""SimHash near duplicates: fingerprints of 3-word shingles, compared in vertical bit planes.

A bit of a fingerprint is set when it is set in over half of the shingle hashes, repeats included. Documents of
equal fingerprints are one class. Fingerprints within the radius agree on two of `radius` + 2 equal bands of
bits at least, so classes meet under every pair of bands. A bucket of too many classes is cut again, by bands
of the bits not yet fixed, until it fits: no pair within the radius is lost, and when 8 bits are left a bucket
cannot hold more than 256 different fingerprints. Buckets are compared whole, many at a time, by the bit-sliced
kernel of `bitslices`, which returns fewer links than fingerprints.

Defined results: null, empty and white-space texts have fingerprint zero and are linked like any other. Rows
without a doc_id are left out. Rows of one doc_id are one document with all their links, and give one row per
different fingerprint. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runlens.llm.bitslices import BITS, linked
from runlens.llm.components import components
from runlens.llm.shared import map_arrow, stored

WORDS, SEED, RADIUS = 3, 42, 2
# Classes of a bucket that are compared at once; lanes of one call of the kernel; bytes of text read at a time.
BUCKET, LANES, CHUNK = 1024, 1 << 17, 1 << 20


def _chunks(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, some at a time."""
    at = 0
    while at < len(text):
        end = at + CHUNK
        while end < len(text) and text[end] not in b" \t\n\v\f\r":
            end += 1
        # bytes know ASCII only: lower() changes A-Z, split() cuts at space and 9 to 13.
        yield text[at:end].lower().split()
        at = end


def shingle_hashes(text: bytes) -> Iterator[np.ndarray]:
    """XXH64 of all shingles, some at a time; of the whole sequence where it is shorter."""
    kept: list[bytes] = []
    short = True
    for words in _chunks(text):
        words = kept + words
        if len(words) >= WORDS:
            short = False
            joined, ends = b" ".join(words), np.cumsum([len(w) + 1 for w in words])
            begins = (ends - [len(w) + 1 for w in words]).tolist()
            digest = xxhash.xxh64_intdigest
            yield np.array([digest(joined[a:b], SEED) for a, b in zip(begins, (ends[WORDS - 1 :] - 1).tolist(), strict=False)], "<u8")
            words = words[1 - WORDS :]
        kept = words
    if short and kept:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(kept), SEED)], "<u8")


def fingerprint(text: bytes) -> int:
    ones, n = np.zeros(BITS, np.int64), 0
    for hashes in shingle_hashes(text):
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(hashes)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.array([fingerprint((t.as_py() or "").encode()) for t in batch.column("text")], np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], names=["doc_id", "fingerprint"])


def _links(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.asarray(batch.column("classes").value_lengths()).astype(np.int64)
            classes = batch.column("classes").flatten()
            ids, values = (np.asarray(classes.field(c)) for c in ("id", "fingerprint"))
            ends = np.cumsum(sizes)
            at = 0
            while at < len(sizes):
                begin = int(ends[at] - sizes[at])
                stop = max(at + 1, int(np.searchsorted(ends, begin + LANES, side="right")))
                lot = slice(begin, int(ends[stop - 1]))
                a, b = linked(values[lot].view(np.uint64), sizes[at:stop], radius)
                yield pa.RecordBatch.from_arrays([pa.array(ids[lot][a]), pa.array(ids[lot][b])], names=["a", "b"])
                at = stop

    return run


def _cut(value: Column, bits: list[int]) -> Column:
    """The given bits of a value side by side, from runs of neighbours."""
    runs, out, width = [], F.lit(0).cast("long"), 0
    for b in bits:
        if runs and runs[-1][-1] + 1 == b:
            runs[-1].append(b)
        else:
            runs.append([b])
    for run in runs:
        part = F.shiftrightunsigned(value, run[0]).bitwiseAND(F.lit((1 << len(run)) - 1 if len(run) < 64 else -1))
        out = out.bitwiseOR(F.shiftleft(part, width))
        width += len(run)
    return out


def _bands(free: list[int], radius: int) -> list[tuple[list[int], list[int]]]:
    """(bits that agree, bits left free) for every two of the bands that the free bits are cut into."""
    n = radius + 2
    bands = [free[len(free) * i // n : len(free) * (i + 1) // n] for i in range(n)]
    return [(bands[i] + bands[j], [b for k, band in enumerate(bands) if k not in (i, j) for b in band]) for i, j in combinations(range(n), 2)]


def _buckets(classes: DataFrame, radius: int) -> DataFrame:
    """(classes): buckets of at most BUCKET different fingerprints in which every pair within the radius meets."""
    # A way fixes some bits; levels go on from the ways of the buckets that are too large.
    ways = {0: list(range(BITS))}
    rows = classes.select("id", "fingerprint", F.lit(0).alias("way"), F.lit(0).cast("long").alias("bucket"))
    done = None
    while True:
        nexts, entries = {}, []
        for way, free in ways.items():
            each = []
            for agreed, left in _bands(free, radius):
                number = len(nexts) + 1
                nexts[number] = left
                each.append(F.struct(F.lit(number).alias("way"), F.xxhash64("way", "bucket", _cut(F.col("fingerprint"), agreed)).alias("bucket")))
            entries.append(F.when(F.col("way") == way, F.array(*each)))
        rows = rows.select("id", "fingerprint", F.explode(F.coalesce(*entries)).alias("key"))
        sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
        # One row per bucket of two classes at least, counted before any class is gathered.
        rows = stored(rows.join(sizes, "key").select("id", "fingerprint", "key.way", "key.bucket", "size"), "buckets")
        small = rows.where(F.col("size") <= BUCKET).groupBy("way", "bucket")
        small = small.agg(F.collect_list(F.struct("id", "fingerprint")).alias("classes")).select("classes")
        done = small if done is None else done.union(small)
        rows = rows.where(F.col("size") > BUCKET).drop("size")
        if rows.isEmpty():
            return done
        held = {r.way for r in rows.select("way").distinct().collect()}
        ways = {way: nexts[way] for way in held}


def near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint and component_id; fingerprints link at `radius` or fewer differing bits."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id IS NOT NULL")
    found = stored(map_arrow(rows, _fingerprints, "doc_id long, fingerprint long"), "fingerprints")
    classes = stored(found.groupBy("fingerprint").agg(F.min("doc_id").alias("id"), F.count(F.lit(1)).alias("rows")), "classes")
    links = map_arrow(_buckets(classes.select("id", "fingerprint"), radius), _links(radius), "a long, b long")
    # An id with several fingerprints joins their classes.
    several = found.groupBy("doc_id").agg(F.min("fingerprint").alias("low"), F.max("fingerprint").alias("high")).where("low <> high")
    twice = found.join(several.select("doc_id"), "doc_id").join(classes.select("fingerprint", "id"), "fingerprint")
    roots = components(links.union(twice.select("doc_id", "id")))
    named = classes.join(roots.withColumnRenamed("id", "of_id"), F.col("id") == F.col("of_id"), "left")
    named = named.select("fingerprint", F.coalesce("root", "id").alias("component_id"), "rows").where("rows > 1 OR component_id <> id")
    placed = found.join(named.withColumnRenamed("fingerprint", "of_fingerprint"), F.col("fingerprint") == F.col("of_fingerprint"), "left")
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return placed.select("doc_id", digits.alias("fingerprint"), F.coalesce("component_id", "doc_id").alias("component_id")).distinct()
