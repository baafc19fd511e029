import itertools
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from runlens.llm import bitslices, simhash
from tests.llm.cases import frame, odd, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def fingerprint(text):
    w = WORD.findall((text or "").translate(LOWER))
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i : i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def brute(rows, radius=2):
    """Rows of (doc_id, fingerprint) with the smallest id that can be reached."""
    rows = sorted(set(rows))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        if rows[a][0] == rows[b][0] or bin(rows[a][1] ^ rows[b][1]).count("1") <= radius:
            p, q = find(a), find(b)
            root[max(p, q)] = min(p, q)
    return [(i, f"{f:016x}", rows[find(k)][0]) for k, (i, f) in enumerate(rows)]


def near(seed, groups=20):
    """Values around common ones, with a few bits turned."""
    rnd = random.Random(seed)
    out = []
    for _ in range(groups):
        base = rnd.getrandbits(64)
        for _ in range(rnd.choice([1, 2, 3, 40, 90])):
            v = base
            for _ in range(rnd.randrange(5)):
                v ^= 1 << rnd.randrange(64)
            out.append(v)
    return out


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 6])
def test_kernel(radius):
    rnd, values, sizes = random.Random(radius), near(radius), []
    while sum(sizes) < len(values):
        sizes.append(min(rnd.choice([1, 2, 64, 65, 130, 5]), len(values) - sum(sizes)))
    a, b = bitslices.linked(np.array(values, np.uint64), np.array(sizes), radius)
    assert len(a) < len(values) and all(bin(values[x] ^ values[y]).count("1") <= radius for x, y in zip(a.tolist(), b.tolist(), strict=True))
    begin, root = 0, list(range(len(values)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        root[max(find(x), find(y))] = min(find(x), find(y))
    for size in sizes:
        want = brute([(begin + i, values[begin + i]) for i in range(size)], radius)
        assert [find(begin + i) for i in range(size)] == [w[2] for w in want]
        begin += size
    assert [len(x) for x in bitslices.linked(np.zeros(0, np.uint64), np.zeros(0, np.int64), radius)] == [0, 0]


def test_far_blocks_are_abandoned(monkeypatch):
    seen = []
    whole = bitslices._exceeding
    monkeypatch.setattr(bitslices, "_exceeding", lambda planes, *a: seen.append(planes) or whole(planes, *a))
    monkeypatch.setattr(bitslices, "LOOK", 4)
    values = np.arange(200, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    assert len(bitslices.linked(values, np.array([200]), 2)[0]) == 0 and len(seen) == 199


@pytest.mark.parametrize("bucket", [1024, 4])
def test_links_of_all_buckets(spark, monkeypatch, bucket):
    """Large buckets are cut by further bands; no pair is lost."""
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    values = sorted(set(near(11, 12)))
    held = [(i, v - (1 << 64) if v >> 63 else v) for i, v in enumerate(values)]
    classes = spark.createDataFrame(held, "id long, fingerprint long")
    rows = simhash._buckets(classes, 2)
    assert rows.select(F.max(F.size("classes"))).first()[0] <= bucket
    links = [(r.a, r.b) for r in simhash.map_arrow(rows, simhash._links(2), "a long, b long").collect()]
    root = list(range(len(values)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        root[max(find(a), find(b))] = min(find(a), find(b))
    assert [find(i) for i in range(len(values))] == [w[2] for w in brute(list(enumerate(values)))]


def documents(seed):
    rnd = random.Random(seed)
    rows = []
    for g in range(25):
        base = words(500 + g, rnd.choice([1, 2, 3, 60, 400]))
        for _ in range(rnd.choice([1, 2, 6])):
            w = base.split(" ")
            for _ in range(rnd.choice([0, 0, 1])):
                w[rnd.randrange(len(w))] = rnd.choice(["New", "other", "É"])
            rows.append((len(rows), rnd.choice([" ", "\n", " \t "]).join(w)))
    return rows


def test_documents(spark):
    rows = documents(3)
    got = sorted(map(tuple, simhash.near_duplicates(frame(spark, rows)).collect()))
    assert got == brute([(i, fingerprint(t)) for i, t in rows])
    assert len({c for *_, c in got}) < len(got)


def test_odd_documents(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CHUNK", 1000)
    docs = odd(spark)
    more = docs.union(frame(spark, [(7, "other words of the same id")]))
    for df in (docs, more):
        got = sorted(map(tuple, simhash.near_duplicates(df).collect()))
        assert got == brute([(r.doc_id, fingerprint(r.text)) for r in df.collect() if r.doc_id is not None])
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_fingerprint_is_spark_s_hash(spark):
    text = "One two\x1cthree"
    assert simhash.fingerprint(text.encode()) == spark.range(1).select(F.xxhash64(F.lit("one two\x1cthree"))).first()[0] % (1 << 64)
