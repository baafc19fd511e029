import hashlib
import math

import numpy as np
import pytest

from runlens.llm import clusters, trees, vector_codes
from runlens.llm.vectors import limit
from tests.llm.cases import oracle, told

SCHEMA = "vec_id long, embedding array<float>, label int, vector string, cluster string, of_label string, ids string, number string, drawn string"
EXTRA = 6


def frame(spark, rows):
    return spark.createDataFrame([(*r, *["x"] * EXTRA) for r in rows], SCHEMA)


def drawn(n, d, seed=0, centers=12):
    """Vectors around a few centers, with exact copies and nulls among the labels."""
    rnd = np.random.default_rng(seed)
    middle = rnd.normal(size=(centers, d))
    rows = []
    for i in range(n):
        c = int(rnd.integers(0, centers))
        x = middle[0] if i % 3 == 0 else middle[c] + rnd.normal(size=d) / 8
        rows.append((int(i * 7 % n), [float(np.float32(v)) for v in x], None if c == 1 else c % 4))
    return rows


def complete(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def nearest(x, entries):
    """(index, squared distance) of the first nearest of the entries, in Python integers."""
    return min(((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(entries)))[::-1]


def lloyd(points, entries, rounds):
    for _ in range(rounds):
        own = [nearest(x, entries)[0] for x in points]
        groups = [[x for x, k in zip(points, own, strict=True) if k == e] for e in range(len(entries))]
        entries = [[sum(c) // len(g) for c in zip(*g, strict=True)] if g else e for g, e in zip(groups, entries, strict=True)]
    return entries


def brute_codes(rows, parts=4, entries=256, rounds=4, scale=1024):
    kept = [r for r in rows if complete(r[1])]
    order = sorted((r for r in kept if r[1] and len(r[1]) % parts == 0), key=lambda r: (r[0] is None, r[0] or 0, len(r[1])))
    if not order:
        return []
    d = len(order[0][1])
    kept = [(r[0], [math.floor(scale * x) for x in r[1]], r[2]) for r in kept if len(r[1]) == d]
    seeds = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    w = d // parts
    books = [lloyd([r[1][p * w : p * w + w] for r in kept], [s[1][p * w : p * w + w] for s in seeds], rounds) for p in range(parts)]
    name = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    found = [(r[0], [nearest(r[1][p * w : p * w + w], books[p]) for p in range(parts)], r[2]) for r in kept]
    found = [(i, "".join(f"{k:02x}" for k, _ in near), sum(e for _, e in near), label) for i, near, label in found]
    return [(i, code, e, sum(f[2] for f in found if f[3] == label), name) for i, code, e, label in found]


def brute_clusters(rows, k=40, rounds=5):
    kept = [(r[0], [math.floor(256 * x) for x in r[1]]) for r in rows if complete(r[1]) and len(r[1]) == 64]
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))[:k]
    held = lloyd([r[1] for r in kept], [r[1] for r in first], rounds)
    near = [(r[0], *nearest(r[1], held)) for r in kept]
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in held]
    return [(i, c, e, sum(x[2] for x in near if x[1] == c), sum(x[2] for x in near), names[c]) for i, c, e in near]


def odd(d=64):
    """Nulls, non-finite and null components, other lengths, repeated rows, no id, floors below zero."""
    some = drawn(30, d, 5, 3)
    return some + [
        (900, None, 1), (901, [], 1), (902, [float("nan")] + [0.0] * (d - 1), 1), (903, [float("inf")] * d, 1), (904, [None] + [0.0] * (d - 1), 1),
        (905, [0.5] * 7, 2), (906, [-1e-9] * d, None), some[0], some[0], (None, some[3][1], 2), (None, None, None),
    ]


def as_tuples(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("rows", [drawn(700, 64), odd(), odd()[:3], odd()[30:35], []], ids=["drawn", "odd", "few", "none kept", "empty"])
def test_vector_codes(spark, rows):
    assert as_tuples(vector_codes.vector_codes(frame(spark, rows))) == sorted(brute_codes(rows), key=repr)


@pytest.mark.parametrize("rows", [drawn(500, 64, 2), odd(), odd()[:3], odd()[30:35], []], ids=["drawn", "odd", "few", "none kept", "empty"])
def test_clusters(spark, rows):
    assert as_tuples(clusters.clusters(frame(spark, rows))) == sorted(brute_clusters(rows), key=repr)


def test_small_blocks_and_other_parameters(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "BLOCK", 50)
    monkeypatch.setattr(vector_codes, "LEAF", 3)
    monkeypatch.setattr(clusters, "BLOCK", 50)
    monkeypatch.setattr(clusters, "ROWS", 7)
    rows = drawn(300, 12, 3)
    found, _ = vector_codes.compressed(frame(spark, rows), parts=3, entries=9, rounds=3, scale=100)
    want = [r[:3] for r in brute_codes(rows, 3, 9, 3, 100)]
    assert sorted((r.vec_id, r.code, r.error) for r in found.collect()) == sorted(want)
    rows = drawn(300, 64, 4)
    assert as_tuples(clusters.clusters(frame(spark, rows))) == sorted(brute_clusters(rows), key=repr)


def test_sql_of_both(spark):
    rows = drawn(400, 64, 6)
    for query, sql in ((vector_codes.vector_codes, vector_codes.oracle()), (clusters.clusters, clusters.oracle())):
        assert told(query(frame(spark, rows))) == oracle(sql, embeddings=frame(spark, rows))


def test_far_components_stay_exact(spark):
    rows = [(i, [float(x)] * 64, 1) for i, x in enumerate([3e38, -3e38, 0.0, 1.0, 3e38])]
    most = limit(64)
    got = {r.vec_id: (r.cluster, r.distance) for r in clusters.clusters(frame(spark, rows)).collect()}
    assert got[0] == got[4] and {d for _, d in got.values()} == {0}
    assert 64 * (2 * most) ** 2 < 1 << 63
    assert {r.error for r in vector_codes.compressed(frame(spark, rows), entries=2, rounds=0)[0].collect()} == {0, 64 * most * most, 64 * (most - 1024) ** 2}


def test_whole_nodes_are_assigned_by_their_sums():
    rnd = np.random.default_rng(1)
    middle = rnd.integers(-4000, 4000, (16, 4))
    points = (middle[rnd.integers(0, 16, 4000)] + rnd.integers(-3, 4, (4000, 4))).astype(np.int64)
    tree, entries = trees.build(points, 32), trees.build(middle.astype(np.int64), 1)
    owned, leaves, _ = trees.nearest_nodes(tree, entries)
    sizes = [int((trees.starts(4000, level)[nodes + 1] - trees.starts(4000, level)[nodes]).sum()) for level, nodes, _ in owned]
    assert sum(sizes) > 3000 and sum(sizes) + 32 * len(set(leaves.tolist())) >= 4000
    counts, sums, codes = vector_codes._assign(tree, entries, each=False)[0:2] + (vector_codes._assign(tree, entries, each=True)[2],)
    want = trees.nearest(points, middle.astype(np.int64))
    assert (codes == want).all() and (counts == np.bincount(want, minlength=16)).all()
    assert (sums == np.array([points[want == k].sum(axis=0) for k in range(16)])).all()


def test_dictionaries_lose_nothing():
    rnd = np.random.default_rng(2)
    vectors = np.hstack([rnd.integers(0, 3, (600, 6)), rnd.integers(-9999, 9999, (600, 3))]).astype(np.int64)
    held = clusters._encoded(vectors)
    assert (np.hstack([d[c] for d, c in held]) == vectors).all()
    assert max(d.shape[1] for d, _ in held) > 1 and all(len(d) * clusters.SHARING <= 600 or d.shape[1] == 1 for d, _ in held)
