import itertools
import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from runlens.llm import decontaminate, fingerprints, neardup
from runlens.llm.components import components
from tests.llm.cases import PROSE, frame, odd, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))


def brute(docs, percent):
    sets = {}
    for r in docs:
        if r.doc_id is not None:
            sets.setdefault(r.doc_id, []).append(shingles(r.text))
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        for x, y in itertools.product(sets[a], sets[b]):
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return sorted((i, max(map(len, sets[i])), find(i), find(i) == i) for i in sets)


def copies(seed):
    """Groups of copies with some words changed, around the threshold."""
    rnd = random.Random(seed)
    rows, n = [], 0
    for g in range(30):
        base = words(1000 + g, rnd.choice([5, 8, 40, 200]))
        for _ in range(rnd.choice([1, 2, 3, 30])):
            w = base.split(" ")
            for _ in range(rnd.choice([0, 0, 1, 2, 4])):
                w[rnd.randrange(len(w))] = rnd.choice(["new", "other", "word"])
            rows.append((n, " ".join(w)))
            n += 1
    return rows


def test_components(spark):
    rnd = random.Random(1)
    links = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)] + [(400 + i, 401 + i) for i in range(70)]
    root = {i: i for pair in links for i in pair}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        p, q = find(a), find(b)
        root[max(p, q)] = min(p, q)
    loose = {i for i in root if all(a == b for a, b in links if i in (a, b))}
    got = {r.id: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: find(i) for i in root if i not in loose}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates(spark, percent, monkeypatch):
    monkeypatch.setattr(neardup, "LEAF", 4)
    docs = frame(spark, copies(percent))
    got = sorted(map(tuple, neardup.near_duplicates(docs, percent).collect()))
    assert got == brute(docs.collect(), percent)


def test_rest_of_deep_nodes(spark, monkeypatch):
    monkeypatch.setattr(neardup, "LEAF", 2)
    monkeypatch.setattr(neardup, "STEPS", ())
    docs = frame(spark, copies(3))
    assert sorted(map(tuple, neardup.near_duplicates(docs).collect())) == brute(docs.collect(), 85)


def test_near_duplicates_of_odd_documents(spark):
    docs = odd(spark)
    assert sorted(map(tuple, neardup.near_duplicates(docs).collect())) == brute(docs.collect(), 85)
    assert neardup.near_duplicates(docs.limit(0)).count() == 0
    kept = neardup.one_of_each(docs, 80)
    assert kept.columns == docs.columns
    # 1, 6, 6 and 2**62 are alike; rows without an id stay, and of a repeated id one row.
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, [1, 2, 3, 4, 5, 7, 8, 9, 10, -5, None, None]))


ITEMS = [
    (1, "If Tom has 3 apples and buys 5 km more apples then how many apples does Tom own in 3 days"),
    (2, "yes"),
    (3, None),
    (4, "the quick brown fox jumps over the lazy dog near the old river bank today"),
    (5, ""),
]
HOLDING = [
    (1, "Some words. If Ann has 7 apples and buys 9 miles more apples then how many apples does Ann own in 7 days thank you", [1]),
    (2, "Some words. If Ann has 7 apples and buys 9 miles more apples then how many apples does Bob own in 8 days thank you", []),
    (3, "Yes!", [2]),
    (4, "oh yes he", []),
    (5, None, []),
    (6, "", []),
    (7, "The quick brown fox jumps over the lazy dog, near the old river bank today.", [4]),
    (8, words(5, 40000) + " the quick brown fox jumps over the lazy dog near the old river bank today " + words(6, 50), [4]),
    (9, "the quick brown fox jumps over the lazy cat", []),
    (None, ITEMS[3][1], [4]),
    (10, "3 4 5 6 7 8 9 10", []),
    (11, "a  b  c d e f", []),
]


def test_decontamination(spark):
    docs = frame(spark, [r[:2] for r in HOLDING])
    items = spark.createDataFrame(ITEMS + [ITEMS[3]], "item_id long, text string")
    got = {r.doc_id: (r.contaminated, r.item_ids) for r in decontaminate.marked(docs, items).collect()}
    assert got == {i: (bool(held), held) for i, _, held in HOLDING}
    clean = decontaminate.clean(docs, items)
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.collect()} == {i for i, _, held in HOLDING if not held}
    # Repeated rows are judged each for itself: halves of an item do not add up.
    half = " ".join(ITEMS[3][1].split()[:9])
    twice = frame(spark, [(1, half), (1, half), (2, ITEMS[3][1]), (2, "other words entirely")])
    assert {(r.doc_id, r.contaminated) for r in decontaminate.marked(twice, items).collect()} == {(1, False), (2, True)}
    assert decontaminate.marked(docs.limit(0), items).count() == 0
    assert not decontaminate.marked(docs, items.limit(0)).where("contaminated").count()
    assert decontaminate.marked(odd(spark), items).count() == odd(spark).count()


def test_names_at_any_place_and_copies_in_any_case(spark):
    opening = "{0} has {1} apples in a big basket. {0} buys {2} more apples at the market. {0} then gives away half of them to friends."
    inside = "On the long way home from school Betty met Carl and Dora near the old mill before they all went to see Emil"
    items = spark.createDataFrame([(1, opening.format("Tom", 3, 5)), (2, inside)], "item_id long, text string")
    rows = [
        (1, opening.format("Ann", 7, 9), [1]), (2, "Read this\n" + opening.format("Ann", 7, 9).replace(" ", "\n"), [1]),
        (3, "Ann has 7 apples in a big basket. Bob buys 9 more apples at the market. Carl then gives away half of them to friends.", []),
        (4, inside.lower(), [2]), (5, inside.upper(), [2]), (6, inside.replace(" Betty", "\nBetty").replace(" Dora", "\nDora"), [2]),
    ]
    got = {r.doc_id: r.item_ids for r in decontaminate.marked(frame(spark, [r[:2] for r in rows]), items).collect()}
    assert got == {i: held for i, _, held in rows}


def test_items_of_few_literal_words(spark):
    items = [
        (1, "Compute 3 + 4 * 5 - 6 / 7 and 8 + 9."), (2, "1 2 3 5 7 11 13 17 19"), (3, "they met Ann, Bob, Carl, Dora, Emil, Fred and Gina"),
        (4, "What is the value of 3 x 4 y 5 z 6 u 7 v 8 w 9 a 10 b 11 c 12"),
    ]
    rows = [(i, f"some words before it {text} and some words after it", [i]) for i, text in items]
    rows += [
        (5, "What is the value of 3 houses in this town when nobody lives there", []), (6, "1 2 3 4 6 8 9 10 12", []),
        (7, "Say: What is the value of 4 x 5 y 6 z 7 u 8 v 9 w 10 a 11 b 12 c 13", [4]), (8, "3 4 5 6 7 8 9 " * 40, []),
    ]
    items = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: r.item_ids for r in decontaminate.marked(frame(spark, [r[:2] for r in rows]), items).collect()}
    assert got == {i: held for i, _, held in rows}


def test_decontamination_by_shuffle(spark, monkeypatch):
    from runlens.llm import shared

    monkeypatch.setattr(shared, "BROADCAST_ROWS", 0)
    test_decontamination(spark)


def bag(text):
    from collections import Counter

    return Counter((text or "").lower().split())


def test_fingerprints(spark):
    import hashlib

    rows = [(i * 3, words(i // 4 * 4 + 1 if i % 4 == 3 else i, 60)) for i in range(120)]
    got = {r.doc_id: r for r in fingerprints.fingerprints(frame(spark, rows), 32).collect()}
    errors = []
    for k, (i, text) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        n = len(text)
        edited = text[: n - n // 2] + after[: n // 2]
        assert (got[i].n_chars, got[i].edited_sha256) == (n, hashlib.sha256(edited.encode()).hexdigest())
        a, b = bag(text), bag(edited)
        errors.append(got[i].near_edited - sum((a & b).values()) / sum((a | b).values()))
    assert abs(sum(errors) / len(errors)) < 0.03
    assert got[0].fingerprint != got[3].fingerprint and got[3].fingerprint == got[9].fingerprint


def test_fingerprints_of_odd_documents(spark):
    got = {r.doc_id: r for r in fingerprints.fingerprints(odd(spark)).collect()}
    assert sorted(got) == sorted({r.doc_id for r in odd(spark).collect()} - {None})
    assert got[1].fingerprint == got[6].fingerprint and got[2].fingerprint == got[3].fingerprint == got[4].fingerprint == "-"
    assert got[2].n_chars == 0 and got[2].near_edited == got[2].near_next == 1.0
    assert got[1].near_next == 0.0
    alone = fingerprints.fingerprints(frame(spark, [(5, PROSE)])).collect()
    assert len(alone) == 1 and alone[0].near_next == 1.0
    assert fingerprints.fingerprints(odd(spark).limit(0)).count() == 0


@pytest.mark.parametrize("similarity", [0.80, 0.85])
def test_miss_chance_is_simulated(similarity):
    """The figure that sets the trees, against drawn signatures walked down drawn paths."""
    assert neardup.miss_chance(similarity, neardup.trees_for(similarity)) <= 5e-5
    assert neardup.miss_chance(similarity + 0.02, neardup.trees_for(similarity)) < 2e-5
    rnd = random.Random(int(similarity * 100))
    trees, missed, pairs = 3, 0, 4000
    for _ in range(pairs):
        equal = [rnd.random() < similarity for _ in range(neardup.COORDINATES)]
        nodes = sum(equal[: neardup._root_count(trees)])
        for _ in range(sum(neardup.STEPS)):
            after = 0
            for _ in range(nodes):
                chosen = {rnd.randrange(neardup.COORDINATES)} | ({rnd.randrange(neardup.COORDINATES)} if rnd.random() < neardup.EXTRA else set())
                after += sum(equal[c] for c in chosen)
            nodes = after
        missed += nodes == 0
    want = neardup.miss_chance(similarity, trees)
    assert abs(missed / pairs - want) < 4 * (want / pairs) ** 0.5 + 0.004


def dense(seed, n, changes):
    """One group of copies of a text, most of whose pairs lie just about the threshold."""
    rnd = random.Random(seed)
    base = words(seed, 120).split(" ")
    rows = []
    for i in range(n):
        w = list(base)
        for _ in range(rnd.choice(changes)):
            w[rnd.randrange(len(w))] = f"new{rnd.randrange(40)}"
        rows.append((i, " ".join(w)))
    return rows


@pytest.mark.parametrize("changes", [[1, 2], [2, 3, 4], [0, 3, 5, 6]])
def test_dense_groups(spark, changes, monkeypatch):
    docs = frame(spark, dense(7, 150, changes))
    want = brute(docs.collect(), 85)
    assert sorted(map(tuple, neardup.near_duplicates(docs).collect())) == want
    monkeypatch.setattr(neardup, "STEPS", (1, 1))
    monkeypatch.setattr(neardup, "LEAF", 3)
    monkeypatch.setattr(neardup, "REST", 20)
    assert sorted(map(tuple, neardup.near_duplicates(docs).collect())) == want


def test_sketches_bound_the_overlap(spark):
    rnd = random.Random(5)
    sets = [(i, rnd.sample(range(-900, 900), rnd.randrange(20, 400))) for i in range(30)] + [(3, rnd.sample(range(-900, 900), 50))]
    join = neardup._Join(None, None, 85)
    join.large_sets = spark.createDataFrame(sets, "id long, shingles array<bigint>")
    held = {r.id: r.sketch for r in join.sketches().collect()}
    assert all(len(v) == neardup.BUCKETS for v in held.values())
    for (i, a), (j, b) in itertools.combinations(sets, 2):
        assert sum(map(min, zip(held[i], held[j], strict=True))) >= len(set(a) & set(b))


def test_tasks_that_read_sets_hold_no_table_of_their_shingles(spark, monkeypatch):
    """Shingles of large nodes are dealt out as they are read, and as many meet in a task whatever the number of sets."""
    plans = {}

    def kept(df, name, *rest):
        plans[name] = df._jdf.queryExecution().executedPlan().toString().split("\n")
        return df

    monkeypatch.setattr(neardup, "stored", kept)
    monkeypatch.setattr(neardup, "MET", 100, raising=False)
    texts = {i: [words(i % 7, 30) + f" {words(100 + i, 20)}"] for i in range(40)} | {50: [words(3, 9), words(900, 12)]}
    docs = frame(spark, [(i, t) for i, held in texts.items() for t in held])
    classes = [(i, len(shingles(t))) for i, held in texts.items() for t in held]
    members = spark.createDataFrame([(1, i, i, 99) for i in texts] + [(2, i, i, 3) for i in (1, 2)], "node long, id long, root long, size long")
    got = {r.id: (r.n, r.common) for r in neardup._Join(docs, spark.createDataFrame(classes, "id long, n long"), 85).common(members).collect()}

    sets = {i: [shingles(t) for t in held] for i, held in texts.items()}
    holders = Counter(s for held in sets.values() for one in held for s in one)
    assert got == {i: (min(map(len, held)), sum(holders[s] > 1 for one in held for s in one)) for i, held in sets.items()}
    at = next(i for i, line in enumerate(plans["common"]) if "Exchange hashpartitioning(shingle#" in line)
    assert "Aggregate" not in plans["common"][at + 1]
    assert f", {-(-sum(n for _, n in classes) // 100)})" in plans["common"][at]


@pytest.mark.parametrize("summed", [1, 7, 1 << 17])
def test_holders_of_shingles(summed, monkeypatch):
    monkeypatch.setattr(neardup, "SUMMED", summed)
    rnd = random.Random(summed)
    rows = [(rnd.randrange(12), rnd.sample(range(-20, 20), rnd.randrange(9))) for _ in range(40)]
    batch = pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows]), pa.array([v for _, v in rows], pa.list_(pa.int64()))], names=["id", "shingles"])
    for one in (batch, batch.slice(5, 20), batch.slice(0, 0)):
        held = defaultdict(list)
        for i, values in zip(one["id"].to_pylist(), one["shingles"].to_pylist(), strict=True):
            for v in values:
                held[v].append(i)
        found = defaultdict(list)
        for out in neardup._holders(iter([one])):
            for r in out.to_pylist():
                found[r["shingle"]].append(r)
        assert {v: sum(r["holders"] for r in rs) for v, rs in found.items()} == {v: len(ids) for v, ids in held.items()}
        assert all(r["id"] in held[v] for v, rs in found.items() for r in rs)


def test_rest_pairs_each_two_classes_once(spark):
    """Every pair of which one lies outside the main component of a shared node, and no pair twice."""
    rnd = random.Random(4)
    root_of = {i: i if i % 5 else 0 for i in range(40)}
    rows = [(node, i, root_of[i], 100, 100) for node in range(12) for i in range(40) if rnd.random() < 0.4]
    mixed = spark.createDataFrame(rows, "node long, id long, root long, n long, common long")
    join = neardup._Join(None, None, 85)
    # All sets are alike, so that no bound leaves out a pair.
    join.large_sets = spark.createDataFrame([(i, list(range(100))) for i in range(40)], "id long, shingles array<bigint>")
    got = sorted(map(tuple, neardup._rest(mixed, join).collect()))
    want = set()
    for node in range(12):
        held = [r[1] for r in rows if r[0] == node]
        sizes = {}
        for i in held:
            sizes[root_of[i]] = sizes.get(root_of[i], 0) + 1
        main = max(sizes, key=lambda r: (sizes[r], r))
        want |= {(min(a, b), max(a, b)) for a in held for b in held if root_of[a] != main and root_of[a] != root_of[b]}
    assert got == sorted(want)
