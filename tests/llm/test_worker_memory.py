"""What Python workers hold beside the heap of their executor while they hash and count texts."""

from __future__ import annotations

import random
import tracemalloc
from collections import Counter

import pyarrow as pa
import pytest

from runlens.llm import langid, neardup, shared, shingles


def _words(seed: int, n: int) -> list[str]:
    draw = random.Random(seed)
    return ["".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=8)) for _ in range(n)]


def _peak(run) -> int:
    tracemalloc.start()
    try:
        for _ in run():
            pass
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


@pytest.mark.parametrize("function, id_name", [(neardup._sign, "doc_id"), (neardup._sets, "id")])
def test_hashing_a_batch_holds_little_beside_it(monkeypatch, function, id_name):
    monkeypatch.setattr(shingles, "_POWERS", [])
    text = " ".join(_words(1, 200))
    rows = 4_000_000 // len(text)
    batch = pa.RecordBatch.from_arrays([pa.array(range(rows)), pa.array([text] * rows)], names=[id_name, "text"])
    peak = _peak(lambda: function(iter([batch])))
    assert peak < 32 << 20


def test_summing_up_the_sets_of_a_batch_holds_little_beside_it():
    values = pa.array([hash(str(i)) % (1 << 62) for i in range(500_000)], pa.int64())
    sets = pa.ListArray.from_arrays(pa.array(range(0, 500_001, 400), pa.int32()), values)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(sets))), sets], names=["id", "shingles"])
    peak = _peak(lambda: neardup._holders(iter([batch])))
    assert peak < 16 << 20


def test_counts_are_held_as_rows_a_few_at_a_time():
    langs = [f"l{i}" for i in range(6)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([" ".join(_words(i, 8_000)) for i in range(6)]), pa.array(langs)], names=["text", "lang"]
    )
    peak = _peak(lambda: langid._count_batches(iter([batch])))
    assert peak < 24 << 20


@pytest.mark.parametrize("chunk", [7, 100, 1 << 20])
def test_sets_are_the_same_however_texts_are_cut(monkeypatch, chunk):
    texts = [None, "", " \t", "One two", " ".join(_words(2, 300)), "x" * 500, *(" ".join(_words(i, i)) for i in range(3, 20))]
    whole = [one.tolist() for _, _, sets in shingles.shingles_of_rows(pa.array(texts)) for one in sets]
    monkeypatch.setattr(shingles, "CHUNK", chunk)
    monkeypatch.setattr(shingles, "_POWERS", [])
    assert [one.tolist() for _, _, sets in shingles.shingles_of_rows(pa.array(texts)) for one in sets] == whole


def test_counts_of_every_language_are_whole(monkeypatch):
    monkeypatch.setattr(langid, "COUNTED_ROWS", 3, raising=False)
    rows = [("Ab ab c", "x"), ("ab", "y"), ("", "y"), ("12", "z")]
    batch = pa.RecordBatch.from_arrays([pa.array([t for t, _ in rows]), pa.array([lang for _, lang in rows])], names=["text", "lang"])
    found = [tuple(r.values()) for out in langid._count_batches(iter([batch])) for r in out.to_pylist()]
    expected: Counter = Counter()
    for text, lang in rows:
        expected[lang, 0, ""] += 1
        for word in langid._WORD.findall(text.lower()):
            expected[lang, 1, word] += 1
            for order in langid.ORDERS:
                for gram in langid._grams(word, order):
                    expected[lang, 2, gram] += 1
    assert sorted(found) == sorted((*key, n) for key, n in expected.items())


@pytest.mark.parametrize("limit", [1 << 20, 1])
def test_counts_do_not_follow_the_size_of_batches(monkeypatch, limit):
    monkeypatch.setattr(langid, "BATCH_BYTES", limit, raising=False)
    rows = [("Ab ab c", "x"), ("ab", "y"), ("", "y"), ("12 ab", "x")]
    batch = pa.RecordBatch.from_arrays([pa.array([t for t, _ in rows]), pa.array([lang for _, lang in rows])], names=["text", "lang"])
    counted = lambda batches: [tuple(r.values()) for out in langid._count_batches(iter(batches)) for r in out.to_pylist()]
    parts = counted([batch.slice(i, 1) for i in range(len(rows))])
    totals: Counter = Counter()
    for *key, n in parts:
        totals[tuple(key)] += n
    whole = counted([batch])
    assert totals == {tuple(key): n for *key, n in whole}
    assert len(parts) == len(whole) if limit > 1 else len(parts) > len(whole)


def test_batches_are_as_small_as_a_step_or_its_session_asks(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    used = lambda *size: (shared.map_arrow(spark.range(1), lambda batches: batches, "id long", *size), spark.conf.get(key))[1]
    try:
        spark.conf.unset(key)
        assert [used(shared.SMALL_BATCH), used(), used(shared.SMALL_BATCH)] == [str(1 << 20), str(4 << 20), str(1 << 20)]
        spark.conf.set(key, str(2 << 20))
        assert [used(), used(shared.SMALL_BATCH), used()] == [str(2 << 20), str(1 << 20), str(2 << 20)]
        spark.conf.set(key, "1000b")
        assert {used().rstrip("bB"), used(shared.SMALL_BATCH).rstrip("bB")} == {"1000"}
    finally:
        spark.conf.set(key, before)
