import random

from pyspark.sql import functions as F

from runlens.operators import events, ordered
from tests.conftest import rows


def nested(rng, tests, calls):
    """Random call trees; (test, seq of return, depth, func, cost) in return order, and the frames."""
    returns, frames = [], []
    for t in range(tests):
        seq, stack = 0, []
        left = calls
        while left or stack:
            if left and (not stack or (len(stack) < 5 and rng.random() < 0.55)):
                func = rng.choice(["test_a", "test_b", "helper", "other"])
                frames.append((f"s{t}", seq, "call", func, len(stack)))
                stack.append((func, seq, [0]))
                left -= 1
            else:
                func, start, children = stack.pop()
                cost = children[0] + rng.randrange(1, 50) - rng.randrange(0, 3)
                frames.append((f"s{t}", seq, "return", func, len(stack)))
                returns.append((f"s{t}", seq, func, len(stack), max(cost, 0), children[0]))
                if stack:
                    stack[-1][2][0] += max(cost, 0)
            seq += 1
    return returns, frames


def test_exclusive_cost_matches_the_call_stack(spark, small_chunks):
    returns, _ = nested(random.Random(1), 3, 25)
    df = spark.createDataFrame(
        [(t, s, f, "f.py", 1, d, c, 0, c, c) for t, s, f, d, c, _ in returns],
        "test string, seq long, func string, file string, lineno int, depth int, wall_ns long, rss_before long, rss_after long, alloc_inclusive long",
    )
    got = {(r["test"], r["seq"]): (r["exclusive_ns"], r["alloc_exclusive"], r["rss_exclusive"]) for r in events.exclusive_cost(df).collect()}
    assert len(got) == len(returns)
    for t, s, _, _, cost, children in returns:
        assert got[(t, s)] == (max(0, cost - children),) * 3


def test_segments_match_a_state_machine(spark, small_chunks):
    _, frames = nested(random.Random(2), 4, 20)
    df = spark.createDataFrame(frames, "session string, seq long, kind string, func string, depth int")
    want, open_test = [], {}
    for session, seq, kind, func, depth in frames:
        if session not in open_test and kind == "call" and func.startswith("test_"):
            open_test[session] = (func, depth, seq)
        name, at, start = open_test.get(session, ("session", None, None))
        want.append((session, seq, name, start))
        if kind == "return" and at == depth:
            del open_test[session]
    got = events.segment_tests(df).select("session", "seq", "test", "test_start").collect()
    assert sorted(tuple(r) for r in got) == sorted(want)


def simulate_memory(actions):
    """Per-call peaks from a stack walk: (seq, depth, base, incl, excl, delta, excl_delta)."""
    stack, out = [], []
    for seq, kind, cur, peak in actions:
        if stack:
            call = stack[-1]
            call["high"] = max(call["high"], peak - call["base"])
            call["own"] = max(call["own"], peak - call["base"] - call["kept"])
        if kind == "call":
            stack.append({"base": cur, "high": 0, "own": 0, "kept": 0, "child": 0})
        else:
            call = stack.pop()
            incl, delta = max(call["high"], call["child"]), max(0, cur - call["base"])
            out.append((seq, len(stack), incl, max(0, call["own"]), delta, max(0, delta - call["kept"])))
            if stack:
                stack[-1]["child"] = max(stack[-1]["child"], call["base"] - stack[-1]["base"] + incl)
                stack[-1]["kept"] += delta
    return out


def test_memory_peaks_match_a_stack_walk(spark, small_chunks):
    rng = random.Random(3)
    _, frames = nested(rng, 2, 15)
    calls, segments, want = [], [], {}
    for test in ("s0", "s1"):
        actions, depth_of, bases, depth = [], {}, {}, 0
        for _, seq, kind, _, d in [f for f in frames if f[0] == test]:
            cur = rng.randrange(0, 100)
            peak = cur + rng.randrange(0, 100)
            actions.append((seq, kind, cur, peak))
            inner = depth - 1
            if depth:
                segments.append((test, seq, inner, peak))
            if kind == "call":
                bases[depth] = cur
                depth += 1
            else:
                depth -= 1
                calls.append((test, seq, depth, bases[depth], cur))
            depth_of[seq] = d
        for seq, d, incl, excl, delta, excl_delta in simulate_memory(actions):
            want[(test, seq)] = (d, incl, excl, delta, excl_delta)
    got = events.memory_peaks(
        spark.createDataFrame(calls, "test string, seq long, depth int, base long, cur long"),
        spark.createDataFrame(segments, "test string, seq long, depth int, peak long"),
    ).collect()
    assert {(r["test"], r["seq"]): (r["depth"], r["incl_peak"], r["excl_peak"], r["incl_delta"], r["excl_delta"]) for r in got} == want


def test_ordered_helpers_cross_chunk_borders(spark, small_chunks):
    data = [("k", i, i * 10 if i % 4 == 0 else None) for i in range(20)] + [("hot", i, 1) for i in range(11)]
    df = spark.createDataFrame(data, "k string, seq long, v long")
    before = {(r["k"], r["seq"]): r["x"] for r in ordered.nearest(df, ["k"], "seq", "v", "x").collect()}
    after = {(r["k"], r["seq"]): r["x"] for r in ordered.nearest(df, ["k"], "seq", "v", "x", later=True).collect()}
    total = {(r["k"], r["seq"]): r["x"] for r in ordered.running_sum(df, ["k"], "seq", "v", "x").collect()}
    for i in range(20):
        assert before[("k", i)] == i // 4 * 40
        assert after[("k", i)] == (-(-i // 4) * 40 if i <= 16 else None)
        assert total[("k", i)] == sum(j * 10 for j in range(0, i, 4))
    nexts = {(r["k"], r["seq"]): r["next_v"] for r in ordered.next_value(df, ["k"], "seq", ["v"]).collect()}
    assert nexts[("k", 19)] is None and nexts[("k", 3)] == 40 and nexts[("hot", 5)] == 1
    assert rows(ordered.first_rows(df, ["k"], "seq", 5).groupBy("k").agg(F.max("seq"))) == [("hot", 4), ("k", 4)]


def test_phases(spark):
    data = [
        ("a", 1, "setup", "passed", None, 0.1),
        ("a", 2, "call", "failed", "AssertionError: x: y", 0.2),
        ("a", 3, "teardown", "failed", "Boom", 0.3),
        ("b", 1, "setup", "skipped", None, 0.1),
        ("c", 1, "setup", "passed", None, 0.1),
        ("c", 2, "call", "passed", None, 0.5),
        ("d", 1, "setup", "passed", None, 0.1),
        ("e", 1, "call", "failed", "AssertionError: x: y", 0.2),
    ]
    df = spark.createDataFrame(data, "test string, seq long, phase string, outcome string, message string, duration double")
    got = {r["test"]: tuple(r)[1:] for r in events.fold_phases(df).collect()}
    assert got == {
        "a": ("error", "teardown", "Boom", None, False),
        "b": ("skipped", "setup", None, None, False),
        "c": ("passed", None, None, None, False),
        "e": ("failed", "call", "AssertionError", "x: y", True),
    }
    assert rows(events.phase_durations(df.where("test = 'a'"))) == [("a", 0.1, 0.2, 0.3)]


def test_profile_names_at_two_places(spark):
    data = [
        ("t", "m.f", "a.py", 3, 0, 1, 0.5, 1.0),
        ("t", "m.f", "a.py", 3, 1, 2, 0.25, 1.0),
        ("t", "m.f", "b.py", 9, 2, 5, 0.125, 1.0),
        ("t", "m.f", "b.py", 9, 3, 7, 0.0625, 1.0),
    ]
    df = spark.createDataFrame(
        data,
        "test string, name string, filename string, firstlineno int, pos int, call_count long, exclusive_time_s double, inclusive_time_s double",
    )
    assert rows(events.profile_functions(df), "func", "call_count", "exclusive_time_s") == [
        ("m.f", 3, 0.75),
        ("m.f#L9", 7, 0.0625),
    ]


def traced(frames, max_events, max_depth, max_functions):
    """(kept returns, reasons) of one session as a tracer decides them, call by call."""
    stack, known, recorded, kept, reasons = [], set(), 0, [], set()
    ordinal = 0
    for _, _, kind, func, depth in frames:
        if kind == "call":
            if depth >= max_depth:
                reasons.add("max_depth")
                stack.append(None)
            elif recorded >= max_events:
                reasons.add("max_events")
                stack.append(None)
            elif func not in known and len(known) >= max_functions:
                reasons.add("max_functions")
                stack.append(None)
            else:
                known.add(func)
                stack.append(func)
        else:
            ordinal += 1
            if stack.pop() is not None:
                recorded += 1
                kept.append(ordinal)
    return kept, reasons


def test_limits_act_as_a_tracer_does(spark, small_chunks):
    rng = random.Random(8)
    _, frames = nested(rng, 6, 40)
    returns, ordinals = [], {}
    for session, _, kind, func, depth in frames:
        if kind == "return":
            ordinals[session] = ordinals.get(session, 0) + 1
            returns.append((session, ordinals[session], depth, func))
    df = spark.createDataFrame(returns, "test string, seq long, depth int, func string")
    for limits in ((8, 3, 2), (1000, 2, 4), (5, 9, 3), (1, 1, 1), (1000, 99, 99)):
        kept, trims = events.apply_limits(df, *limits)
        assert kept.columns == [*df.columns, "called"]
        got, reasons = {}, {r["test"]: set(r["trim_reasons"]) for r in trims.collect()}
        for r in kept.collect():
            got.setdefault(r["test"], []).append(r["seq"])
        for session in sorted(ordinals):
            want, why = traced([f for f in frames if f[0] == session], *limits)
            assert (sorted(got.get(session, [])), reasons.get(session, set())) == (want, why), (session, limits)


def test_called_at_any_depth_and_over_gaps(spark, small_chunks):
    """Frames whose return was not recorded leave gaps in depth."""
    rng = random.Random(9)
    data = [(f"t{t}", i + 1, rng.choice([0, 1, 5, 30, 31, 200])) for t in range(3) for i in range(60)]
    got = {(r["test"], r["seq"]): r["called"] for r in events.with_called(spark.createDataFrame(data, "test string, seq long, depth int")).collect()}
    want = {(t, s): max([x for u, x, e in data if u == t and x < s and e <= d], default=0) for t, s, d in data}
    assert got == want


def test_memory_peaks_fold_over_chunk_borders(spark, monkeypatch):
    for rows_, chunks in ((2, 3), (1, 2), (5, 1000), (2048, 2048)):
        monkeypatch.setattr(events, "FOLD_ROWS", rows_)
        monkeypatch.setattr(events, "FOLD_CHUNKS", chunks)
        test_memory_peaks_match_a_stack_walk(spark, None)
