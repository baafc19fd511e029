"""Call and line events: exclusive costs, summaries, limits, test segments, memory peaks.

Events carry `test` (or a session), a dense ordinal `seq` and a call `depth`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runlens.operators.ordered import first_rows, nearest, next_value, running_max
from runlens.operators.skew import top_n


def with_parent(events: DataFrame, key: str = "test") -> DataFrame:
    """Ordinal of each call's parent: the first later return one level up.

    Events come in return order, so a parent follows its children. Each event is looked up at its
    parent's level and offered at its own; both meet in (test, level).
    """
    child = events.where(F.col("depth") > 0).withColumn("_level", F.col("depth") - 1)
    offered = events.select(key, F.col("depth").alias("_level"), "seq", F.col("seq").alias("_offer"))
    both = child.withColumn("_offer", F.lit(None).cast("long")).unionByName(offered, allowMissingColumns=True)
    found = nearest(both, [key, "_level"], "seq", "_offer", "parent_seq", later=True)
    return found.where(F.col("_offer").isNull()).drop("_offer", "_level")


def exclusive_cost(events: DataFrame, key: str = "test") -> DataFrame:
    """Inclusive cost minus that of the direct children, never below zero."""
    costed = events.withColumn("rss_inclusive", F.greatest(F.lit(0), F.col("rss_after") - F.col("rss_before")))
    narrow = costed.select(key, "seq", "depth", "wall_ns", "alloc_inclusive", "rss_inclusive")
    spent = (
        with_parent(narrow, key)
        .where(F.col("parent_seq").isNotNull())
        .groupBy(key, F.col("parent_seq").alias("seq"))
        .agg(
            F.sum("wall_ns").alias("_wall"),
            F.sum("alloc_inclusive").alias("_alloc"),
            F.sum("rss_inclusive").alias("_rss"),
        )
    )

    def rest(total: str, children: str) -> Column:
        return F.greatest(F.lit(0), F.col(total) - F.coalesce(F.col(children), F.lit(0)))

    return (
        costed.join(spent, [key, "seq"], "left")
        .withColumn("exclusive_ns", rest("wall_ns", "_wall"))
        .withColumn("alloc_exclusive", rest("alloc_inclusive", "_alloc"))
        .withColumn("rss_exclusive", rest("rss_inclusive", "_rss"))
        .drop("_wall", "_alloc", "_rss")
    )


def function_summary(events: DataFrame, key: str = "test") -> DataFrame:
    """Counts, sums and maxima per function; the last call names its file and line."""
    delta = F.col("rss_after") - F.col("rss_before")
    return events.groupBy(key, "func").agg(
        F.max_by("file", "seq").alias("file"),
        F.max_by("lineno", "seq").alias("lineno"),
        F.count(F.lit(1)).alias("call_count"),
        F.sum("wall_ns").alias("total_ns"),
        F.sum("exclusive_ns").alias("exclusive_ns"),
        F.max("wall_ns").alias("max_ns"),
        F.max("depth").alias("max_depth"),
        F.greatest(F.lit(0), F.max(delta)).alias("max_rss_delta"),
        F.sum("alloc_inclusive").alias("total_alloc"),
        F.sum("alloc_exclusive").alias("exclusive_alloc"),
        F.max("alloc_inclusive").alias("max_alloc"),
        F.sum("rss_exclusive").alias("exclusive_rss"),
    )


def line_summary(lines: DataFrame, key: str = "test") -> DataFrame:
    """Hits, time and bytes per file and line."""
    return lines.groupBy(key, "file", "line").agg(
        F.count(F.lit(1)).alias("hits"),
        F.coalesce(F.sum("time_ns"), F.lit(0)).alias("time_ns"),
        F.coalesce(F.sum("alloc_bytes"), F.lit(0)).alias("alloc_bytes"),
    )


def line_costs(events: DataFrame, key: str = "test") -> DataFrame:
    """Time and allocation of each line event, closed by the next event of any kind.

    `kind` is line, call or return. Only a positive allocation counts, and the last line stays open.
    """
    timed = next_value(events, [key], "seq", ["ts_ns", "alloc"])
    return timed.where(F.col("kind") == "line").select(
        key,
        "file",
        "line",
        "seq",
        F.coalesce(F.col("next_ts_ns") - F.col("ts_ns"), F.lit(0)).alias("time_ns"),
        F.greatest(F.lit(0), F.coalesce(F.col("next_alloc") - F.col("alloc"), F.lit(0))).alias("alloc_bytes"),
    )


def with_called(events: DataFrame, key: str = "test") -> DataFrame:
    """`called`: ordinal of the last earlier return of at most the event's own depth, 0 where there is none.

    That return is the last one before the event's call. Between a return and the next one, calls are made from
    the depth of the former to that of the latter; each such depth is offered once, and an event takes the latest
    offer of its own depth.
    """
    depths = next_value(events.select(key, "seq", "depth"), [key], "seq", ["depth"])
    reached = F.when(F.col("next_depth") >= F.col("depth"), F.sequence("depth", "next_depth"))
    offers = depths.select(key, F.explode(reached).alias("depth"), "seq", F.col("seq").alias("_offer"))
    both = events.withColumn("_offer", F.lit(None).cast("long")).withColumn("_asks", F.lit(True))
    both = both.unionByName(offers, allowMissingColumns=True)
    # An offer is made after its return: it stands between two ordinals.
    both = both.withColumn("_at", F.col("seq") * 2 + F.col("_asks").isNull().cast("int"))
    found = nearest(both, [key, "depth"], "_at", "_offer", "called").where("_asks").drop("_offer", "_asks", "_at")
    return found.withColumn("called", F.coalesce("called", F.lit(0).cast("long")))


def apply_limits(
    events: DataFrame, max_events: int, max_depth: int, max_functions: int, key: str = "test"
) -> tuple[DataFrame, DataFrame]:
    """Events a bounded trace keeps, and the limits each test ran into.

    Limits act when a call is made, after the return that `with_called` tells; calls made after the same
    return follow each other in depth. Functions are known in the order of their first call. Calls made before
    the `max_events`-th recorded return are kept, those that enclose it included; later calls count towards the
    event limit only.
    """
    columns = events.columns
    is_shallow = F.col("depth") < max_depth
    called = with_called(events, key)
    uses = called.where(is_shallow).groupBy(key, "func").agg(F.min(F.struct("called", "depth")).alias("_first"))
    # The literal bound prunes before the shuffle; a test knows few functions of the many that it calls.
    known = top_n(uses, [key], [F.col("_first")], max_functions, "_place").select(key, "func", F.lit(True).alias("_known"))
    seen = called.join(known, [key, "func"], "left")
    told = is_shallow & F.col("_known").isNotNull()
    recorded = first_rows(seen.where(told).select(key, "seq"), [key], "seq", max_events).groupBy(key)
    full = recorded.agg(F.count(F.lit(1)).alias("_rows"), F.max("seq").alias("_full")).where(F.col("_rows") == max_events)
    timed = seen.join(full.select(key, "_full"), key, "left")
    in_time = F.col("_full").isNull() | (F.col("called") < F.col("_full"))
    kept = timed.where(told & in_time).select(*columns, "called")
    met = timed.groupBy(key).agg(
        F.bool_or(~is_shallow).alias("_deep"),
        F.bool_or(is_shallow & in_time & F.col("_known").isNull()).alias("_many_functions"),
        F.bool_or(is_shallow & ~in_time).alias("_many_events"),
    )
    names = (("_deep", "max_depth"), ("_many_functions", "max_functions"), ("_many_events", "max_events"))
    reasons = F.array_compact(F.array(*[F.when(F.col(flag), F.lit(name)) for flag, name in names]))
    trims = met.select(key, reasons.alias("trim_reasons"))
    return kept, trims.where(F.size("trim_reasons") > 0)


def call_sequence(events: DataFrame, n: int, key: str = "test") -> tuple[DataFrame, DataFrame]:
    """First n events per test, and the total with a truncation flag."""
    kept = top_n(events, [key], [F.col("seq")], n, "place")
    totals = events.groupBy(key).agg(
        F.count(F.lit(1)).alias("total_call_events"), (F.count(F.lit(1)) > n).alias("call_sequence_truncated")
    )
    return kept, totals


def segment_tests(events: DataFrame, key: str = "session") -> DataFrame:
    """Assign call and return events of a session to the test that is open, else to `session`.

    A test opens at a call of a `test_*` function while none is open and closes at the return of the
    same depth. Calls nest, so a candidate opens a test exactly when no earlier candidate's return
    lies behind it; that is a running maximum over the candidates alone.
    """
    returns = F.when(F.col("kind") == "return", F.col("seq"))
    closed = nearest(events.withColumn("_return", returns), [key, "depth"], "seq", "_return", "_end", later=True)
    candidate = (F.col("kind") == "call") & F.col("func").startswith("test_")
    spans = closed.where(candidate).select(
        key, F.col("seq").alias("start_seq"), "func", F.coalesce("_end", F.lit(2**62)).alias("end_seq")
    )
    # Marks of all candidates in call order; the furthest end seen before a call decides.
    opened = _outermost(spans, key)
    marks = opened.select(
        key, F.col("start_seq").alias("seq"), F.struct("start_seq", "end_seq", F.col("func").alias("test")).alias("_mark")
    )
    marked = events.join(marks, [key, "seq"], "left")
    found = nearest(marked, [key], "seq", "_mark", "_open").drop("_mark")
    inside = F.col("seq") <= F.col("_open.end_seq")
    return found.select(
        "*",
        F.when(inside, F.col("_open.test")).otherwise("session").alias("test"),
        F.when(inside, F.col("_open.start_seq")).alias("test_start"),
    ).drop("_open")


def _outermost(spans: DataFrame, key: str) -> DataFrame:
    """Spans no earlier span of the session covers."""
    seen = running_max(spans, [key], "start_seq", "end_seq", "_reached")
    return seen.where(F.coalesce("_reached", F.lit(-1)) < F.col("start_seq")).drop("_reached")


# Ordinals of a chunk, and chunks of the next wider one, that `memory_peaks` folds at a time.
FOLD_ROWS, FOLD_CHUNKS = 2048, 2048

_OPEN = "array<struct<depth:int,high:bigint,own:bigint,kept:bigint>>"


def _merged(a: Column, b: Column) -> Column:
    """What level `a` holds after `b` followed it: own peaks count net of what callees kept before."""
    return F.struct(
        a["depth"].alias("depth"),
        F.greatest(a["high"], b["high"]).alias("high"),
        F.greatest(a["own"], b["own"] - a["kept"]).alias("own"),
        (a["kept"] + b["kept"]).alias("kept"),
    )


def _onto(levels: Column, one: Column) -> Column:
    """Levels, outermost first, with one more reading; it goes to the innermost level but in broken streams."""
    top = F.try_element_at(levels, F.lit(-1))
    rest = F.slice(levels, 1, F.greatest(F.size(levels) - 1, F.lit(0)))
    spread = F.transform(levels, lambda x: F.when(x["depth"] == one["depth"], _merged(x, one)).otherwise(x))
    missing = F.array_sort(F.concat(levels, F.array(one)))
    has = F.exists(levels, lambda x: x["depth"] == one["depth"])
    return (
        F.when(F.coalesce(top["depth"] < one["depth"], F.lit(True)), F.concat(levels, F.array(one)))
        .when(top["depth"] == one["depth"], F.concat(rest, F.array(_merged(top, one))))
        .otherwise(F.when(has, spread).otherwise(missing))
    )


def _folded(items: Column, item: str, row: str, whole: bool) -> Column:
    """Walk through a chunk's items: (levels, done, rest).

    A reading joins its level. A return takes the levels from its own depth on and leaves its share to its
    caller. Where no shallower level is known yet, the call may have begun before the chunk: what is known goes to
    `rest` with the return, and the caller's level is marked. `whole` chunks begin with the key.
    """
    level = lambda depth, high, own, kept: F.struct(
        depth.cast("int").alias("depth"), high.cast("long").alias("high"), own.cast("long").alias("own"), kept.cast("long").alias("kept")
    )
    none = F.lit(None)
    before = F.array(level(F.lit(-2), none, none, F.lit(0))) if whole else F.array()
    start = F.struct(
        before.cast(_OPEN).alias("levels"),
        F.array().cast(f"array<struct<row:{row},high:bigint,own:bigint,kept:bigint>>").alias("done"),
        F.array().cast(f"array<{item}>").alias("rest"),
    )
    of_level = lambda x: F.struct(none.cast(row).alias("row"), x.alias("level")).cast(item)

    def step(acc: Column, i: Column) -> Column:
        levels, row_of, one = acc["levels"], i["row"], i["level"]
        inside = F.filter(levels, lambda x: x["depth"] >= one["depth"])
        outside = F.filter(levels, lambda x: x["depth"] < one["depth"])
        known = F.size(outside) > 0
        mine = F.get(F.filter(inside, lambda x: x["depth"] == one["depth"]), F.lit(0))
        high = F.array_max(F.transform(inside, lambda x: x["high"]))
        done = F.struct(row_of.alias("row"), high.alias("high"), mine["own"].alias("own"), F.coalesce(mine["kept"], F.lit(0).cast("long")).alias("kept"))
        share = level(one["depth"] - 1, F.greatest(high, row_of["base"]), none, F.greatest(F.lit(0), row_of["cur"] - row_of["base"]))
        returned = F.struct(
            F.when(known, _onto(outside, share)).otherwise(F.array(level(one["depth"] - 1, none, none, F.lit(0)))).alias("levels"),
            F.when(known, F.concat(acc["done"], F.array(done))).otherwise(acc["done"]).alias("done"),
            F.when(known, acc["rest"]).otherwise(F.concat(acc["rest"], F.transform(inside, of_level), F.array(i))).alias("rest"),
        )
        read = F.struct(_onto(levels, one).alias("levels"), acc["done"].alias("done"), acc["rest"].alias("rest"))
        return F.when(row_of.isNull(), read).otherwise(returned)

    return F.aggregate(
        items, start, step, lambda acc: F.struct(acc["done"].alias("done"), F.concat(acc["rest"], F.transform(acc["levels"], of_level)).alias("rest"))
    )


def memory_peaks(calls: DataFrame, segments: DataFrame, key: str = "test") -> DataFrame:
    """Inclusive and exclusive peak and retained bytes per call.

    `calls(test, seq, depth, base, cur)` is one row per return, `segments(test, seq, depth, peak)` one
    row per stretch in which a call was innermost, at the ordinal of the event that ended it.
    Inclusive peak: the highest segment peak or callee base below the call, above its own base.
    Exclusive peak: the highest own segment net of what earlier callees retained.

    A chunk of ordinals is folded in one pass. What it cannot settle, the calls that began before it and the
    levels it leaves open, is as small as the nesting is deep, and is folded again in wider chunks, at last per key.
    """
    item = "struct<row:{0},level:struct<depth:int,high:bigint,own:bigint,kept:bigint>>"
    row = F.struct(*calls.columns)
    row_type = calls.select(row.alias("r")).schema["r"].dataType.simpleString()
    item = item.format(row_type)
    level = lambda high, own: F.struct(
        F.col("depth").cast("int").alias("depth"), high.cast("long").alias("high"), own.cast("long").alias("own"), F.lit(0).cast("long").alias("kept")
    )
    readings = segments.select(key, "seq", F.lit(0).alias("place"), F.struct(F.lit(None).cast(row_type).alias("row"), level(F.col("peak"), F.col("peak")).alias("level")).alias("item"))
    returns = calls.select(key, "seq", F.lit(1).alias("place"), F.struct(row.alias("row"), level(F.lit(None), F.lit(None)).alias("level")).alias("item"))
    rows = readings.unionByName(returns).withColumn("chunk", F.floor(F.col("seq") / FOLD_ROWS))
    settled = []
    for whole in (False, False, True):
        keys = [key] if whole else [key, "chunk"]
        ordered = F.array_sort(F.collect_list(F.struct("seq", "place", "item")))
        folded = rows.groupBy(*keys).agg(F.transform(ordered, lambda x: x["item"]).alias("items"))
        folded = folded.select(*keys, _folded(F.col("items"), item, row_type, whole).alias("f"))
        settled.append(folded.select(F.inline("f.done")))
        if not whole:
            rows = folded.select(key, F.col("chunk").alias("seq"), F.posexplode("f.rest").alias("place", "item"))
            rows = rows.withColumn("chunk", F.floor(F.col("seq") / FOLD_CHUNKS))
    joined = settled[0].unionByName(settled[1]).unionByName(settled[2])
    delta = F.greatest(F.lit(0), F.col("cur") - F.col("base"))
    found = joined.select("row.*", "high", "own", "kept")
    return found.select(
        *calls.columns,
        F.greatest(F.lit(0), F.col("high") - F.col("base")).alias("incl_peak"),
        F.greatest(F.lit(0), F.col("own") - F.col("base")).alias("excl_peak"),
        delta.alias("incl_delta"),
        F.greatest(F.lit(0), delta - F.col("kept")).alias("excl_delta"),
    )


def memory_functions(calls: DataFrame, key: str = "test") -> DataFrame:
    """Sum and maximum of the four quantities per function."""
    quantities = ["incl_peak", "excl_peak", "incl_delta", "excl_delta"]
    return calls.groupBy(key, "func").agg(
        F.count(F.lit(1)).alias("call_count"),
        *[agg(q).alias(f"{q}_{name}") for q in quantities for name, agg in (("sum", F.sum), ("max", F.max))],
    )


def profile_functions(entries: DataFrame, key: str = "test") -> DataFrame:
    """Profiler entries to one record per name.

    The first location of a name keeps it and sums its entries; another location gets a `#L<line>`
    suffix, where a later entry replaces an earlier one.
    """
    place = F.struct("filename", "firstlineno")
    first = entries.groupBy(key, "name").agg(F.min_by(place, "pos").alias("_home"))
    named = entries.join(first, [key, "name"]).withColumn("_at_home", place == F.col("_home"))
    named = named.withColumn(
        "func",
        F.when(F.col("_at_home"), F.col("name")).otherwise(F.concat("name", F.lit("#L"), "firstlineno")),
    )
    numbers = ["call_count", "exclusive_time_s", "inclusive_time_s"]
    kept = [F.when(F.col("_at_home"), F.col(c)) for c in numbers]
    return named.groupBy(key, "func").agg(
        F.max_by("filename", "pos").alias("filename"),
        F.max_by("firstlineno", "pos").alias("firstlineno"),
        *[
            F.coalesce(F.sum(home), F.max_by(F.col(c), F.col("pos"))).alias(c) for c, home in zip(numbers, kept)
        ],
    )


def split_exception(col: Column | str) -> list[Column]:
    """Type, message and assertion flag of `Type: message`; a text without the colon is the type."""
    text = F.col(col) if isinstance(col, str) else col
    head = F.substring_index(text, ": ", 1)
    message = F.when(text.contains(": "), F.substring(text, F.length(head) + 3, F.length(text)))
    kind = F.when(F.length(text) > 0, head)
    return [
        kind.alias("exception_type"),
        message.alias("exception_message"),
        F.coalesce(kind == "AssertionError", F.lit(False)).alias("is_assertion"),
    ]


def fold_phases(phases: DataFrame, key: str = "test") -> DataFrame:
    """Phase reports to one outcome per test.

    The last failing phase decides: error outside the call, failed inside it. Otherwise the first
    skip or passing call does; a test with neither has no outcome.
    """
    failing = F.when(F.col("outcome") == "failed", F.col("seq"))
    other = F.when(
        (F.col("outcome") == "skipped") | ((F.col("outcome") == "passed") & (F.col("phase") == "call")), F.col("seq")
    )
    folded = phases.groupBy(key).agg(
        F.max_by(F.struct("phase", "message"), failing).alias("_failure"),
        F.min_by(F.struct("phase", "outcome"), other).alias("_other"),
    )
    label = F.when(
        F.col("_failure").isNotNull(), F.when(F.col("_failure.phase") == "call", "failed").otherwise("error")
    ).otherwise(F.col("_other.outcome"))
    return folded.select(
        key,
        label.alias("outcome"),
        F.coalesce(
            F.col("_failure.phase"), F.when(F.col("_other.outcome") == "skipped", F.col("_other.phase"))
        ).alias("failure_phase"),
        *split_exception(F.col("_failure.message")),
    ).where(F.col("outcome").isNotNull())


def phase_durations(phases: DataFrame, key: str = "test") -> DataFrame:
    """Setup, call and teardown seconds, the last report of each phase."""
    return phases.groupBy(key).agg(
        *[
            F.max_by("duration", F.when(F.col("phase") == phase, F.col("seq"))).alias(f"{phase}_time_s")
            for phase in ("setup", "call", "teardown")
        ]
    )
