import itertools
import random

from runlens.operators import filters

SCHEMA = "instance_id string, repo string, base_commit string, container string, group_id string, variant string, has_outcomes boolean"


def states(seed, n):
    rnd = random.Random(seed)
    return [
        (
            f"i{i}", rnd.choice(["r0", "r1"]), rnd.choice([None, "c0", "c1", "c2"]), rnd.choice(["x", "x", "x", "y", None]),
            rnd.choice([None, "g0", "g1", "g2", "g3", "g4"]), rnd.choice([None, "base", "fixed"]), rnd.random() < 0.7,
        )
        for i in range(n)
    ]


def chain(rows, rules):
    """First rule that drops each row, rule by rule over the rows still kept."""
    reason = {}
    for name, drops in rules:
        kept = [r for r in rows if r[0] not in reason]
        for r in kept:
            if drops(r, kept):
                reason[r[0]] = name
    return reason


KNOWN, PROFILED = {"g0", "g1", "g3"}, {f"i{i}" for i in range(0, 400, 3)}


def spans(r, kept):
    held = {o[3] for o in kept if (o[1], o[2]) == (r[1], r[2])} - {None}
    return len(held) > 1


RULES = {
    "no group metadata": lambda r, kept: r[4] is None,
    "no test outcomes": lambda r, kept: not r[6],
    "container conflict": spans,
    "unknown group": lambda r, kept: r[4] not in KNOWN,
    "group has no base state": lambda r, kept: r[4] is not None and not any(o[5] == "base" for o in kept if o[4] == r[4]),
    "no profile record": lambda r, kept: r[0] not in PROFILED,
}


def made(spark):
    known = spark.createDataFrame([(g,) for g in [*sorted(KNOWN), "g0"]], "group_id string")
    profiles = spark.createDataFrame([(i, 1) for i in sorted(PROFILED)], "instance_id string, n int")
    rules = [
        filters.without_group(), filters.without_outcomes(), filters.container_conflicts(), filters.unknown_groups(known),
        filters.groups_without_variant("base"), filters.without_profile(profiles),
    ]
    return {rule.name: rule for rule in rules}


def test_chains_of_any_order_match_rule_by_rule(spark):
    rows = states(1, 300)
    df, rules = spark.createDataFrame(rows, SCHEMA), made(spark)
    orders = [list(RULES), list(reversed(RULES))]
    rnd = random.Random(2)
    for size in (1, 2, 4, 5):
        orders.append(rnd.sample(list(RULES), size))
    for order in orders:
        told = filters.judged(df, [rules[name] for name in order])
        assert told.columns == [*df.columns, "reason", "detail"]
        got = {r["instance_id"]: r["reason"] for r in told.collect()}
        want = chain(rows, [(name, RULES[name]) for name in order])
        assert got == {r[0]: want.get(r[0]) for r in rows}, order


def test_details_and_split(spark):
    rows = states(3, 120)
    rules = made(spark)
    kept, dropped = filters.filter_chain(spark.createDataFrame(rows, SCHEMA), [rules["container conflict"], rules["unknown group"]])
    assert kept.columns == SCHEMA.replace(" string", "").replace(" boolean", "").split(", ")
    by_id = {r[0]: r for r in rows}
    for r in dropped.collect():
        assert r["detail"] == by_id[r["instance_id"]][3 if r["reason"] == "container conflict" else 4]
    assert kept.count() + dropped.count() == len(rows)


def test_rows_are_folded_once_and_no_job_runs(spark, tmp_path):
    path = str(tmp_path / "states")
    spark.createDataFrame(states(4, 50), SCHEMA).write.parquet(path)
    df, rules, tracker = spark.read.parquet(path), made(spark), spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    told = filters.judged(df, [rules[name] for name in itertools.islice(RULES, 5)])
    assert set(tracker.getJobIdsForGroup(None)) == before
    told.collect()
    plan = told._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    # Once for the rows and once for the fold, whose exchange the rules share.
    assert plan.count("FileScan") == 2 and plan.count("Exchange") < 20, plan
