"""Row filters, validation with quarantine, and the dataset filter chain."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runlens.functions.ids import valid_instance_id, valid_test_scope
from runlens.operators.outcomes import has_entries
from runlens.schemas import GROUP_ID_PATH, GROUP_VARIANT_PATH, STATES

REQUIRED_TEXT = ["repo", "container", "command"]


def with_group(states: DataFrame) -> DataFrame:
    """Group id and variant kept in the metadata object."""
    return states.withColumn("group_id", F.get_json_object("metadata", GROUP_ID_PATH)).withColumn(
        "variant", F.get_json_object("metadata", GROUP_VARIANT_PATH)
    )


def validate_states(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split rows into valid states and rows with the names of the rules they break.

    A JSON reader that met fields outside the schema leaves their names in `unknown_fields`.
    """
    rules: dict[str, Column] = {
        "instance_id": F.coalesce(valid_instance_id("instance_id"), F.lit(False)),
        **{name: F.coalesce(F.length(name) > 0, F.lit(False)) for name in REQUIRED_TEXT},
        "patch": F.col("patch").isNull() | (F.length("patch") > 0),
        "test_scope": valid_test_scope("test_scope"),
        "metadata": F.coalesce(F.nullif(F.col("metadata"), F.lit("")), F.lit("{}")).rlike(r"(?s)\A\s*\{")
        & F.try_parse_json(F.coalesce(F.nullif(F.col("metadata"), F.lit("")), F.lit("{}"))).isNotNull(),
    }
    if "unknown_fields" in raw.columns:
        rules["unknown_fields"] = F.coalesce(F.size("unknown_fields") == 0, F.lit(True))
    broken = F.array_compact(F.array(*[F.when(~ok, F.lit(name)) for name, ok in rules.items()]))
    checked = raw.withColumn("broken_rules", broken)
    ok = checked.where(F.size("broken_rules") == 0).drop("broken_rules", "unknown_fields")
    return ok, checked.where(F.size("broken_rules") > 0)


def unknown_fields(record: Column) -> Column:
    """Keys of a JSON object that no state column has."""
    return F.array_except(F.json_object_keys(record), F.array(*[F.lit(name) for name in STATES.names]))


@dataclass(frozen=True)
class Rule:
    """Rows that one rule of a chain drops, with a detail for the report; it sees only what earlier rules kept.

    `drop` looks at the row itself; a function of the column names may choose among forms of rows. With `known`, rows go whose `keys` are not in that table. With `parts`, values
    of all rows of the same keys are folded, each by its aggregate, and `verdict` of the folded values drops the
    keys.
    """

    name: str
    detail: Column
    drop: Column | Callable[[list[str]], Column] | None = None
    keys: tuple[tuple[str, Column], ...] = ()
    known: DataFrame | None = None
    parts: tuple[tuple[Column, Callable[[Column], Column]], ...] = ()
    verdict: Callable[..., Column] | None = None


def _key(name: str, value: Column | None = None) -> tuple[tuple[str, Column], ...]:
    return ((name, F.col(name) if value is None else value),)


def without_group() -> Rule:
    return Rule("no group metadata", F.lit(None).cast("string"), drop=F.col("group_id").isNull())


def without_outcomes() -> Rule:
    """A state that reported no passed, failed or errored test; narrow rows carry `has_outcomes` for it."""

    def drop(columns: list[str]) -> Column:
        return ~(F.col("has_outcomes") if "has_outcomes" in columns else has_entries("passed_tests", "failed_tests", "errored_tests"))

    return Rule("no test outcomes", F.lit(None).cast("string"), drop=drop)


def container_conflicts() -> Rule:
    """Every state of a (repo, commit) stem that spans several containers."""
    stem = (*_key("repo"), *_key("stem", F.coalesce("base_commit", F.lit("\0"))))
    container = F.col("container")
    return Rule("container conflict", container, keys=stem, parts=((container, F.min), (container, F.max)), verdict=lambda low, high: low != high)


def unknown_groups(known: DataFrame) -> Rule:
    return Rule("unknown group", F.col("group_id"), keys=_key("group_id"), known=known.select("group_id"))


def groups_without_variant(variant: str) -> Rule:
    is_variant = F.coalesce(F.col("variant") == variant, F.lit(False))
    return Rule(f"group has no {variant} state", F.col("variant"), keys=_key("group_id"), parts=((is_variant, F.bool_or),), verdict=lambda has: ~has)


def without_profile(profiles: DataFrame) -> Rule:
    return Rule("no profile record", F.col("instance_id"), keys=_key("instance_id"), known=profiles.select("instance_id"))


def _looked_up(df: DataFrame, rule: Rule, names: list[str], flag: str) -> DataFrame:
    """`flag` is true where the key columns `names` are in the rule's table."""
    table = rule.known.distinct().toDF(*[f"_known_{i}" for i in range(len(names))]).withColumn(flag, F.lit(True))
    on = reduce(Column.__and__, [df[name] == table[f"_known_{i}"] for i, name in enumerate(names)])
    return df.join(table, on, "left").drop(*[f"_known_{i}" for i in range(len(names))])


def judged(states: DataFrame, rules: list[Rule]) -> DataFrame:
    """All rows with the first rule that drops them as `reason`, null for kept rows, and a detail.

    The rows are folded once, by the keys of all rules that look at other rows; those keys settle such rules one
    after the other among themselves. One join then brings every row its verdicts, and the first that drops it
    is its reason.
    """
    columns = states.columns
    keys = {name: value for rule in rules if rule.parts for name, value in rule.keys}
    rows, flags = states.withColumns({f"_key_{name}": value for name, value in keys.items()}), {}
    for i, rule in enumerate(rules):
        if rule.drop is not None:
            drop = rule.drop if isinstance(rule.drop, Column) else rule.drop(columns)
            rows, flags[i] = rows.withColumn(f"_drop_{i}", F.coalesce(drop, F.lit(False))), f"_drop_{i}"
        elif rule.known is not None and not all(name in keys for name, _ in rule.keys):
            asked = [f"_asked_{name}" for name, _ in rule.keys]
            rows = _looked_up(rows.withColumns({a: value for a, (_, value) in zip(asked, rule.keys, strict=True)}), rule, asked, f"_found_{i}").drop(*asked)
            rows, flags[i] = rows.withColumn(f"_drop_{i}", F.col(f"_found_{i}").isNull()).drop(f"_found_{i}"), f"_drop_{i}"
    if keys:
        rows = _with_verdicts(rows, rules, [f"_key_{name}" for name in keys], flags)
    reason, detail = F.lit(None).cast("string"), F.lit(None).cast("string")
    for i, rule in reversed(list(enumerate(rules))):
        reason = F.when(F.col(f"_drop_{i}"), F.lit(rule.name)).otherwise(reason)
        detail = F.when(F.col(f"_drop_{i}"), rule.detail).otherwise(detail)
    return rows.select(*columns, reason.alias("reason"), detail.alias("detail"))


def filter_chain(states: DataFrame, rules: list[Rule]) -> tuple[DataFrame, DataFrame]:
    """Kept rows, and dropped rows with the rule that dropped them and a detail."""
    told = judged(states, rules)
    return told.where(F.col("reason").isNull()).select(*states.columns), told.where(F.col("reason").isNotNull())


def _with_verdicts(rows: DataFrame, rules: list[Rule], keys: list[str], flags: dict[int, str]) -> DataFrame:
    """`_drop_<i>` of the rules that are settled by keys; `flags` are those already told by the row itself."""
    folds = []
    for i, rule in enumerate(rules):
        # Only rows that the row-wise rules before it keep count for a rule.
        seen = reduce(Column.__and__, [~F.col(flag) for j, flag in flags.items() if j < i], F.lit(True))
        folds += [fold(F.when(seen, value)).alias(f"_part_{i}_{n}") for n, (value, fold) in enumerate(rule.parts)]
    table, settled = rows.groupBy(*keys).agg(*folds), []
    for i, rule in enumerate(rules):
        own = [f"_key_{name}" for name, _ in rule.keys]
        if i in flags:
            continue
        if rule.known is not None:
            table = _looked_up(table, rule, own, f"_found_{i}").withColumn(f"_drop_{i}", F.col(f"_found_{i}").isNull()).drop(f"_found_{i}")
        else:
            alive = reduce(Column.__and__, [~F.col(flag) for flag in settled], F.lit(True))
            # The table holds a row per combination of keys, whatever the rows behind it.
            same = Window.partitionBy(*own)
            parts = [fold(F.when(alive, F.col(f"_part_{i}_{n}"))).over(same) for n, (_, fold) in enumerate(rule.parts)]
            keyed = reduce(Column.__and__, [F.col(name).isNotNull() for name in own])
            table = table.withColumn(f"_drop_{i}", F.coalesce(rule.verdict(*parts) & keyed, F.lit(False)))
        settled.append(f"_drop_{i}")
    told = table.select(*[F.col(k).alias(f"{k}_") for k in keys], *settled)
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"{k}_")) for k in keys])
    return rows.join(told, same, "left").drop(*keys, *[f"{k}_" for k in keys])


def apply_rule(states: DataFrame, rule: Rule) -> DataFrame:
    """Rows one rule keeps."""
    return filter_chain(states, [rule])[0]


def is_repo_source(col: Column | str) -> Column:
    """Files of the repository itself: relative, real and outside installed packages."""
    name = F.col(col) if isinstance(col, str) else col
    kept = (name != "") & ~name.startswith("/") & ~name.startswith("<") & ~name.contains("site-packages")
    return F.coalesce(kept, F.lit(False))


# Support files a tracer never follows.
SKIPPED_BASENAMES = ["conftest.py", "_swebench_tracer.py", "_trace_wrapper.py"]


def in_project(col: Column | str, roots: list[str], prefixes: list[str], tracer: bool = False) -> Column:
    """Files below any root, limited to allowed prefixes when there are any.

    With `tracer`, installed packages and the harness's own support files are out as well.
    """
    name = F.col(col) if isinstance(col, str) else col
    inside = F.lit(False)
    for root in roots:
        relative = F.ltrim(F.substring(name, len(root) + 1, 1 << 30), F.lit("/"))
        allowed = F.lit(True)
        if prefixes:
            allowed = reduce(Column.__or__, [relative.startswith(p) for p in prefixes])
        inside = inside | (name.startswith(root) & allowed)
    kept = (name != "") & ~name.startswith("<") & inside
    if tracer:
        base = F.substring_index(name, "/", -1)
        kept = kept & ~name.contains("site-packages") & ~base.isin(SKIPPED_BASENAMES)
    return F.coalesce(kept, F.lit(False))


def keep_target_tests(tests: DataFrame, targets: DataFrame) -> DataFrame:
    """Tests named by the instance's target list; without a list every test but `session`."""
    listed = targets.select("instance_id").distinct().withColumn("_listed", F.lit(True))
    named = targets.select("instance_id", "test").distinct().withColumn("_named", F.lit(True))
    joined = tests.join(listed, "instance_id", "left").join(named, ["instance_id", "test"], "left")
    keep = F.when(F.col("_listed"), F.coalesce("_named", F.lit(False))).otherwise(F.col("test") != "session")
    return joined.where(keep).drop("_listed", "_named")


def matches_target(tests: DataFrame, targets: DataFrame) -> DataFrame:
    """As above, but a parametrized variant of a listed bare id counts, and no list accepts all."""
    listed = targets.select("instance_id").distinct().withColumn("_listed", F.lit(True))
    named = targets.select("instance_id", F.col("test").alias("_target")).distinct().withColumn("_named", F.lit(True))
    bare = F.substring_index("test", "[", 1)
    joined = (
        tests.withColumn("_bare", bare)
        .join(listed, "instance_id", "left")
        .join(named.withColumnRenamed("_target", "test"), ["instance_id", "test"], "left")
        .join(
            named.withColumnRenamed("_target", "_bare").withColumnRenamed("_named", "_named_bare"),
            ["instance_id", "_bare"],
            "left",
        )
    )
    keep = F.col("_listed").isNull() | F.col("_named").isNotNull() | F.col("_named_bare").isNotNull()
    return joined.where(keep).select(*tests.columns)


def usable_profiles(functions: DataFrame, workloads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Workloads that passed and spent time in repository code; the rest with a reason."""
    own = functions.where(is_repo_source("filename"))
    spent = own.groupBy("instance_id").agg(
        F.count(F.lit(1)).alias("profiled"), F.count_if(F.col("exclusive_time_s") > 0).alias("positive")
    )
    joined = workloads.join(spent, "instance_id", "left").withColumn("profiled", F.coalesce("profiled", F.lit(0)))
    reason = F.when(
        ~F.col("outcome").eqNullSafe(F.lit("passed")),
        F.concat(F.lit("workload outcome "), F.coalesce("outcome", F.lit("None"))),
    ).when(
        F.coalesce("positive", F.lit(0)) == 0,
        F.concat(F.lit("no repo function spent measurable time ("), F.col("profiled"), F.lit(" profiled)")),
    )
    judged = joined.withColumn("reason", reason)
    keep = judged.where(F.col("reason").isNull()).select(*workloads.columns)
    return keep, judged.where(F.col("reason").isNotNull()).select("instance_id", "reason")


def valid_image(col: Column | str) -> Column:
    """A reference a cluster can pull: it names a registry that is not local."""
    image = F.col(col) if isinstance(col, str) else col
    registry = F.substring_index(image, "/", 1)
    named = image.contains("/") & (registry.contains(".") | registry.contains(":"))
    return named & (registry != "localhost") & ~registry.startswith("localhost:")


def image_digest(col: Column | str) -> Column:
    image = F.col(col) if isinstance(col, str) else col
    return F.when(image.contains("@sha256:"), F.substring_index(image, "@", -1))


def pinned_image(col: Column | str, default: str) -> Column:
    """Pinned by digest, or the default reference."""
    image = F.col(col) if isinstance(col, str) else col
    return image.contains("@sha256:") | (image == default)


def name_filter(df: DataFrame, col: str, include: list[str], exclude: list[str]) -> DataFrame:
    """Rows whose name contains any included and no excluded substring; an empty list does not filter."""

    def any_of(words: list[str]) -> Column:
        return F.exists(F.array(*[F.lit(w) for w in words]), lambda w: F.col(col).contains(w))

    if include:
        df = df.where(any_of(include))
    if exclude:
        df = df.where(~any_of(exclude))
    return df


def operator_matches(col: Column | str, names: list[str]) -> Column:
    """Exact operator name or a `/name` suffix."""
    operator = F.col(col) if isinstance(col, str) else col
    wanted = F.array(*[F.lit(n) for n in names])
    return F.exists(wanted, lambda n: (operator == n) | operator.endswith(F.concat(F.lit("/"), n)))


def aborted_session(col: Column | str) -> Column:
    """An exit code other than 0 (all passed) and 1 (some failed)."""
    code = F.col(col) if isinstance(col, str) else col
    return ~code.isin(0, 1)


def runnable(states: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose command variant is set, and the ids of the rest."""
    ready = F.coalesce(F.length(column), F.lit(0)) > 0
    return states.where(ready), states.where(~ready).select("instance_id")
