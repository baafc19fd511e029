"""Joins that turn outside records into states: predictions, trajectories, workloads, verification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runlens.functions import ids, patches
from runlens.functions.commands import generated_command, workload_command
from runlens.operators.filters import validate_states
from runlens.schemas import GROUP_ID_PATH


def keep_predictions(preds: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Usable predictions with repaired patches, and the rest with a reason."""
    fixed = patches.normalize_patch(F.coalesce("model_patch", F.lit("")))
    reason = F.when(F.col("status").eqNullSafe("error"), "status=error").when(
        ~fixed.rlike(r"\S"), "empty model_patch"
    )
    judged = preds.withColumn("reason", reason)
    kept = judged.where(F.col("reason").isNull()).drop("reason").withColumn("model_patch", fixed)
    return kept, judged.where(F.col("reason").isNotNull())


def truthy(a: Column, b: Column) -> Column:
    """The first value unless it is missing or zero."""
    return F.coalesce(F.nullif(a, F.lit(0).cast("double")), b)


def enrich_predictions(preds: DataFrame, reports: DataFrame, gold: DataFrame) -> DataFrame:
    """Each prediction with its model's report row and the gold report row of its instance."""
    keys = ["model_name_or_path", "instance_id"]
    own = reports.select(
        *keys,
        F.col("human_speedup_ratio").alias("speedup_ratio"),
        F.col("raw_pred_speedup_ratio").alias("lm_speedup"),
        F.col("correctness_pct").alias("eval_correctness_pct"),
        F.col("gold_speedup_ratio").alias("_speedup"),
        F.col("pre_edit_runtime").alias("_runtime"),
    )
    best = gold.select(
        "instance_id",
        F.col("gold_speedup_ratio").alias("_gold_speedup"),
        F.col("correctness_pct").alias("gold_correctness_pct"),
        F.col("pre_edit_runtime").alias("_gold_runtime"),
    )
    return (
        preds.join(own, keys, "left")
        .join(best, "instance_id", "left")
        .withColumn("gold_speedup", truthy(F.col("_speedup"), F.col("_gold_speedup")))
        .withColumn("pre_edit_runtime", truthy(F.col("_runtime"), F.col("_gold_runtime")))
        .drop("_speedup", "_runtime", "_gold_speedup", "_gold_runtime")
    )


FACTS = [
    "model_name_or_path",
    "harness",
    "source_path",
    "trajectory_length",
    "speedup_ratio",
    "lm_speedup",
    "eval_correctness_pct",
    "gold_speedup",
    "gold_correctness_pct",
    "pre_edit_runtime",
]


def _without_last(col: Column) -> Column:
    """An id without its last segment."""
    parts = F.split(col, ids.SEPARATOR)
    return F.array_join(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))), ids.SEPARATOR)


def prediction_states(base: DataFrame, enriched: DataFrame, rebuild_command: str) -> DataFrame:
    """The base state of each group with every prediction's patch on top.

    Container, command and scope are inherited; the joined facts go into the metadata.
    """
    meta = F.col("metadata")
    rows = base.withColumn("_group", F.get_json_object(meta, GROUP_ID_PATH)).join(
        enriched.withColumnRenamed("instance_id", "_group"), "_group"
    )
    facts = F.struct(*[F.col(c) for c in FACTS if c in enriched.columns])
    metadata = F.to_json(
        F.struct(
            F.get_json_object(meta, "$.base_id").alias("base_id"),
            F.struct(
                F.get_json_object(meta, "$.swefficiency.dataset").alias("dataset"),
                F.col("_group").alias("instance_id"),
                F.lit("prediction").alias("variant"),
                facts.alias("prediction"),
            ).alias("swefficiency"),
            F.lit(rebuild_command).alias("rebuild_command"),
        )
    )
    suffix = F.replace(F.col("source_stem"), F.lit("__"), F.lit("_"))
    return rows.select(
        ids.state_id(_without_last(F.col("instance_id")), F.concat(F.lit("prediction_"), suffix)).alias("instance_id"),
        "repo",
        "base_commit",
        F.col("model_patch").alias("patch"),
        "container",
        "command",
        "test_scope",
        metadata.alias("metadata"),
    )


def trajectory_states(base: DataFrame, trajectories: DataFrame, dataset: str) -> DataFrame:
    """Golden base states with each trajectory's diff; empty diffs are dropped, provenance is inherited."""
    own = "$.rebench_integration"
    meta = F.col("metadata")
    rows = base.withColumn("rebench_instance_id", F.get_json_object(meta, f"{own}.rebench_instance_id")).join(
        trajectories.select(F.col("instance_id").alias("rebench_instance_id"), "trajectory_id", F.col("patch").alias("_diff")),
        "rebench_instance_id",
    )
    rows = rows.where(F.col("_diff").rlike(r"\S"))
    stem = _without_last(F.col("instance_id"))
    new_id = F.concat(stem, F.lit("__rebench_trajectory_"), "trajectory_id")
    inherited = F.from_json(F.get_json_object(meta, f"{own}.integration_failures"), "array<string>")
    metadata = F.to_json(
        F.struct(
            F.get(F.split(new_id, ids.SEPARATOR), F.lit(1)).alias("base_id"),
            F.struct(
                F.get_json_object(meta, f"{own}.dataset").alias("dataset"),
                "rebench_instance_id",
                F.get_json_object(meta, f"{own}.golden_commit").alias("golden_commit"),
                F.get_json_object(meta, f"{own}.rebench_base_commit").alias("rebench_base_commit"),
                F.col("instance_id").alias("parent"),
                "trajectory_id",
                F.lit(dataset).alias("trajectory_dataset"),
                F.coalesce(inherited, F.array().cast("array<string>")).alias("integration_failures"),
            ).alias("rebench_integration"),
        )
    )
    return rows.select(
        new_id.alias("instance_id"),
        "repo",
        "base_commit",
        F.col("_diff").alias("patch"),
        "container",
        "command",
        "test_scope",
        metadata.alias("metadata"),
    )


def add_workload(states: DataFrame, workloads: DataFrame, strip_scopes: list[str]) -> DataFrame:
    """Workload command of each state by the group id of its metadata; null without one."""
    bodies = workloads.select(F.col("instance_id").alias("_group"), F.nullif("workload", F.lit("")).alias("_body"))
    joined = states.withColumn("_group", F.get_json_object("metadata", GROUP_ID_PATH)).join(bodies, "_group", "left")
    return joined.withColumn("command_workload", workload_command("command", "_body", strip_scopes)).drop("_group", "_body")


def attach_generated(states: DataFrame, generated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Generated workload by pair key: four id segments, else two and the metadata's problem id.

    Skipped rows come back with the reason.
    """
    parts = F.split("instance_id", ids.SEPARATOR)
    problem = F.nullif(F.get_json_object("metadata", GROUP_ID_PATH), F.lit(""))
    keyed = states.withColumn("_long", F.array_join(F.slice(parts, 1, 4), ids.SEPARATOR)).withColumn(
        "_short", F.concat_ws(ids.SEPARATOR, F.array_join(F.slice(parts, 1, 2), ids.SEPARATOR), problem)
    )
    keyed = keyed.withColumn("_short", F.when(problem.isNotNull(), F.col("_short")))
    long = generated.select(F.col("pair").alias("_long"), F.col("content").alias("_by_long"))
    short = generated.select(F.col("pair").alias("_short"), F.col("content").alias("_by_short"))
    joined = keyed.join(long, "_long", "left").join(short, "_short", "left")
    content = F.coalesce("_by_long", "_by_short")
    built = joined.withColumn("command_workload_amplified", generated_command("command", content)).withColumn(
        "reason",
        F.when(content.isNull(), "no generated workload for this row's pair").when(
            F.col("command_workload_amplified").isNull(), "command cannot take a workload"
        ),
    )
    extra = ["_long", "_short", "_by_long", "_by_short"]
    rows = built.where(F.col("reason").isNull()).drop(*extra, "reason")
    return rows, built.where(F.col("reason").isNotNull()).select("instance_id", "reason")


def with_registry(states: DataFrame, registry: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Parser, default command and default scope by base key; states without an entry are errors."""
    entries = registry.select("repo", "base_ref", "parser", "default_command", "default_scope", F.lit(True).alias("_known"))
    joined = states.withColumn("base_ref", ids.base_ref()).join(entries, ["repo", "base_ref"], "left")
    known = F.col("_known").isNotNull()
    return joined.where(known).drop("_known"), joined.where(~known).select("instance_id", "repo", "base_ref")


def verify_golden(rows: DataFrame, cache: DataFrame, prs: DataFrame, diffs: DataFrame) -> DataFrame:
    """Golden commit of each row or the first check it fails; a cached commit wins.

    `prs(repo, number, status, merged, base_sha, merge_commit_sha)` and `diffs(repo, number, kind,
    text)`, kind landed or request, are recorded answers; a null status or text means none came.
    """
    number = ids.trailing_number("instance_id")
    combined = patches.concat_patches(
        *[F.when(F.col(c).rlike(r"\S"), F.col(c)) for c in ("patch", "test_patch")]
    )
    keyed = rows.withColumn("number", number).withColumn("_own", patches.diff_fingerprint(combined))
    fetched = diffs.where(F.col("text").isNotNull()).withColumn("_print", patches.diff_fingerprint("text"))
    by_kind = fetched.groupBy("repo", "number").agg(
        F.max(F.when(F.col("kind") == "landed", F.col("_print"))).alias("_landed"),
        F.max(F.when(F.col("kind") == "request", F.col("_print"))).alias("_request"),
        F.lit(True).alias("_fetched"),
    )
    known = cache.select("instance_id", F.col("golden_commit").alias("_cached"))
    joined = (
        keyed.join(known, "instance_id", "left")
        .join(prs, ["repo", "number"], "left")
        .join(by_kind, ["repo", "number"], "left")
    )

    def blank(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit("")) == ""

    status, own = F.col("status"), F.col("_own")
    error = (
        F.when(F.col("_cached").isNotNull(), F.lit(None).cast("string"))
        .when(~F.coalesce("patch", F.lit("")).rlike(r"\S"), "no_patch")
        .when(blank("repo") | blank("base_commit") | blank("instance_id"), "missing_fields")
        .when(F.col("number").isNull(), "unparseable_pr_number")
        .when(status.isNull(), "pr_fetch_failed")
        .when(status == 404, "pr_not_found")
        .when(status != 200, "pr_fetch_failed")
        .when(~F.coalesce("merged", F.lit(False)), "pr_not_merged")
        .when(~F.col("base_sha").eqNullSafe(F.col("base_commit")), "base_commit_mismatch")
        .when(blank("merge_commit_sha"), "no_merge_commit")
        .when(own.isNull(), "patch_id_failed")
        .when((own == F.col("_landed")) | (own == F.col("_request")), F.lit(None).cast("string"))
        .when(F.col("_fetched").isNull(), "diff_fetch_failed")
        .otherwise("diff_mismatch")
    )
    return joined.select(
        "instance_id",
        F.when(error.isNull(), F.coalesce("_cached", "merge_commit_sha")).alias("golden_commit"),
        error.alias("error"),
    )


def integration_mode() -> list[Column]:
    """How the golden base is built from the two check results, and the failures on record."""
    environment = F.col("environment_error")
    mode = (
        F.when(F.col("golden_commit").isNull(), "patches")
        .when(environment == "environment_patch_present", "patches")
        .when(environment == "inspect_failed", "skip")
        .otherwise("checkout")
    )
    failures = F.array_compact(F.array(F.col("golden_error"), environment))
    return [mode.alias("golden_mode"), failures.alias("integration_failures")]


MIN_PREFIX = 7


def commit_at_step(commits: DataFrame, requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Commit `step` places away from the requested one; unknown bases and far steps are errors.

    An abbreviated sha of seven or more characters matches by prefix. Both sides meet on the first
    seven characters, so no history is paired with all requests of its repository.
    """
    stem = F.substring("sha", 1, MIN_PREFIX)
    located = commits.select("repo", "idx", "sha", stem.alias("_stem"))
    asked = requests.select("request_id", "repo", "base_sha", "step", F.substring("base_sha", 1, MIN_PREFIX).alias("_stem"))
    hits = (
        asked.join(located, ["repo", "_stem"])
        .where(
            (F.col("sha") == F.col("base_sha"))
            | ((F.length("base_sha") >= MIN_PREFIX) & F.col("sha").startswith(F.col("base_sha")))
        )
        .groupBy("request_id")
        .agg(F.min("idx").alias("_at"))
    )
    targets = commits.select("repo", F.col("idx").alias("_target"), F.col("sha").alias("target_sha"))
    placed = asked.drop("_stem").join(hits, "request_id", "left").withColumn("_target", F.col("_at") + F.col("step"))
    found = placed.join(targets, ["repo", "_target"], "left").withColumn(
        "reason",
        F.when(F.col("_at").isNull(), "base commit not found").when(F.col("target_sha").isNull(), "step out of range"),
    )
    good = found.where(F.col("reason").isNull()).select("request_id", "repo", "base_sha", "step", "target_sha")
    return good, found.where(F.col("reason").isNotNull()).select("request_id", "reason")


def augment_states(base: DataFrame, diffs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """New states from bare base rows and diffs; rows that break the schema rules come back second.

    `diffs(instance_id, suffix, diff)`; a base that already has a patch takes no augmentation.
    """
    rows = base.join(diffs, "instance_id")
    bare = F.coalesce(F.length("patch"), F.lit(0)) == 0
    metadata = F.to_json(
        F.struct(
            F.col("instance_id").alias("parent"),
            patches.patch_touches_scope("diff", "test_scope").alias("modifies_test_scope"),
        )
    )
    made = rows.where(bare).select(
        ids.state_id(_without_last(F.col("instance_id")), "suffix").alias("instance_id"),
        "repo",
        "base_commit",
        F.col("diff").alias("patch"),
        "container",
        "command",
        "test_scope",
        metadata.alias("metadata"),
    )
    ok, bad = validate_states(made)
    patched = rows.where(~bare).select("instance_id", F.array(F.lit("base already has a patch")).alias("broken_rules"))
    return ok, bad.select("instance_id", "broken_rules").unionByName(patched)


def adapt_instances(instances: DataFrame, activation: str) -> DataFrame:
    """Base and gold states of each instance row.

    The base side carries the test patch, the gold side test and fixing patch; `activation` is put in
    front of the test command.
    """
    test_patch = F.nullif("test_patch", F.lit(""))
    sides = F.array(
        F.struct(F.lit("base").alias("suffix"), test_patch.alias("patch")),
        F.struct(F.lit("gold").alias("suffix"), patches.concat_patches("test_patch", "patch").alias("patch")),
    )
    scope = F.when(test_patch.isNull(), F.array(F.lit(patches.DEFAULT_SCOPE))).otherwise(
        patches.scope_from_patch("test_patch")
    )
    return instances.withColumn("_side", F.explode(sides)).select(
        ids.state_id("instance_id", F.col("_side.suffix")).alias("instance_id"),
        "repo",
        "base_commit",
        F.col("_side.patch").alias("patch"),
        "container",
        F.concat(F.lit(activation), "command").alias("command"),
        scope.alias("test_scope"),
    )


def group_states(rows: DataFrame) -> DataFrame:
    """Base and fixed states of each workload row; the fixed one carries the reference patch."""
    stem = ids.base_stem("repo", "base_commit", F.lit("unknown"))
    sides = F.array(
        F.struct(F.lit("base").alias("variant"), F.lit(None).cast("string").alias("patch")),
        F.struct(F.lit("fixed").alias("variant"), F.col("patch").alias("patch")),
    )
    metadata = F.to_json(
        F.struct(
            F.substring("base_commit", 1, 8).alias("base_id"),
            F.struct(F.col("dataset"), F.col("instance_id"), F.col("_side.variant").alias("variant")).alias("swefficiency"),
        )
    )
    return rows.withColumn("_side", F.explode(sides)).select(
        F.concat_ws(ids.SEPARATOR, stem, "instance_id", F.col("_side.variant")).alias("instance_id"),
        "repo",
        "base_commit",
        F.col("_side.patch").alias("patch"),
        "container",
        "command",
        metadata.alias("metadata"),
    )


def attach_documents(states: DataFrame, documents: DataFrame) -> DataFrame:
    """Tracer artifacts of each instance as a name-to-address map on its row.

    An instance has one document per tracer, so the gathered map is as small as the tracer list.
    """
    per_tracer = documents.groupBy("instance_id", "tracer").agg(F.max("uri").alias("uri"))
    maps = per_tracer.groupBy("instance_id").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("tracer", "uri")))).alias("_documents")
    )
    joined = states.join(maps, "instance_id", "left")
    return joined.withColumn("execution_data", F.coalesce(F.to_json("_documents"), "execution_data")).drop("_documents")
