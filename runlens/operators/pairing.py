"""Pairs of states of one base.

A base of n states has n(n-1)/2 unordered pairs. Emitting them all makes the output quadratic in the
largest base, so pairs come from a request table instead; without one, the base state is paired with
each of its other states. `clone_classes` answers the clone question for every remaining pair in
linear size: two states are clones exactly when they share a class.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runlens.functions.ids import base_ref, make_pair_id
from runlens.operators.outcomes import list_entries
from runlens.operators.skew import first_row

# One bit per list, in list precedence: the highest bit is the status that counts.
BITS = {"PASSED": 1, "FAILED": 2, "SKIPPED": 4, "ERROR": 8}
SHARED = ["container", "command"]


class Pairs(NamedTuple):
    pairs: DataFrame
    skipped: DataFrame
    errors: DataFrame


def with_base_key(states: DataFrame) -> DataFrame:
    return states.withColumn("base_ref", base_ref())


def base_key_errors(states: DataFrame) -> DataFrame:
    """States neither a commit nor a metadata id can place."""
    return with_base_key(states).where(F.col("base_ref").isNull()).select("instance_id")


def base_states(states: DataFrame) -> DataFrame:
    """One bare state per base: the first by id."""
    return first_row(states.where(F.col("patch").isNull()), ["repo", "base_ref"], [F.col("instance_id")])


def groups_without_base(states: DataFrame) -> DataFrame:
    return (
        with_base_key(states)
        .groupBy("repo", "base_ref")
        .agg(F.bool_or(F.col("patch").isNull()).alias("_base"), F.count(F.lit(1)).alias("states"))
        .where(~F.col("_base"))
        .drop("_base")
    )


def pair_states(
    states: DataFrame, requests: DataFrame | None = None, existing: DataFrame | None = None
) -> Pairs:
    """Heads of the requested pairs: base first, then id order.

    States that disagree on a shared field, have no commit, or would put a base on side B go to
    `errors`; groups without a base and known pair ids go to `skipped`.
    """
    keyed = with_base_key(states).select(
        "instance_id", "repo", "base_ref", "base_commit", "patch", *SHARED, "metadata"
    )

    def side(name: str) -> DataFrame:
        return keyed.select(*[F.col(c).alias(f"{c}_{name}") for c in keyed.columns])

    if requests is None:
        bases = base_states(keyed).select(*[F.col(c).alias(f"{c}_A") for c in keyed.columns])
        both = bases.join(
            side("B"),
            (F.col("repo_A") == F.col("repo_B"))
            & (F.col("base_ref_A") == F.col("base_ref_B"))
            & (F.col("instance_id_A") != F.col("instance_id_B")),
        )
    else:
        asked = requests.select("instance_id_A", "instance_id_B").distinct()
        both = asked.join(side("A"), "instance_id_A").join(side("B"), "instance_id_B")
    # Canonical order of each pair: a base goes first, otherwise the smaller id.
    swap = F.struct(F.col("patch_B").isNotNull(), F.col("instance_id_B")) < F.struct(
        F.col("patch_A").isNotNull(), F.col("instance_id_A")
    )
    ordered = both.select(
        *[
            F.when(swap, F.col(f"{c}_{other}")).otherwise(F.col(f"{c}_{name}")).alias(f"{c}_{name}")
            for c in keyed.columns
            for name, other in (("A", "B"), ("B", "A"))
        ]
    )
    if requests is not None:
        ordered = ordered.dropDuplicates(["instance_id_A", "instance_id_B"])
    differing = F.concat_ws(
        ",", *[F.when(~F.col(f"{c}_A").eqNullSafe(F.col(f"{c}_B")), F.lit(c)) for c in ["repo", "base_commit", *SHARED]]
    )
    reason = (
        F.when(differing != "", F.concat(F.lit("states disagree on "), differing))
        .when(F.col("instance_id_A") == F.col("instance_id_B"), "same state twice")
        .when(F.col("patch_B").isNull(), "base state on side B")
        .when(F.col("base_commit_A").isNull(), "no base commit")
    )
    checked = ordered.withColumn("reason", reason).withColumn(
        "pair_id", make_pair_id("instance_id_A", "instance_id_B")
    )
    errors = checked.where(F.col("reason").isNotNull()).select("instance_id_A", "instance_id_B", "reason")
    good = checked.where(F.col("reason").isNull()).select(
        "pair_id",
        F.col("repo_A").alias("repo"),
        F.col("base_ref_A").alias("base_ref"),
        F.col("base_commit_A").alias("base_commit"),
        *[F.col(f"{c}_A").alias(c) for c in SHARED],
        "instance_id_A",
        "instance_id_B",
        "patch_A",
        "patch_B",
        "metadata_A",
        "metadata_B",
    )
    # A pair is only built where its group has a base; by default that is side A itself.
    if requests is None:
        good = good.withColumn("base_id", F.col("instance_id_A"))
        skipped = good.where(F.lit(False)).select("pair_id", F.lit("").alias("reason"))
    else:
        bases = base_states(keyed).select("repo", "base_ref", F.col("instance_id").alias("base_id"))
        placed = good.join(bases, ["repo", "base_ref"], "left")
        good = placed.where(F.col("base_id").isNotNull())
        skipped = placed.where(F.col("base_id").isNull()).select(
            "pair_id", F.lit("group has no base state").alias("reason")
        )
    if existing is not None:
        known = existing.select("pair_id")
        skipped = skipped.unionByName(
            good.join(known, "pair_id", "left_semi").select("pair_id", F.lit("known pair").alias("reason"))
        )
        good = good.join(known, "pair_id", "left_anti")
    return Pairs(good, skipped, errors)


def with_base_health(pairs: DataFrame, sizes: DataFrame) -> DataFrame:
    """Attach the health of each pair's base; a base without any entry is healthy."""
    broken = sizes.select(
        F.col("instance_id").alias("base_id"), ((F.col("broken") + F.col("modules")) > 0).alias("_broken")
    )
    joined = pairs.join(broken, "base_id", "left")
    return joined.withColumn("is_base_healthy", ~F.coalesce("_broken", F.lit(False))).drop("_broken")


# Parts of one state's tests in joins where the state meets many pairs.
SALTS = 32


def entry_masks(entries: DataFrame, key: str = "instance_id") -> DataFrame:
    """One row per (state, test): which lists name the test."""
    bit = F.coalesce(*[F.when(F.col("status") == s, F.lit(b)) for s, b in BITS.items()])
    return entries.groupBy(key, "test").agg(F.bit_or(bit).alias("mask"))


def top_bit(mask: Column) -> Column:
    """The list that wins."""
    return F.when(mask >= 8, 8).when(mask >= 4, 4).when(mask >= 2, 2).when(mask >= 1, 1)


def status_of_mask(mask: Column) -> Column:
    return F.coalesce(*[F.when(top_bit(mask) == b, F.lit(s)) for s, b in BITS.items()])


def state_sizes(masks: DataFrame, errors: DataFrame) -> DataFrame:
    """Counts per state that the pair figures need."""

    def has(bit: int) -> Column:
        return F.count_if(F.col("mask").bitwiseAND(bit) > 0)

    counts = masks.groupBy("instance_id").agg(
        F.count(F.lit(1)).alias("tests"),
        has(1).alias("passed"),
        has(4).alias("skipped"),
        (has(2) + has(8)).alias("broken"),
    )
    modules = errors.groupBy("instance_id").agg(F.count(F.lit(1)).alias("modules"))
    joined = counts.join(modules, "instance_id", "full")
    return joined.select(
        "instance_id",
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("tests", "passed", "skipped", "broken", "modules")],
    )


def pair_figures(pairs: DataFrame, entries: DataFrame, errors: DataFrame) -> DataFrame:
    """Base health, flipped tests, their ratio, and the clone decision per pair.

    Side B's tests look up side A's by (state, test), so a large state spreads over its tests; tests
    only side A has follow from the per-state counts and are never emitted.
    """
    masks = entry_masks(entries)
    sizes = state_sizes(masks, errors)
    pairs = with_base_health(pairs, sizes)
    heads = pairs.select("pair_id", "instance_id_A", "instance_id_B")
    right = masks.select(F.col("instance_id").alias("instance_id_B"), "test", F.col("mask").alias("mask_b"))
    left = masks.select(F.col("instance_id").alias("instance_id_A"), "test", F.col("mask").alias("mask_a"))
    met = heads.join(right, "instance_id_B").join(left, ["instance_id_A", "test"])

    def both(bit: int) -> Column:
        return F.count_if((F.col("mask_a").bitwiseAND(bit) > 0) & (F.col("mask_b").bitwiseAND(bit) > 0))

    shared = met.groupBy("pair_id").agg(
        F.count(F.lit(1)).alias("matched"),
        F.count_if(top_bit(F.col("mask_a")) == top_bit(F.col("mask_b"))).alias("same"),
        both(1).alias("both_passed"),
        both(4).alias("both_skipped"),
    )
    out = pairs.join(shared, "pair_id", "left")
    for side in ("A", "B"):
        out = out.join(
            sizes.select(*[F.col(c).alias(f"{c}_{side}") for c in sizes.columns]), f"instance_id_{side}", "left"
        )

    def n(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0))

    observed = n("tests_A") + n("tests_B") - n("matched")
    flipped = observed - n("same")
    clean = (n("broken_A") + n("broken_B") + n("modules_A") + n("modules_B")) == 0
    equal = (
        (n("passed_A") == n("passed_B"))
        & (n("passed_A") == n("both_passed"))
        & (n("skipped_A") == n("skipped_B"))
        & (n("skipped_A") == n("both_skipped"))
    )
    return out.select(
        *pairs.columns,
        F.when(F.col("is_base_healthy"), clean & equal).alias("is_clone"),
        flipped.cast("long").alias("num_flipped_tests"),
        F.when(observed > 0, flipped / observed).otherwise(0.0).alias("flipped_ratio"),
    )


def flipped_tests(pairs: DataFrame, entries: DataFrame) -> DataFrame:
    """Every test either side reports, with both statuses and whether they differ.

    A base stands in every pair of its group, so its tests are dealt to `SALTS` parts of its key.
    """
    masks = entry_masks(entries).withColumn("_salt", F.pmod(F.xxhash64("test"), F.lit(SALTS)).cast("int"))
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt")

    def side(name: str) -> DataFrame:
        other = "b" if name == "A" else "a"
        return pairs.select("pair_id", F.col(f"instance_id_{name}").alias("instance_id"), salts).join(
            masks, ["instance_id", "_salt"]
        ).select(
            "pair_id",
            "test",
            F.col("mask").alias(f"mask_{name.lower()}"),
            F.lit(None).cast("int").alias(f"mask_{other}"),
        )

    return (
        side("A")
        .unionByName(side("B"))
        .groupBy("pair_id", "test")
        .agg(F.max("mask_a").alias("_a"), F.max("mask_b").alias("_b"))
        .select(
            "pair_id",
            "test",
            status_of_mask(F.col("_a")).alias("status_a"),
            status_of_mask(F.col("_b")).alias("status_b"),
            (~top_bit(F.col("_a")).eqNullSafe(top_bit(F.col("_b")))).alias("flipped"),
        )
    )


def clone_classes(states: DataFrame, entries: DataFrame, errors: DataFrame) -> DataFrame:
    """Class of each state within its base: equal classes are clones, null is never a clone.

    The class digests the passed and skipped sets by order-free sums of two 48-bit hashes plus the
    set sizes, so no list is gathered. Null when the base is unhealthy or the state is broken.
    """
    masks = entry_masks(entries)
    sizes = state_sizes(masks, errors)
    token = F.concat_ws("|", (F.col("mask").bitwiseAND(1)).cast("string"), F.col("mask").bitwiseAND(4).cast("string"), "test")
    digits = [F.conv(F.substring(F.md5(token), start, 12), 16, 10).cast("decimal(38,0)") for start in (1, 13)]
    kept = masks.where(F.col("mask").bitwiseAND(5) > 0)
    digest = kept.groupBy("instance_id").agg(
        F.sum(digits[0]).cast("string").alias("_d1"), F.sum(digits[1]).cast("string").alias("_d2")
    )
    keyed = with_base_key(states).select("instance_id", "repo", "base_ref", "patch")
    joined = keyed.join(sizes, "instance_id", "left").join(digest, "instance_id", "left")
    broken = (F.coalesce("broken", F.lit(0)) + F.coalesce("modules", F.lit(0))) > 0
    bases = base_states(joined.withColumn("_broken", broken)).select(
        "repo", "base_ref", F.col("_broken").alias("_base_broken")
    )
    return joined.join(bases, ["repo", "base_ref"], "left").select(
        "instance_id",
        "repo",
        "base_ref",
        F.when(
            ~broken & ~F.coalesce("_base_broken", F.lit(True)),
            F.concat_ws(
                "-",
                F.coalesce("passed", F.lit(0)),
                F.coalesce("skipped", F.lit(0)),
                F.coalesce("_d1", F.lit("0")),
                F.coalesce("_d2", F.lit("0")),
            ),
        ).alias("clone_class"),
    )


def pair_records(figures: DataFrame, states: DataFrame) -> DataFrame:
    """Full pair rows: both states' sorted lists laid out next to the figures."""
    out = figures
    for side in ("A", "B"):
        lists = states.select(
            F.col("instance_id").alias(f"instance_id_{side}"),
            F.sort_array("passed_tests").alias(f"passed_tests_{side}"),
            F.col("failed_tests").alias(f"failed_tests_{side}"),
            F.sort_array("skipped_tests").alias(f"skipped_tests_{side}"),
            F.col("errored_tests").alias(f"errored_tests_{side}"),
            F.array_sort(F.array_distinct("discovery_errors")).alias(f"discovery_errors_{side}"),
        )
        out = out.join(lists, f"instance_id_{side}")
    return out.withColumn("pair_metadata", F.lit("{}"))


def pairs_of_lists(
    states: DataFrame, requests: DataFrame | None = None, existing: DataFrame | None = None
) -> Pairs:
    """Pair states in record form (list columns), figures and lists included."""
    measured = states.where(F.col("passed_tests").isNotNull())
    heads, skipped, errors = pair_states(measured, requests, existing)
    entries = list_entries(measured, "instance_id")
    modules = measured.select("instance_id", F.explode(F.array_distinct("discovery_errors")).alias("module"))
    figures = pair_figures(heads, entries, modules)
    return Pairs(pair_records(figures, measured), skipped, errors)
