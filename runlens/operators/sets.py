"""Upserts, appends and removals by id, and set algebra on test lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runlens.operators.outcomes import is_filled


def upsert(base: DataFrame, changed: DataFrame, key: str, order: str) -> DataFrame:
    """Replace rows in place, insert new ones after the last base row."""
    places = base.select(key, F.col(order).alias("_place"))
    # New rows keep their own order behind every base row, so only the flag has to sort first.
    placed = changed.join(places, key, "left").withColumn("_new", F.col("_place").isNull())
    updated = placed.withColumn(order, F.coalesce("_place", F.col(order))).drop("_place")
    kept = base.join(changed.select(key), key, "left_anti").withColumn("_new", F.lit(False))
    return kept.unionByName(updated).withColumnRenamed("_new", "inserted")


def append_skip(base: DataFrame, incoming: DataFrame, key: str = "instance_id") -> DataFrame:
    """Existing rows stay; only unseen ids are added. Incoming duplicates are kept as they are."""
    return base.unionByName(incoming.join(base.select(key), key, "left_anti"))


def append_override(base: DataFrame, incoming: DataFrame, key: str = "instance_id") -> DataFrame:
    """Incoming rows replace existing ones of the same id."""
    return base.join(incoming.select(key), key, "left_anti").unionByName(incoming)


def append_report(base: DataFrame, incoming: DataFrame, key: str = "instance_id") -> DataFrame:
    """What an append would meet: ids already there, and rows not filled yet."""
    collisions = incoming.select(key).distinct().join(base.select(key), key, "left_semi")
    partial = incoming.where(~is_filled()).select(key)
    return collisions.select(key, F.lit("collision").alias("issue")).unionByName(
        partial.select(key, F.lit("partial").alias("issue"))
    )


def remove(base: DataFrame, ids: DataFrame, key: str = "instance_id") -> tuple[DataFrame, DataFrame]:
    """Rows left after removing ids, and the ids that were not there.

    Writers refuse an empty result; see `runlens.sources.sinks.write_nonempty`.
    """
    return base.join(ids, key, "left_anti"), ids.join(base.select(key), key, "left_anti")


def append_pairs(existing: DataFrame, pairs: DataFrame) -> DataFrame:
    return existing.unionByName(pairs.join(existing.select("pair_id"), "pair_id", "left_anti"))


def set_ops(df: DataFrame, a: str, b: str) -> DataFrame:
    """Equality, union, intersection and difference of two list columns."""
    only_a, only_b = F.array_except(a, b), F.array_except(b, a)
    return df.select(
        "*",
        ((F.size(only_a) == 0) & (F.size(only_b) == 0)).alias("equal"),
        F.array_sort(F.array_union(a, b)).alias("union"),
        F.array_sort(F.array_intersect(a, b)).alias("intersection"),
        F.array_sort(only_a).alias("difference"),
    )
