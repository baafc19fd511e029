"""Deduplication and precedence between copies of one record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runlens.operators.skew import first_row


def dedupe_first(df: DataFrame, key: str, order: str) -> tuple[DataFrame, DataFrame]:
    """First row per id in `order`, and how many later rows each id lost."""
    kept = first_row(df, [key], [F.col(order)])
    skipped = (
        df.groupBy(key)
        .agg((F.count(F.lit(1)) - 1).alias("skipped"))
        .where(F.col("skipped") > 0)
    )
    return kept, skipped


def duplicate_ids(df: DataFrame, key: str = "instance_id") -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def keep_longest(records: DataFrame, keys: list[str], wall: str = "wall_time_s", position: str = "pos") -> DataFrame:
    """Longest record per test; a tie keeps the first."""
    longest: list[Column] = [F.coalesce(F.col(wall), F.lit(0.0)).desc(), F.col(position)]
    return first_row(records, keys, longest)


def fold_first(records: DataFrame, keys: list[str], file: str = "file", position: str = "pos") -> DataFrame:
    """First writer wins: side files in name order."""
    return first_row(records, keys, [F.col(file), F.col(position)])


def fold_longest(main: DataFrame, side: DataFrame, keys: list[str], wall: str = "wall_time_s") -> DataFrame:
    """Main and side records of a test together; the longest wins, main first on a tie."""
    both = main.withColumn("_source", F.lit(0)).unionByName(side.withColumn("_source", F.lit(1)))
    return first_row(both, keys, [F.coalesce(F.col(wall), F.lit(0.0)).desc(), F.col("_source"), F.col("pos")]).drop(
        "_source"
    )


def name_collisions(units: DataFrame, name: str, label: str) -> DataFrame:
    """Short names shared by different rows."""
    return (
        units.groupBy(name)
        .agg(F.min(label).alias("first_label"), F.max(label).alias("last_label"))
        .where(F.col("first_label") != F.col("last_label"))
    )
