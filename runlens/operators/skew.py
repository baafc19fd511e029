"""Helpers that keep hot groups out of a single task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows of one group that a window task sorts at a time.
CHUNK_ROWS = 1_000_000


def top_n(df: DataFrame, keys: list[str], order: list[Column], n: int, rank: str = "rank") -> DataFrame:
    """First `n` rows per key. The literal bound lets Spark prune before the shuffle."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= n)


def first_row(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return top_n(df, keys, order, 1, "_first").drop("_first")
