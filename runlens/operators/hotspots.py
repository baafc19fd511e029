"""Rankings of functions and lines by cost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runlens.operators.skew import top_n

TOP_K = 20


def top_positive(df: DataFrame, keys: list[str], value: Column, ties: list[Column], k: int) -> DataFrame:
    """The k largest positive values per key, with a 1-based rank."""
    valued = df.withColumn("value", value)
    return top_n(valued.where(F.col("value") > 0), keys, [F.col("value").desc(), *ties], k)


def rank_hotspots(functions: DataFrame, k: int = TOP_K) -> DataFrame:
    """Workload hotspots: time descending, key ascending."""
    return top_positive(functions, ["instance_id"], F.col("exclusive_time_s"), [F.col("key")], k)


def exclusive_memory() -> Column:
    """The larger of the heap and the resident-size signal of a function."""
    return F.greatest(
        F.coalesce(F.col("exclusive_alloc_bytes"), F.lit(0)), F.coalesce(F.col("exclusive_rss_bytes"), F.lit(0))
    )


def line_memory() -> Column:
    return F.greatest(F.coalesce(F.col("alloc_bytes"), F.lit(0)), F.coalesce(F.col("rss_bytes"), F.lit(0)))


def line_name() -> Column:
    return F.concat_ws(":", "file", F.col("line").cast("string"))


def hot_methods_time(functions: DataFrame, keys: list[str], k: int = TOP_K) -> DataFrame:
    """Functions by exclusive time; equal times keep input order."""
    return top_positive(functions, keys, F.coalesce("exclusive_time_s", F.lit(0.0)), [F.col("pos")], k)


def hot_methods_alloc(functions: DataFrame, keys: list[str], k: int = TOP_K) -> DataFrame:
    return top_positive(functions, keys, exclusive_memory(), [F.col("pos")], k)


def hot_lines_time(lines: DataFrame, keys: list[str], k: int = TOP_K) -> DataFrame:
    """Lines by time; equal times go by name, descending."""
    named = lines.withColumn("name", line_name())
    return top_positive(named, keys, F.coalesce("time_ns", F.lit(0)), [F.col("name").desc()], k)


def hot_lines_alloc(lines: DataFrame, keys: list[str], k: int = TOP_K) -> DataFrame:
    named = lines.withColumn("name", line_name())
    return top_positive(named, keys, line_memory(), [F.col("name").desc()], k)
