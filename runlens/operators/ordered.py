"""Order-dependent columns that never sort a whole key in one task.

A key's rows are cut into chunks of their order column. A window works inside each chunk; one small
row per (key, chunk) carries what crosses the chunk borders. The window and the join that brings the
carried value back share the (key, chunk) partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runlens.operators.skew import CHUNK_ROWS


def seq_chunk(seq: str = "seq") -> Column:
    """Chunk of a dense ordinal."""
    return F.floor(F.col(seq) / F.lit(CHUNK_ROWS))


def hash_chunk(order: str, digits: int = 3) -> Column:
    """Chunk of a hexadecimal digest used as an order; prefixes are uniform by construction."""
    return F.conv(F.substring(F.col(order), 1, digits), 16, 10).cast("long")


def _rejoin(df: DataFrame, carried: DataFrame, keys: list[str]) -> DataFrame:
    on = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys] + [F.col("l._chunk") == F.col("r._chunk")]
    return df.alias("l").join(carried.alias("r"), on, "left").select("l.*", "r._carried")


def nearest(
    df: DataFrame, keys: list[str], order: str, value: str, out: str, later: bool = False, chunk: Column | None = None
) -> DataFrame:
    """Nearest non-null `value` at or before each row (at or after, with `later`)."""
    direction = F.col(order).desc() if later else F.col(order).asc()
    pick = F.min_by if later else F.max_by
    df = df.withColumn("_chunk", seq_chunk(order) if chunk is None else chunk)
    # A range frame, so that rows of the same ordinal see each other's value.
    inside = Window.partitionBy(*keys, "_chunk").orderBy(direction).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    local = df.withColumn("_local", F.last(value, True).over(inside))
    edges = df.groupBy(*keys, "_chunk").agg(
        pick(F.col(value), F.when(F.col(value).isNotNull(), F.col(order))).alias("_edge")
    )
    chunk_order = F.col("_chunk").desc() if later else F.col("_chunk").asc()
    across = Window.partitionBy(*keys).orderBy(chunk_order).rowsBetween(Window.unboundedPreceding, -1)
    carried = edges.select(*keys, "_chunk", F.last("_edge", True).over(across).alias("_carried"))
    joined = _rejoin(local, carried, keys)
    return joined.withColumn(out, F.coalesce("_local", "_carried")).drop("_local", "_carried", "_chunk")


def _running(df, keys, order, value, out, chunk, fold, merge) -> DataFrame:
    """`fold` of `value` over the rows before each row of its key; null before the first."""
    df = df.withColumn("_chunk", seq_chunk(order) if chunk is None else chunk)
    inside = Window.partitionBy(*keys, "_chunk").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    local = df.withColumn("_local", fold(value).over(inside))
    edges = df.groupBy(*keys, "_chunk").agg(fold(value).alias("_edge"))
    across = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = edges.select(*keys, "_chunk", fold("_edge").over(across).alias("_carried"))
    joined = _rejoin(local, carried, keys)
    return joined.withColumn(out, merge(F.col("_local"), F.col("_carried"))).drop("_local", "_carried", "_chunk")


def running_sum(
    df: DataFrame, keys: list[str], order: str, value: str, out: str, chunk: Column | None = None
) -> DataFrame:
    """Sum of `value` over the rows before each row of its key; zero before the first."""

    def merge(a: Column, b: Column) -> Column:
        return F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))

    return _running(df, keys, order, value, out, chunk, F.sum, merge)


def running_max(
    df: DataFrame, keys: list[str], order: str, value: str, out: str, chunk: Column | None = None
) -> DataFrame:
    """Largest `value` before each row of its key; null before the first."""
    return _running(df, keys, order, value, out, chunk, F.max, F.greatest)


def next_value(df: DataFrame, keys: list[str], order: str, columns: list[str]) -> DataFrame:
    """lead() of several columns across chunk borders, as `next_<column>`."""
    df = df.withColumn("_chunk", seq_chunk(order))
    inside = Window.partitionBy(*keys, "_chunk").orderBy(order)
    local = df.withColumn("_local", F.lead(F.struct(*columns)).over(inside))
    firsts = df.groupBy(*keys, "_chunk").agg(F.min_by(F.struct(*columns), F.col(order)).alias("_edge"))
    across = Window.partitionBy(*keys).orderBy("_chunk")
    carried = firsts.select(*keys, "_chunk", F.lead("_edge").over(across).alias("_carried"))
    joined = _rejoin(local, carried, keys).withColumn("_next", F.coalesce("_local", "_carried"))
    return joined.select("*", *[F.col(f"_next.{c}").alias(f"next_{c}") for c in columns]).drop(
        "_local", "_carried", "_next", "_chunk"
    )


def first_rows(df: DataFrame, keys: list[str], order: str, n: int) -> DataFrame:
    """The first n rows per key, for limits far beyond what a ranked window prunes.

    Chunks wholly below the limit are kept without ranking; only the chunk the limit cuts is ranked.
    """
    df = df.withColumn("_chunk", seq_chunk(order))
    sizes = df.groupBy(*keys, "_chunk").agg(F.count(F.lit(1)).alias("_rows"))
    across = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    limits = sizes.select(
        *keys, "_chunk", (F.lit(n) - F.coalesce(F.sum("_rows").over(across), F.lit(0))).alias("_carried")
    ).where(F.col("_carried") > 0)
    near = _rejoin(df, limits, keys).where(F.col("_carried").isNotNull())
    rank = F.row_number().over(Window.partitionBy(*keys, "_chunk").orderBy(order))
    return near.withColumn("_rank", rank).where(F.col("_rank") <= F.col("_carried")).drop("_rank", "_carried", "_chunk")
