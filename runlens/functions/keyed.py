"""Order-independent draws: one uniform per key, reproducible on any partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def keyed_uniform(seed: int | str, *keys: Column | str) -> Column:
    """A uniform in (0, 1) from the first 52 bits of md5(seed|key|...)."""
    parts = [F.lit(str(seed))] + [(F.col(k) if isinstance(k, str) else k).cast("string") for k in keys]
    bits = F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 13), 16, 10).cast("double")
    return (bits + F.lit(0.5)) / F.lit(4503599627370496.0)


def weighted_key(seed: int | str, weight: Column, *keys: Column | str) -> Column:
    """Exponential sort key: the n smallest are a weighted draw without replacement."""
    return -F.ln(keyed_uniform(seed, *keys)) / weight
