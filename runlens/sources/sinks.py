"""Writers, and versions of published datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The tag pattern and the first version.
TAG = r"\A(v?)(\d+)\.(\d+)\.(\d+)\z"
FIRST_TAG = "v0.1.0"


def write_jsonl(df: DataFrame, path: str) -> None:
    """One JSON object per row, keys in name order, nulls kept."""
    columns = sorted(df.columns)
    df.select(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("value")).write.text(path)


def write_samples(samples: DataFrame, path: str) -> None:
    """Samples partitioned by task."""
    samples.write.partitionBy("task").parquet(path)


def write_failures(failures: DataFrame, path: str) -> None:
    """Failures appended to a table partitioned by reason."""
    failures.write.mode("append").partitionBy("reason").parquet(path)


def write_nonempty(df: DataFrame, path: str) -> None:
    """Refuse to replace a dataset with nothing."""
    if df.isEmpty():
        raise ValueError("refusing to write an empty dataset")
    df.write.parquet(path)


def next_version(tags: DataFrame, part: str) -> DataFrame:
    """The highest `vX.Y.Z` tag with one part bumped; other tags are ignored, none gives the first.

    `tags(tag)`; the answer is one row `(current, next)`.
    """
    place = {"x": 0, "y": 1, "z": 2}[part]
    numbers = [F.regexp_extract("tag", TAG, i + 2).try_cast("int") for i in range(3)]
    parsed = tags.where(F.col("tag").rlike(TAG)).select(
        F.struct(*[n.alias(c) for n, c in zip(numbers, "xyz")]).alias("v"),
        "tag",
        F.regexp_extract("tag", TAG, 1).alias("prefix"),
    )
    best = parsed.agg(F.max(F.struct("v", "tag", "prefix")).alias("top")).select("top.*")
    bumped = [
        F.col(f"v.{c}") if i < place else (F.col(f"v.{c}") + 1 if i == place else F.lit(0)) for i, c in enumerate("xyz")
    ]
    following = F.concat("prefix", F.concat_ws(".", *[b.cast("string") for b in bumped]))
    return best.select(
        F.col("tag").alias("current"), F.when(F.col("v").isNull(), F.lit(FIRST_TAG)).otherwise(following).alias("next")
    )


def publish(df: DataFrame, path: str, version: str) -> None:
    """Write under a release; an existing release is never overwritten."""
    df.write.mode("errorifexists").parquet(f"{path}/release={version}")
