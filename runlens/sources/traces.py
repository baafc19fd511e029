"""Reading trace documents into four tables."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.operators.traces import latest_run
from runlens.schemas import TRACE_DOCUMENT
from runlens.sources.documents import read_whole


class TraceTables(NamedTuple):
    runs: DataFrame
    tests: DataFrame
    functions: DataFrame
    lines: DataFrame


def read_documents(
    spark: SparkSession, root: str, pattern: str = "trace_output*.json*", packed: bool = False
) -> DataFrame:
    """Raw documents with run, instance and side taken from the path.

    Layouts `<root>/<run>/<instance>/file` and `<root>/<instance>/file` are both read; the text reader
    inflates `.gz` files by itself. One document is one record.
    """
    files = read_whole(spark, root, pattern, packed)
    leaf = root.rstrip("/").split("/")[-1]
    parts = F.split(F.element_at(F.split("path", F.lit(f"/{leaf}/")), -1), "/")
    name = F.element_at(parts, -1)
    return files.select(
        "value",
        "path",
        F.element_at(parts, -2).alias("instance_id"),
        F.when(F.size(parts) > 2, F.element_at(parts, -3)).otherwise("").alias("run"),
        F.when(name.contains("_pre."), "pre").otherwise("post").alias("side"),
        name.endswith(".gz").alias("compressed"),
    )


def trace_tests(raw: DataFrame) -> DataFrame:
    """One row per test; the ordinal is the place of the test in the document."""
    return raw.select("instance_id", F.explode("document.tests").alias("test", "t")).select(
        "instance_id",
        "test",
        "t.outcome",
        "t.outcome_details.is_assertion",
        "t.outcome_details.failure_line",
        "t.outcome_details.exception_type",
        *[f"t.{c}" for c in ("wall_time_s", "setup_time_s", "call_time_s", "teardown_time_s")],
        *[f"t.{c}" for c in ("start_rss_bytes", "peak_rss_bytes", "start_traced_bytes", "peak_traced_bytes")],
        "t.tracemalloc_enabled",
        (
            F.coalesce("t.trimmed", F.lit(False))
            & F.coalesce(F.exists("t.trim_info", lambda info: info["reason"] == "max_events"), F.lit(False))
        ).alias("trimmed_by_events"),
    )


def trace_functions(raw: DataFrame) -> DataFrame:
    """One row per function record, with its position in the test."""
    tests = raw.select("instance_id", F.explode("document.tests").alias("test", "t"))
    return tests.select("instance_id", "test", F.posexplode("t.functions").alias("pos", "f")).select(
        "instance_id", "test", "pos", "f.*"
    )


def trace_lines(raw: DataFrame) -> DataFrame:
    """One row per line record; line keys that are no number are dropped."""
    tests = raw.select("instance_id", F.explode("document.tests").alias("test", "t"))
    files = tests.select("instance_id", "test", F.explode("t.lines").alias("file", "records"))
    rows = files.select("instance_id", "test", "file", F.explode("records").alias("_line", "r"))
    return rows.select(
        "instance_id", "test", "file", F.col("_line").try_cast("bigint").alias("line"), "r.*"
    ).where(F.col("line").isNotNull())


def read_traces(
    spark: SparkSession,
    root: str,
    side: str = "post",
    pattern: str = "trace_output*.json*",
    packed: bool = False,
) -> TraceTables:
    """The latest run of each instance as run, test, function and line tables."""
    documents = latest_run(read_documents(spark, root, pattern, packed).where(F.col("side") == side))
    raw = documents.select("instance_id", "run", "path", F.from_json("value", TRACE_DOCUMENT).alias("document"))
    fields = ["tracer_version", "trace_level", "memory_tracking", "backend", "python_version", "test_count"]
    runs = raw.select("instance_id", "run", *[f"document.{c}" for c in fields])
    return TraceTables(runs, trace_tests(raw), trace_functions(raw), trace_lines(raw))
