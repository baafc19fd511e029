"""Reading finished runs, samples and responses."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.operators.sampling import cap_per_key
from runlens.schemas import FAILURES, RESPONSES, SAMPLES


class Run(NamedTuple):
    rows: DataFrame
    results: DataFrame
    failures: DataFrame


def read_run(spark: SparkSession, run_dir: str) -> Run:
    """Input rows in order with their place in `run.json`, worker results and worker failures.

    `run.json` and every result file are single records; ids come from the path.
    """
    row = "array<struct<instance_id:string,needs_cluster:boolean>>"
    listed = spark.read.text(f"{run_dir}/run.json", wholetext=True).select(
        F.posexplode(F.from_json("value", f"rows {row}")["rows"]).alias("input_index", "r")
    )
    inputs = spark.read.text(f"{run_dir}/input/rows.jsonl").where(F.trim("value") != "").select(
        F.get_json_object("value", "$.instance_id").alias("instance_id"), F.col("value").alias("payload")
    )
    rows = listed.select(F.col("input_index").cast("long").alias("input_index"), "r.*").join(inputs, "instance_id", "left")

    def worker_files(pattern: str, name: str) -> DataFrame:
        files = (
            spark.read.option("recursiveFileLookup", "true")
            .option("pathGlobFilter", name)
            .text(f"{run_dir}/workers", wholetext=True)
            .select("value", F.regexp_extract(F.col("_metadata.file_path"), pattern, 1).alias("instance_id"))
        )
        return files.where(F.col("instance_id") != "")

    results = worker_files(r"/workers/([^/]+)/result\.json\z", "result.json").select(
        "instance_id", F.regexp_replace("value", r"\n\z", "").alias("payload")
    )
    failures = worker_files(r"/workers/([^/]+)/artifacts/failure\.json\z", "failure.json").select(
        "instance_id", F.from_json("value", FAILURES).alias("f")
    )
    columns = [c for c in FAILURES.names if c != "instance_id"]
    return Run(rows, results, failures.select("instance_id", *[f"f.{c}" for c in columns]))


def read_samples(
    spark: SparkSession,
    root: str,
    tasks: list[str] | None = None,
    sides: list[str] | None = None,
    max_per_task: int | None = None,
) -> DataFrame:
    """Samples by task; task and side filters reach the scan, the cap keeps the first ids."""
    rows = spark.read.schema(SAMPLES).parquet(root)
    if tasks:
        rows = rows.where(F.col("task").isin(tasks))
    if sides:
        rows = rows.where(F.col("side").isin(sides))
    return rows if max_per_task is None else cap_per_key(rows, "task", max_per_task, [F.col("sample_id")])


def read_responses(spark: SparkSession, roots: list[str], labels: list[str]) -> DataFrame:
    """Response lines of many models from several roots, each root under its group label.

    Files lie in `<root>/<model>/responses/`.
    """
    if len(roots) != len(labels):
        raise ValueError("one label per root")
    out = None
    for root, label in zip(roots, labels):
        rows = (
            spark.read.schema(RESPONSES)
            .option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.json*")
            .json(root)
            .withColumn("model", F.regexp_extract(F.col("_metadata.file_path"), r"/([^/]+)/responses/", 1))
            .withColumn("group", F.lit(label))
        )
        out = rows if out is None else out.unionByName(rows)
    return out
