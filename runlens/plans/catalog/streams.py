"""Streaming queries, run to the end of the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.plans.catalog.inputs import scratch_folder
from runlens.plans.catalog.registry import frame, query
from runlens.plans.catalog.traces import SEGMENTS
from runlens.streaming import jobs


def _table_stream(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    schema = spark.read.parquet(f"{sf_dir}/{table}.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{table}.parquet").parquet(sf_dir)


def _derived_stream(spark: SparkSession, rows: DataFrame, folder: str) -> DataFrame:
    rows.write.parquet(f"{folder}/input")
    return spark.readStream.schema(rows.schema).parquet(f"{folder}/input")


def _finish(stream: DataFrame, folder: str) -> DataFrame:
    done = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .outputMode("append")
        .trigger(availableNow=True)
        .start(f"{folder}/out")
    )
    done.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/out")


@query("stream_results", "SELECT DISTINCT l_orderkey FROM lineitem")
def stream_results(spark, sf_dir):
    folder = scratch_folder(spark)
    stream = _table_stream(spark, sf_dir, "lineitem").select("l_orderkey")
    jobs.stream_results(stream, f"{folder}/out", f"{folder}/checkpoint", "l_orderkey").awaitTermination()
    return spark.read.schema("l_orderkey long").parquet(f"{folder}/out")


@query(
    "stream_upsert",
    "SELECT user_id, max(event_id) AS event_id, max_by(event_type, event_id) AS event_type FROM events GROUP BY user_id",
)
def stream_upsert(spark, sf_dir):
    folder = scratch_folder(spark)
    stream = _table_stream(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    jobs.stream_upsert(stream, f"{folder}/table", f"{folder}/checkpoint", "user_id", "event_id").awaitTermination()
    return jobs.read_upserted(spark, f"{folder}/table", stream.schema, "user_id", "event_id").select("user_id", "event_id", "event_type")


@query(
    "stream_upsert_late",
    "SELECT user_id, max(event_id) AS event_id, max_by(event_type, event_id) AS event_type FROM events GROUP BY user_id",
)
def stream_upsert_late(spark, sf_dir):
    """Two runs over one table: the newer half of the events first, the older half late."""
    folder = scratch_folder(spark)
    events = _table_stream(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    for part, rows in (("new", events.where("event_id % 2 = 1")), ("late", events.where("event_id % 2 = 0"))):
        jobs.stream_upsert(rows, f"{folder}/table", f"{folder}/{part}", "user_id", "event_id").awaitTermination()
    return jobs.read_upserted(spark, f"{folder}/table", events.schema, "user_id", "event_id").select("user_id", "event_id", "event_type")


@query(
    "stream_run_status",
    "SELECT o_custkey AS run, o_orderpriority AS component, o_orderstatus AS state, count(*) AS n FROM orders GROUP BY 1, 2, 3",
)
def stream_run_status(spark, sf_dir):
    folder = scratch_folder(spark)
    events = _table_stream(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("run"), F.col("o_orderpriority").alias("component"), F.col("o_orderstatus").alias("state")
    )
    counts = jobs.stream_run_status(events)
    done = (
        counts.writeStream.outputMode("complete")
        .foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(f"{folder}/out"))
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    done.awaitTermination()
    return spark.read.schema(counts.schema).parquet(f"{folder}/out")


@query("stream_segment", SEGMENTS, doubles=("test_start",))
def stream_segment(spark, sf_dir):
    folder = scratch_folder(spark)
    stream = _derived_stream(spark, frame(spark, sf_dir, "fx_frames"), folder)
    return _finish(jobs.stream_segment(stream), folder)


@query(
    "stream_completed_runs",
    """
    SELECT 'run' || CAST(o_custkey AS VARCHAR(20)) AS run, count(*) AS units FROM orders GROUP BY o_custkey
    HAVING count(CASE WHEN o_orderstatus = 'P' AND o_totalprice <= 300000 THEN 1 END) = 0
    """,
)
def stream_completed_runs(spark, sf_dir):
    folder = scratch_folder(spark)
    rows = frame(
        spark,
        sf_dir,
        """WITH units AS (SELECT 'run' || CAST(o_custkey AS STRING) AS run, CAST(o_orderkey AS STRING) AS unit, o_orderstatus, o_totalprice,
                                 count(*) OVER (PARTITION BY o_custkey) AS expected FROM orders)
           SELECT run, unit, 0 AS seq, expected, 'pending' AS state FROM units
           UNION ALL SELECT run, unit, 1, expected, CASE WHEN o_orderstatus <> 'P' THEN 'succeeded' WHEN o_totalprice > 300000 THEN 'failed' ELSE 'active' END FROM units""",
    )
    return _finish(jobs.stream_completed_runs(_derived_stream(spark, rows, folder)), folder)
