from pyspark.sql import functions as F

from runlens.operators import events
from runlens.streaming import jobs
from tests.conftest import rows


def feed(spark, folder, schema, *batches):
    """One file per batch, read one file per trigger."""
    for number, data in enumerate(batches):
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in/b{number:03d}")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{folder}/in")


def run(stream, folder):
    query = (
        stream.writeStream.format("parquet").option("checkpointLocation", f"{folder}/cp").outputMode("append").trigger(availableNow=True).start(f"{folder}/out")
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/out")


def test_results_once_across_restarts(spark, tmp_path):
    schema = "instance_id string, v int"
    stream = feed(spark, tmp_path, schema, [("a", 1), ("b", 1)], [("a", 2)])
    jobs.stream_results(stream, f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    again = feed(spark, tmp_path, schema, [("b", 3), ("c", 1)])
    jobs.stream_results(again, f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/out")
    assert rows(got, "instance_id") == [("a",), ("b",), ("c",)]


def test_upsert_keeps_the_newest(spark, tmp_path):
    schema = "instance_id string, seq int, v string"
    stream = feed(spark, tmp_path, schema, [("a", 1, "x"), ("b", 1, "x")], [("a", 2, "y"), ("a", 3, "z"), ("c", 1, "x")])
    jobs.stream_upsert(stream, f"{tmp_path}/t", f"{tmp_path}/cp").awaitTermination()
    got = jobs.read_upserted(spark, f"{tmp_path}/t", schema)
    assert rows(got, "instance_id", "v") == [("a", "z"), ("b", "x"), ("c", "x")]


def test_late_rows_of_a_later_batch_change_nothing(spark, tmp_path):
    schema = "instance_id string, seq int, v string"
    merge = jobs.upsert_batch(f"{tmp_path}/t", "feed", "instance_id", "seq")
    for number, data in enumerate([[("a", 5, "new"), ("b", 1, "b")], [("a", 1, "old"), ("b", 1, "again"), ("c", 1, "c")], [("a", 6, "newest")]]):
        merge(spark.createDataFrame(data, schema), number)
    got = jobs.read_upserted(spark, f"{tmp_path}/t", schema)
    assert rows(got, "instance_id", "v") == [("a", "newest"), ("b", "b"), ("c", "c")]
    # A replayed batch writes its folder again; another stream counts its own batches.
    merge(spark.createDataFrame([("a", 6, "newest")], schema), 2)
    jobs.upsert_batch(f"{tmp_path}/t", "other", "instance_id", "seq")(spark.createDataFrame([("b", 2, "b2")], schema), 0)
    got = jobs.read_upserted(spark, f"{tmp_path}/t", schema)
    assert rows(got, "instance_id", "v") == [("a", "newest"), ("b", "b2"), ("c", "c")]
    jobs.compact_upserted(spark, f"{tmp_path}/t", f"{tmp_path}/small", schema)
    merge = jobs.upsert_batch(f"{tmp_path}/small", "feed", "instance_id", "seq")
    merge(spark.createDataFrame([("c", 2, "c2"), ("b", 1, "late")], schema), 3)
    got = jobs.read_upserted(spark, f"{tmp_path}/small", schema)
    assert rows(got, "instance_id", "seq", "v") == [("a", 6, "newest"), ("b", 2, "b2"), ("c", 2, "c2")]
    assert jobs.read_upserted(spark, f"{tmp_path}/none", schema).count() == 0


def test_segments_across_batches_equal_the_batch_twin(spark, tmp_path):
    schema = "session string, seq long, kind string, func string, depth int"
    data = [
        ("s", 0, "call", "main", 0), ("s", 1, "call", "test_a", 1), ("s", 2, "call", "test_inner", 2), ("s", 3, "return", "test_inner", 2),
        ("s", 4, "return", "test_a", 1), ("s", 5, "call", "test_b", 1), ("s", 6, "return", "test_b", 1), ("s", 7, "return", "main", 0),
    ]
    stream = feed(spark, tmp_path, schema, data[:2], data[2:4], data[4:])
    streamed = run(jobs.stream_segment(stream), tmp_path)
    batch = events.segment_tests(spark.createDataFrame(data, schema)).select("session", "seq", "test", "test_start")
    key = lambda df: sorted((r["session"], r["seq"], r["test"], r["test_start"]) for r in df.collect())
    assert key(streamed) == key(batch)
    assert {r["test"] for r in streamed.collect()} == {"session", "test_a", "test_b"}


def test_a_run_completes_once_and_only_when_nothing_is_open(spark, tmp_path):
    schema = "run string, unit string, state string, seq int, expected int"
    stream = feed(
        spark, tmp_path, schema,
        [("r", "u1", "pending", 0, 2), ("r", "u1", "succeeded", 1, 2), ("q", "u1", "succeeded", 0, 2)],
        [("r", "u2", "active", 2, 2)],
        [("r", "u2", "failed", 3, 2), ("q", "u1", "succeeded", 1, 2)],
        [("r", "u2", "failed", 4, 2)],
    )
    assert rows(run(jobs.stream_completed_runs(stream), tmp_path)) == [("r", 2)]


def test_live_status_counts(spark, tmp_path):
    stream = feed(spark, tmp_path, "run string, component string, state string", [("r", "w", "active")], [("r", "w", "active"), ("r", "w", "failed")])
    query = (
        jobs.stream_run_status(stream).writeStream.format("memory").queryName("status").outputMode("complete").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert rows(spark.table("status")) == [("r", "w", "active", 2), ("r", "w", "failed", 1)]
    assert spark.table("status").agg(F.sum("n")).first()[0] == 3
