"""Structured Streaming jobs: resumable results, upserts, live status, test segments, completion."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from runlens.operators.runs import JOB_STATES
from runlens.operators.skew import first_row

# State larger than memory lives on disk and is checkpointed incrementally.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def first_results(results: DataFrame, key: str = "instance_id") -> DataFrame:
    """Each id once, whichever batch or restart brings it again."""
    return results.dropDuplicates([key])


def stream_results(results: DataFrame, path: str, checkpoint: str, key: str = "instance_id") -> StreamingQuery:
    """Append each id's first result as it lands; a restart continues from the checkpoint."""
    use_rocksdb(results.sparkSession)
    return (
        first_results(results, key)
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(path)
    )


def upsert_batch(path: str, source: str, key: str, order: str):
    """A foreachBatch function that adds a batch's newest row of each key, in a folder of the batch's own.

    A batch that is replayed after a failure writes the same folder again. `source` names the stream, since
    every stream counts its own batches.
    """

    def add(batch: DataFrame, number: int) -> None:
        newest = first_row(batch, [key], [F.col(order).desc_nulls_last()])
        newest.write.mode("overwrite").parquet(f"{path}/source={source}/batch={number}")

    return add


def read_upserted(spark: SparkSession, path: str, schema, key: str = "instance_id", order: str = "seq") -> DataFrame:
    """The newest row of each key over all batches so far; of equal ones that of the earliest batch.

    Late and replayed batches change nothing that is newer. A folder that does not exist yet holds no rows.
    """
    try:
        rows = spark.read.schema(f"{_ddl(schema)}, source string, batch bigint").option("basePath", path).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    newest = first_row(rows, [key], [F.col(order).desc_nulls_last(), F.col("batch"), F.col("source")])
    return newest.drop("source", "batch")


def _ddl(schema) -> str:
    return schema if isinstance(schema, str) else ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


def compact_upserted(spark: SparkSession, path: str, target: str, schema, key: str = "instance_id", order: str = "seq") -> None:
    """Write what `read_upserted` finds to another folder, as the first batch of the table that goes on there."""
    read_upserted(spark, path, schema, key, order).write.mode("overwrite").parquet(f"{target}/source=compacted/batch=-1")


def stream_upsert(rows: DataFrame, path: str, checkpoint: str, key: str = "instance_id", order: str = "seq") -> StreamingQuery:
    """Filled rows into the state table as they arrive; the newest version of an id wins."""
    source = hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()[:12]
    return (
        rows.writeStream.foreachBatch(upsert_batch(path, source, key, order))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_run_status(events: DataFrame) -> DataFrame:
    """Live counts per run, component and state; write in update or complete mode."""
    return events.groupBy("run", "component", "state").agg(F.count(F.lit(1)).alias("n"))


class OpenTest(StatefulProcessor):
    """Remembers the test a session is in between batches.

    One small value per session: the open test, its depth and its first ordinal. Sessions that never
    end cost nothing more.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.open = handle.getValueState("open", "test string, depth long, start long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True).sort_values("seq")
        test, depth, start = self.open.get() if self.open.exists() else (None, None, None)
        labels, starts = [], []
        for row in batch.itertuples():
            if test is None and row.kind == "call" and row.func.startswith("test_"):
                test, depth, start = row.func, int(row.depth), int(row.seq)
            labels.append(test or "session")
            starts.append(start)
            if test is not None and row.kind == "return" and row.depth == depth:
                test, depth, start = None, None, None
        if test is None:
            self.open.clear()
        else:
            self.open.update((test, depth, start))
        yield pd.DataFrame(
            {
                "session": key[0],
                "seq": batch["seq"].to_numpy(),
                "test": labels,
                "test_start": pd.array(starts, dtype="Int64"),
            }
        )

    def close(self) -> None:
        pass


def stream_segment(events: DataFrame) -> DataFrame:
    """Label call and return events with the open test, over sessions that span many batches.

    Events of a session arrive in order across batches; a trigger limit bounds what one batch holds.
    """
    use_rocksdb(events.sparkSession)
    return events.groupBy("session").transformWithStateInPandas(
        statefulProcessor=OpenTest(),
        outputStructType="session string, seq long, test string, test_start long",
        outputMode="append",
        timeMode="none",
    )


# Units of one page of a run's state, on average, and units of a run settled at a time.
PAGE_UNITS = 256
SETTLED_UNITS = 100_000


class OpenUnits(StatefulProcessor):
    """Counts the units of a run that are not finished.

    Units lie on pages by a hash of their name, as many pages as the run's size calls for when it is first seen, kept
    on disk. A batch reads and writes a page once, and only pages of the units it brings. A run that was told needs
    no pages any more.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.pages = handle.getMapState("pages", "page int", "open array<string>, finished array<string>")
        self.counts = handle.getValueState("counts", "units long, open long, expected long, pages int, done boolean")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        found = self.counts.get()
        units, still_open, expected, pages, done = found or (0, 0, 0, 0, False)
        if done:
            return
        fresh: dict[int, tuple[set, set]] = {}
        newest: dict[str, tuple[int, bool]] = {}

        def settle() -> None:
            nonlocal units, still_open, pages
            pages = pages or 1 + expected // PAGE_UNITS
            by_page: dict[int, list] = {}
            for unit, (_, is_open) in newest.items():
                by_page.setdefault(zlib.crc32(str(unit).encode()) % pages, []).append((unit, is_open))
            for page, changed in by_page.items():
                if page not in fresh:
                    held = self.pages.getValue((page,)) if found and self.pages.containsKey((page,)) else ([], [])
                    fresh[page] = set(held[0]), set(held[1])
                unfinished, finished = fresh[page]
                before = len(unfinished), len(unfinished) + len(finished)
                for unit, is_open in changed:
                    (finished if is_open else unfinished).discard(unit)
                    (unfinished if is_open else finished).add(unit)
                still_open += len(unfinished) - before[0]
                units += len(unfinished) + len(finished) - before[1]
            newest.clear()

        for row in rows:
            expected = max(expected, int(row["expected"]))
            seq, is_open = row["seq"], row["state"] in JOB_STATES[:2]
            if row["unit"] not in newest or newest[row["unit"]][0] <= seq:
                newest[row["unit"]] = seq, is_open
            if len(newest) >= SETTLED_UNITS:
                settle()
        settle()
        complete = units >= expected and still_open == 0
        self.counts.update((units, still_open, expected, pages, complete))
        if complete:
            if found:
                self.pages.clear()
            yield Row(run=key[0], units=units)
            return
        for page, (unfinished, finished) in fresh.items():
            self.pages.updateValue((page,), (list(unfinished), list(finished)))

    def close(self) -> None:
        pass


def stream_completed_runs(events: DataFrame) -> DataFrame:
    """A run once none of its expected units is pending or active.

    `events(run, unit, state, seq, expected)` carries the unit's newest state and the run's size.
    """
    use_rocksdb(events.sparkSession)
    return events.groupBy("run").transformWithState(
        statefulProcessor=OpenUnits(), outputStructType="run string, units long", outputMode="append", timeMode="none"
    )
