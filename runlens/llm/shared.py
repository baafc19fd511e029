"""Reading tables, and tables written to the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.session import ship_package

# Rows up to which a table may be broadcast by hint; larger ones are joined by a shuffle.
BROADCAST_ROWS = 1_000_000
# Bytes of an Arrow batch; a session that sets less keeps its own limit. Batches of texts that are taken one by one can
# be small: buffers beyond 4 MB come from no pool of the executor's, and what malloc keeps of them lies beside its heap.
BATCH_BYTES = 4 << 20
SMALL_BATCH = 1 << 20
_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def map_arrow(df: DataFrame, function, schema, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """mapInArrow with this package present on the executors, in batches of bounded size whatever the rows hold."""
    spark = df.sparkSession
    ship_package(spark)
    limit = spark.conf.get(_LIMIT)
    if limit == spark.conf.get("runlens.arrow.set", None):
        limit = spark.conf.get("runlens.arrow.own")  # the session's, before this function set one
    # A set value comes back as it was written, the default as bytes.
    own = limit.lower().rstrip("b")
    now = str(batch_bytes) if not own.isdigit() or int(own) > batch_bytes else limit
    for key, value in ((_LIMIT, now), ("runlens.arrow.own", limit), ("runlens.arrow.set", now)):
        spark.conf.set(key, value)
    return df.mapInArrow(function, schema)


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a local session without it gets one of its own."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="run-")
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends there and survives lost executors."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, rows: int) -> DataFrame:
    """Hint a broadcast for a table of known size only."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def held_out(doc_id: Column | str) -> Column:
    """Whether crc32 of the id's text leaves 2 modulo 4; false for null ids."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 4 == 2, F.lit(False))
