"""Whole documents, one file each or many to a file."""

from __future__ import annotations

import fnmatch

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.session import ship_package

PACKED = "path string, value string"
# Text of any length is one value; the JSON reader's own bound is smaller.
_WHOLE = {"maxStringLen": str(2**31 - 1)}
# Bytes of an Arrow batch of whole documents; a session that sets less keeps its own limit.
BATCH_BYTES = 4 << 20


def read_whole(spark: SparkSession, root: str, pattern: str | None = None, packed: bool = False) -> DataFrame:
    """Documents `(path, value)` below a folder, one record each.

    Loose documents are files. Packed ones are the rows of `write_packed`, with the path that a loose
    one would have below its root: listing, opening and scheduling a file per document takes longer
    than its content once there are hundreds of thousands.
    """
    if packed:
        rows = spark.read.options(**_WHOLE).schema(PACKED).json(root)
        return rows if pattern is None else rows.where(F.element_at(F.split("path", "/"), -1).rlike(_as_regex(pattern)))
    reader = spark.read.option("recursiveFileLookup", "true")
    if pattern is not None:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.text(root, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")


def _as_regex(pattern: str) -> str:
    return r"\A" + fnmatch.translate(pattern)


def write_packed(documents: DataFrame, folder: str) -> None:
    """Documents `(path, value)` as JSON lines, as many to a file as a task holds."""
    documents.select("path", "value").write.json(folder)


def map_documents(df: DataFrame, function, schema: str) -> DataFrame:
    """mapInPandas in batches of bounded size, whatever the documents hold."""
    spark = df.sparkSession
    ship_package(spark)
    # A set value comes back as it was written, the default as bytes.
    limit = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch").lower().rstrip("b")
    if not limit.isdigit() or int(limit) > BATCH_BYTES:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInPandas(function, schema)
