"""Session settings shared by tests, bench and the driver entry."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int = 8, partitions: int = 8, app: str = "runlens") -> SparkSession:
    """A session for tests and bench runs on one machine."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return (
        builder.config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that Python stages can import it there.

    The archive lies in the driver's own temporary folder; Spark's file server hands it to the executors.
    """
    application = spark.sparkContext.applicationId
    if application in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    handle, archive = tempfile.mkstemp(prefix="runlens-", suffix=".zip")
    with os.fdopen(handle, "wb") as out, zipfile.ZipFile(out, "w") as files:
        for path in sorted(package.rglob("*.py")):
            files.write(path, path.relative_to(package.parent))
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(application)


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Cut lineage through the shared folder named in spark.checkpoint.dir.

    Only a local master without that setting falls back to a temporary folder.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a shared folder")
            folder = tempfile.mkdtemp(prefix="run-")
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint()
