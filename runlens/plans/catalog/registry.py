"""Query registration and the views both engines build from the driver's tables."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.plans.catalog.views import TABLES, VIEWS
from runlens.session import ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, tuple[str, tuple[str, ...]]] = {}


def _uses(sql: str, names: list[str]) -> list[str]:
    words = set(re.findall(r"\w+", sql))
    return [name for name in names if name in words]


def _needed(sql: str, given: tuple[str, ...] = ()) -> list[str]:
    """Views a text needs, inner ones first; those that are given need no text."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in _uses(text, list(VIEWS)):
            if name not in order and name not in given:
                visit(VIEWS[name])
                order.append(name)

    visit(sql)
    return order


def with_views(sql: str, given: tuple[str, ...] = ()) -> str:
    """Prefix the views a text refers to as common table expressions."""
    parts = [f"{name} AS ({VIEWS[name].strip()})" for name in _needed(sql, given)]
    sql = sql.strip()
    if not parts:
        return sql
    for start in ("WITH RECURSIVE ", "WITH "):
        if sql.upper().startswith(start):
            return start + ",\n".join(parts) + ",\n" + sql[len(start) :]
    return "WITH " + ",\n".join(parts) + "\n" + sql


# Table readers per session and folder: the schema is read from a footer only once.
_READS: dict[tuple[str, str, str], DataFrame] = {}

# Stored bytes of the read tables that one partition of a shuffle stands for at most.
SHARE_BYTES = 4 << 20
FIRST_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def _fit_shuffles(spark: SparkSession, path: str) -> None:
    """Shuffles start with as many partitions as the largest table calls for, so that what a task holds does not
    grow with the tables; adaptive execution joins small ones."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    stored = files.agg(F.sum("length")).first()[0] or 0
    now = int(spark.conf.get(FIRST_PARTITIONS, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    needed = -(-stored // SHARE_BYTES)
    if needed > now:
        spark.conf.set(FIRST_PARTITIONS, str(needed))


def _table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    place = (spark.sparkContext.applicationId, sf_dir, table)
    ship_package(spark)
    if place not in _READS:
        _READS[place] = spark.read.parquet(f"{sf_dir}/{table}.parquet")
        _fit_shuffles(spark, f"{sf_dir}/{table}.parquet")
    return _READS[place]


def frame(spark: SparkSession, sf_dir: str, sql: str, repeated: bool = False, **given: DataFrame) -> DataFrame:
    """Run view SQL on Spark; a bare name means the whole view or table.

    `given` stands in for views or tables of those names: the same rows, laid out for what follows. Such a frame, or
    one that is `repeated` on purpose, may come several times in one plan.
    """
    if re.fullmatch(r"\w+", sql):
        sql = f"SELECT * FROM {sql}"
    text = with_views(sql, tuple(given))
    for table in _uses(text, TABLES):
        if table not in given:
            _table(spark, sf_dir, table).createOrReplaceTempView(table)
    for name, rows in given.items():
        rows.createOrReplaceTempView(name)
    if not (given or repeated):
        return spark.sql(text)
    # Spark tells table expressions apart by id, and mixes up those that come again in a plan with other columns; views
    # have none.
    for name in _needed(sql, tuple(given)):
        spark.sql(VIEWS[name]).createOrReplaceTempView(name)
    return spark.sql(sql)


def query(name: str, oracle: str | None = None, doubles: tuple[str, ...] = ()):
    """Register a query; `oracle` may refer to the shared views by name.

    `doubles` are integer columns with nulls. Both engines return them as doubles, because tools that
    compare through data frames render nullable integers differently.
    """

    def register(run: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")

        def with_doubles(spark: SparkSession, sf_dir: str) -> DataFrame:
            return run(spark, sf_dir).withColumns({c: F.col(c).cast("double") for c in doubles})

        QUERIES[name] = with_doubles if doubles else run
        QUERIES[name].__module__ = run.__module__
        if oracle is not None:
            ORACLES[name] = (oracle, doubles)
        return run

    return register


def oracle_text(name: str) -> str:
    """The oracle with the views it needs; resolved once every catalog module has defined its views."""
    oracle, doubles = ORACLES[name]
    text = with_views(oracle)
    if doubles:
        casts = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in doubles)
        text = f"SELECT * REPLACE ({casts}) FROM ({text})"
    return text
