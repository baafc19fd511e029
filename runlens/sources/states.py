"""Reading and writing state records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runlens.operators.filters import unknown_fields, validate_states
from runlens.schemas import STATES


def read_states_jsonl(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Valid states, and invalid lines with the rules they break and the line itself.

    Blank lines are skipped. Metadata may be an object or already a JSON text; fields outside the
    schema make a line invalid.
    """
    lines = spark.read.text(path).where(F.trim("value") != "")
    # Objects inside a record stay JSON text, so one fixed schema reads both spellings.
    record = F.from_json("value", STATES, {"mode": "PERMISSIVE"})
    broken_json = F.try_parse_json("value").isNull()
    parsed = lines.select(
        F.col("value").alias("line"), broken_json.alias("_broken"), unknown_fields(F.col("value")).alias("unknown_fields"), record.alias("_r")
    ).select("line", "_broken", "unknown_fields", "_r.*")
    unreadable = parsed.where(F.col("_broken")).select("line", F.array(F.lit("json")).alias("broken_rules"))
    ok, bad = validate_states(parsed.where(~F.col("_broken")).drop("_broken"))
    return ok.select(*STATES.names), bad.select("line", "broken_rules").unionByName(unreadable)


def read_states(spark: SparkSession, path: str, instance_ids: list[str] | DataFrame | None = None) -> DataFrame:
    """Published states; only wanted ids are materialized.

    A list or table of ids is a semi join, for which Spark can build a runtime filter.
    """
    states = spark.read.schema(STATES).parquet(path)
    return pick_ids(states, instance_ids)


def pick_ids(states: DataFrame, instance_ids: list[str] | DataFrame | None) -> DataFrame:
    if instance_ids is None:
        return states
    if not isinstance(instance_ids, DataFrame):
        instance_ids = states.sparkSession.createDataFrame([(i,) for i in instance_ids], "instance_id string")
    return states.join(instance_ids.select("instance_id"), "instance_id", "left_semi")


def select_ids(df: DataFrame, ids: DataFrame, key: str = "instance_id") -> tuple[DataFrame, DataFrame]:
    """Rows of an ordered id table `(pos, key)` in its order, and the ids that do not exist."""
    asked = ids.select("pos", key)
    return df.join(asked, key).orderBy("pos"), asked.join(df.select(key), key, "left_anti")


def _or_empty(name: str) -> Column:
    return F.coalesce(F.nullif(F.col(name), F.lit("")), F.lit("{}"))


def decode_metadata(states: DataFrame, columns: tuple[str, ...] = ("metadata",)) -> DataFrame:
    """Stored JSON text to VARIANT; null and empty text become an empty object."""
    for name in columns:
        states = states.withColumn(name, F.parse_json(_or_empty(name)))
    return states


def encode_metadata(states: DataFrame, columns: tuple[str, ...] = ("metadata",)) -> DataFrame:
    """Maps, structs or VARIANT back to JSON text, an absent value to an empty object."""
    for name in columns:
        kind = states.schema[name].dataType
        text = F.col(name) if isinstance(kind, T.StringType) else F.to_json(name)
        states = states.withColumn(name, F.coalesce(F.nullif(text, F.lit("")), F.lit("{}")))
    return states


def with_metadata_key(states: DataFrame, key: str, value: Column) -> DataFrame:
    """Add or replace one text entry of the metadata; text that is no object counts as empty.

    Entries travel as VARIANT, so nested objects and numbers keep their types.
    """
    decoded = F.try_parse_json(_or_empty("metadata"))
    entries = F.coalesce(F.try_variant_get(decoded, "$", "map<string,variant>"), F.expr("cast(map() as map<string,variant>)"))
    others = F.map_filter(entries, lambda name, _: name != key)
    added = F.create_map(F.lit(key), value.cast("variant"))
    return states.withColumn("metadata", F.to_json(F.map_concat(others, added)))
