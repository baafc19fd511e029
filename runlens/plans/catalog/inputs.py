"""Library-shaped inputs built from the shared views."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.operators.outcomes import fold_outcomes
from runlens.operators.sampling import reported
from runlens.plans import datasets
from runlens.plans.catalog.registry import frame
from runlens.schemas import OUTCOME_FIELDS


def state_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States without lists, metadata as the stored JSON text."""
    states = frame(spark, sf_dir, "fx_states")
    group = F.when(
        F.col("group_id").isNotNull(), F.struct(F.col("group_id").alias("instance_id"), F.col("variant"))
    )
    base_id = F.when(F.col("base_commit").isNull(), F.concat(F.lit("none_"), F.col("repo")))
    metadata = F.to_json(
        F.struct(base_id.alias("base_id"), group.alias("swefficiency"), F.col("collection_error"))
    )
    return states.withColumn("metadata", metadata)


def states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States in record form: five lists each, null where nothing was measured."""
    lists = fold_outcomes(frame(spark, sf_dir, "fx_outcomes"), frame(spark, sf_dir, "fx_discovery"))
    joined = state_scalars(spark, sf_dir).join(lists, "instance_id", "left")
    others = [c for c in joined.columns if c not in OUTCOME_FIELDS]
    return joined.select(*others, *[F.when(F.col("measured"), F.col(c)).alias(c) for c in OUTCOME_FIELDS])


def narrow_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scalar state rows as the dataset filters take them, outcomes reduced to a flag."""
    told = reported(frame(spark, sf_dir, "fx_measured")).groupBy("instance_id").agg(F.lit(True).alias("has_outcomes"))
    joined = frame(spark, sf_dir, "fx_states").join(told, "instance_id", "left")
    return joined.select(*datasets.NARROW[:-1], F.coalesce("has_outcomes", F.lit(False)).alias("has_outcomes"))


def joined_list(col, alias: str):
    """Lists leave the registered queries as sorted, comma-joined text."""
    return F.array_join(F.array_sort(col), ",").alias(alias)


def scratch_folder(spark: SparkSession) -> str:
    """A fresh folder below the shared checkpoint folder; a local session may use a temporary one."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder")
        return tempfile.mkdtemp(prefix="run-")
    return f"{shared.rstrip('/')}/run-{spark.sparkContext.applicationId}-{spark.sql('select uuid()').first()[0]}"
