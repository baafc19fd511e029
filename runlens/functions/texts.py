"""Captured output, prompts and host blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def parse_timing_text(col: Column | str, tail: int | None = None) -> list[Column]:
    """Mean and deviation lines of a timing summary, the stored text and whether it was cut.

    The whole text is stored unless the caller asks for a tail; the summary is searched in all of it.
    """
    text = _col(col)

    def number(pattern: str) -> Column:
        return F.nullif(F.regexp_extract(text, pattern, 1), F.lit("")).try_cast("double")

    return [
        (text if tail is None else F.right(text, F.lit(tail))).alias("stdout"),
        (F.lit(False) if tail is None else F.length(text) > tail).alias("stdout_truncated"),
        number(r"(?m)^[ \t]*Mean:[ \t]*(\S+)").alias("workload_mean_s"),
        number(r"(?m)^[ \t]*Std\s*Dev:[ \t]*(\S+)").alias("workload_stdev_s"),
    ]


def assemble_prompt(files: Column, test_file: Column | str, test_content: Column | str, task_text: Column) -> Column:
    """Source files, the test file, then the task.

    `files` is an array of (path, content) in prompt order.
    """

    def block(item: Column) -> Column:
        return F.concat(F.lit("### `"), item["path"], F.lit("`\n```python\n"), item["content"], F.lit("\n```\n"))

    sources = F.when(
        F.size(files) > 0,
        F.concat(
            F.lit("## Source files (slice of the project)\n\n"),
            F.array_join(F.transform(files, block), "\n"),
            F.lit("\n"),
        ),
    ).otherwise("")
    test = F.concat(
        F.lit("## Test file: `"), _col(test_file), F.lit("`\n```python\n"), _col(test_content), F.lit("\n```")
    )
    return F.concat(sources, test, F.lit("\n\n## Task\n\n"), task_text)


# Processor platforms by vendor, family and model.
PLATFORMS = [
    ("GenuineIntel", 6, 45, "Intel Sandy Bridge"),
    ("GenuineIntel", 6, 62, "Intel Ivy Bridge"),
    ("GenuineIntel", 6, 63, "Intel Haswell"),
    ("GenuineIntel", 6, 79, "Intel Broadwell"),
    ("GenuineIntel", 6, 85, "Intel Skylake or Cascade Lake"),
    ("GenuineIntel", 6, 106, "Intel Ice Lake"),
    ("GenuineIntel", 6, 143, "Intel Sapphire Rapids"),
    ("GenuineIntel", 6, 207, "Intel Emerald Rapids"),
    ("GenuineIntel", 6, 173, "Intel Granite Rapids"),
    ("AuthenticAMD", 23, 1, "AMD Naples"),
    ("AuthenticAMD", 23, 49, "AMD Rome"),
    ("AuthenticAMD", 25, 1, "AMD Milan"),
    ("AuthenticAMD", 25, 17, "AMD Genoa"),
    ("AuthenticAMD", 26, 2, "AMD Turin"),
]


def normalize_family(raw: Column | str) -> Column:
    """Family number whether it was recorded summed or packed into one byte."""
    raw = _col(raw)
    return F.when(raw.bitwiseAND(0xF) == 0xF, 15 + F.shiftright(raw, 4)).otherwise(raw)


def normalize_hosts(hosts: DataFrame) -> DataFrame:
    """Family, platform name, model name and a fingerprint of the feature flags."""
    names = F.create_map(
        *[F.lit(x) for vendor, family, model, name in PLATFORMS for x in (f"{vendor}/{family}/{model}", name)]
    )
    flags = F.filter(F.split(F.coalesce("flags", F.lit("")), r"\s+"), lambda f: f != "")
    hosts = hosts.withColumn("family", normalize_family("family"))
    key = F.concat_ws("/", "vendor", F.col("family").cast("string"), F.col("model").cast("string"))
    return hosts.select(
        "*",
        F.try_element_at(names, key).alias("microarch"),
        F.when((F.col("model_name") != "") & (F.col("model_name") != "unknown"), F.col("model_name")).alias("named_model"),
        F.size(flags).alias("flag_count"),
        F.when(F.size(flags) > 0, F.substring(F.sha2(F.array_join(F.sort_array(flags), " "), 256), 1, 12)).alias(
            "flags_hash"
        ),
    )
