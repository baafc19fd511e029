"""Readers of test reports, profiles, predictions and commit logs."""

from __future__ import annotations

import xml.parsers.expat
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.functions.testnames import flag_status, with_case_status
from runlens.operators.outcomes import merge_report_cases, report_conflicts
from runlens.schemas import CASE_REPORT, EVAL_REPORT_NUMBERS, PREDICTIONS, PROFILE_DOCUMENT, TESTCASE_XML
from runlens.sources.documents import map_documents, read_whole

# Fixed value: the test a workload profile is read for.
WORKLOAD_TEST = "test_workload.py::test_workload"


# A comment, a CDATA section or a whole testcase; possessive, so that a text of any length takes no stack.
_APART = r"<!--(?:[^-]++|-(?!->))*+-->|<!\[CDATA\[(?:[^\]]++|\](?!\]>))*+\]\]>"
_TESTCASE = (
    rf"(?:{_APART})|"
    rf"""<testcase(?=[\s/>])(?:[^>"'/]++|"[^"]*+"|'[^']*+'|/(?!>))*+(?:/>|>(?:[^<]++|{_APART}|<(?!/testcase[\s>]))*+</testcase\s*+>)"""
)


def read_junit(spark: SparkSession, path: str, pattern: str = "*.xml", packed: bool = False) -> DataFrame:
    """Testcases of XML reports with their status; `instance_id` is the folder, `report` the file.

    Packed reports (`documents.write_packed`) are cut into their testcases, which the same XML parser reads.
    """
    if packed:
        whole = map_documents(read_whole(spark, path, pattern, packed=True), _only_well_formed, "path string, value string")
        pieces = F.filter(
            F.regexp_extract_all("value", F.lit(_TESTCASE), F.lit(0)), lambda piece: piece.startswith("<testcase")
        )
        # One parse per report, whatever encloses its cases.
        flat = F.concat(F.lit("<report>"), F.array_join(pieces, ""), F.lit("</report>"))
        parsed = F.from_xml(flat, f"testcase array<{TESTCASE_XML.simpleString()}>")
        cases = whole.select("path", F.explode(parsed["testcase"]).alias("case"))
        placed = cases.select("case.*", "path", _segment("path", -1).alias("report"))
    else:
        cases = (
            spark.read.format("xml")
            .option("rowTag", "testcase")
            .option("pathGlobFilter", pattern)
            .option("recursiveFileLookup", "true")
            .schema(TESTCASE_XML)
            .load(path)
        )
        placed = cases.select(
            "*", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("report")
        )
    return with_case_status(placed.withColumn("instance_id", _segment("path", -2)))


def _segment(name: str, position: int):
    return F.element_at(F.split(name, "/"), position)


def _parses(content: bytes | str) -> bool:
    try:
        xml.parsers.expat.ParserCreate().Parse(content, True)
    except xml.parsers.expat.ExpatError:
        return False
    return True


def _well_formed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"path": batch["path"], "well_formed": [_parses(c) for c in batch["content"]]})


def _only_well_formed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield batch[[_parses(c) for c in batch["value"]]]


def list_reports(spark: SparkSession, path: str, pattern: str = "*.xml", packed: bool = False) -> DataFrame:
    """Report files and whether each is well-formed; the XML reader yields nothing for broken ones."""
    if packed:
        files = read_whole(spark, path, pattern, packed=True).withColumnRenamed("value", "content")
    else:
        files = (
            spark.read.format("binaryFile")
            .option("pathGlobFilter", pattern)
            .option("recursiveFileLookup", "true")
            .load(path)
        )
    checked = map_documents(files.select("path", "content"), _well_formed, "path string, well_formed boolean")
    return checked.withColumn("instance_id", _segment("path", -2)).withColumn("report", _segment("path", -1))


def junit_problems(instances: DataFrame, files: DataFrame, cases: DataFrame) -> DataFrame:
    """Instances without a usable report, with the first problem found.

    missing: no file. malformed: a broken file or a case without its attributes. conflicting: one
    test with different statuses in different files. empty: no testcase at all.
    """
    listed = files.groupBy("instance_id").agg(F.bool_and("well_formed").alias("_fine"))
    counted = cases.groupBy("instance_id").agg(
        F.count(F.lit(1)).alias("_cases"), F.bool_or(F.col("kind") == "malformed").alias("_lacking")
    )
    per_file = cases.where(F.col("kind") == "test").select("instance_id", "test", "report", "status").distinct()
    keyed = per_file.withColumn("report", F.concat_ws("/", "instance_id", "report"))
    merged = merge_report_cases(keyed).withColumn("instance_id", F.substring_index("report", "/", 1))
    conflicts = report_conflicts(merged, ["instance_id"]).select("instance_id").distinct().withColumn("_conflict", F.lit(True))
    joined = (
        instances.select("instance_id")
        .join(listed, "instance_id", "left")
        .join(counted, "instance_id", "left")
        .join(conflicts, "instance_id", "left")
    )
    problem = (
        F.when(F.col("_fine").isNull(), "missing")
        .when(~F.col("_fine") | F.coalesce("_lacking", F.lit(False)), "malformed")
        .when(F.col("_conflict"), "conflicting")
        .when(F.col("_cases").isNull(), "empty")
    )
    return joined.select("instance_id", problem.alias("problem")).where(F.col("problem").isNotNull())


FLAGS = ["passed", "failed", "runtime_errors", "timeouts", "memory_limit_exceeded"]


def read_case_report(spark: SparkSession, path: str, packed: bool = False) -> tuple[DataFrame, DataFrame]:
    """Cases of JSON harness reports, and solutions whose flag lists are missing or differ in length."""
    documents = read_whole(spark, path, packed=packed).select(
        F.from_json("value", CASE_REPORT.simpleString()).alias("tasks"), "path"
    )
    solutions = documents.select("path", F.explode("tasks").alias("task", "solutions")).select(
        "path", "task", F.explode("solutions").alias("solution", "lists")
    )
    sizes = [F.size(F.col(f"lists.{flag}")) for flag in FLAGS]
    even = F.coalesce(F.least(*sizes) == F.greatest(*sizes), F.lit(False))
    for flag in FLAGS:
        even = even & F.col(f"lists.{flag}").isNotNull()
    zipped = F.arrays_zip(*[F.col(f"lists.{flag}").alias(flag) for flag in FLAGS])
    cases = solutions.where(even).select("path", "task", "solution", F.posexplode(zipped).alias("index", "case"))
    named = cases.select(
        "path",
        F.concat_ws("::", "task", "solution", F.concat(F.lit("case_"), F.format_string("%03d", "index"))).alias("test"),
        flag_status(*[F.col(f"case.{flag}") for flag in FLAGS]).alias("status"),
    )
    return named, solutions.where(~even).select("path", "task", "solution")


def read_workload_profiles(
    spark: SparkSession,
    root: str,
    workload_test: str = WORKLOAD_TEST,
    pattern: str = "cprofile_output.json",
    packed: bool = False,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Workload record and function rows per state, and how many reports lack the workload.

    The first path segment below `root` is the state id. Reports are read whole: one JSON document
    is one record, so a report has to fit a task.
    """
    files = read_whole(spark, root, pattern, packed)
    below = F.element_at(F.split("path", F.lit(f"/{root.rstrip('/').split('/')[-1]}/")), -1)
    parsed = files.select(
        F.substring_index(below, "/", 1).alias("instance_id"),
        F.try_element_at(F.from_json("value", PROFILE_DOCUMENT)["tests"], F.lit(workload_test)).alias("record"),
    )
    found = parsed.where(F.col("record").isNotNull())
    workloads = found.select(
        "instance_id", "record.outcome", "record.wall_time_s", F.col("record.profile_time_s").alias("time_s")
    )
    functions = found.select("instance_id", F.explode("record.functions").alias("key", "f")).select(
        "instance_id", "key", "f.*"
    )
    skipped = parsed.agg(
        F.count_if(F.col("record").isNull()).alias("without_workload"),
        F.count_if(F.col("record.profile_time_s").isNull()).alias("untimed"),
        F.count(F.lit(1)).alias("reports"),
    )
    return workloads, functions, skipped


# The harness a file name prefix stands for.
HARNESS_BY_PREFIX = {"oh_": "OpenHands", "sweagent_": "SWE-agent", "cursor_": "Cursor CLI"}


def read_predictions(spark: SparkSession, path: str, harnesses: dict[str, str] | None = None) -> DataFrame:
    """Prediction lines with their source file and the harness its name prefix stands for."""
    rows = spark.read.schema(PREDICTIONS).option("pathGlobFilter", "*.jsonl").json(path)
    placed = rows.select("*", F.col("_metadata.file_name").alias("source_path"))
    stem = F.regexp_replace("source_path", r"\.jsonl\z", "")
    harness = F.coalesce(
        *[F.when(stem.startswith(p), F.lit(h)) for p, h in (harnesses or HARNESS_BY_PREFIX).items()], F.lit(None).cast("string")
    )
    return placed.withColumn("source_stem", stem).withColumn("harness", harness)


MODEL_IN_NAME = r"/(?:eval_report_)?([^/]*)\.csv\z"


def read_eval_reports(spark: SparkSession, path: str, model: str = MODEL_IN_NAME) -> DataFrame:
    """Report rows per model; blank cells are null, numeric cells doubles.

    `model` is the pattern that finds the model in a file's path, by default what follows
    `eval_report_` in its name.
    """
    columns = ["instance_id", *EVAL_REPORT_NUMBERS]
    schema = ", ".join(f"{c} string" for c in columns)
    rows = (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.csv")
        .csv(path, header=True, schema=schema, enforceSchema=False)
    )
    return rows.select(
        F.regexp_extract(F.col("_metadata.file_path"), model, 1).alias("model_name_or_path"),
        F.nullif(F.trim("instance_id"), F.lit("")).alias("instance_id"),
        *[F.nullif(F.trim(c), F.lit("")).try_cast("double").alias(c) for c in EVAL_REPORT_NUMBERS],
    )


def read_commit_log(
    spark: SparkSession, path: str, delimiter: str = "--commit--\n", packed: bool = False
) -> DataFrame:
    """Commits of logs made of delimited blocks, oldest first, numbered per log file.

    A block holds the sha, the parents on one line, then the message. One log is one record.
    """
    if packed:
        files = read_whole(spark, path, packed=True).select(_segment("path", -1).alias("name"), "value")
    else:
        files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("name"), "value")
    logs = files.select(F.regexp_replace("name", r"\.[^.]*\z", "").alias("repo"), "value")
    trimmed = F.transform(F.split("value", F.lit(_literal(delimiter))), lambda b: F.regexp_replace(b, r"\A\n+|\n+\z", ""))
    blocks = F.filter(trimmed, lambda b: b != "")
    return logs.select("repo", F.posexplode(blocks).alias("idx", "block")).select(
        "repo",
        F.col("idx").cast("long").alias("idx"),
        F.substring_index("block", "\n", 1).alias("sha"),
        F.filter(F.split(F.coalesce(F.get(F.split("block", "\n", 3), F.lit(1)), F.lit("")), r"\s+"), lambda p: p != "").alias("parents"),
        F.coalesce(F.regexp_replace(F.get(F.split("block", "\n", 3), F.lit(2)), r"\n+\z", ""), F.lit("")).alias("message"),
    )


def _literal(text: str) -> str:
    """A Java pattern that matches exactly this text."""
    return r"\Q" + text + r"\E"


READERS = {}


def register_reader(name: str, read) -> None:
    """Make a report reader available by name: `read(spark, path) -> DataFrame(instance_id, test, status)`."""
    READERS[name] = read


def read_report(name: str, spark: SparkSession, path: str) -> DataFrame:
    if name not in READERS:
        raise KeyError(f"no report reader named {name!r}; known: {sorted(READERS)}")
    return READERS[name](spark, path)


def _junit_outcomes(spark: SparkSession, path: str) -> DataFrame:
    return read_junit(spark, path).where(F.col("kind") == "test").select("instance_id", "test", "status")


def _case_outcomes(spark: SparkSession, path: str) -> DataFrame:
    cases, _ = read_case_report(spark, path)
    return cases.select(_segment("path", -2).alias("instance_id"), "test", "status")


register_reader("junit", _junit_outcomes)
register_reader("cases", _case_outcomes)
