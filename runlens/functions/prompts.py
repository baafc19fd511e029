"""Question texts and bucket labels of the prediction datasets."""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F

# Question texts and label glossary of the published datasets.
TEST_LABELS = {
    "PASSED": "The test is expected to complete successfully.",
    "FAILED": "The test runs but an assertion or explicit failure occurs.",
    "ERROR": "The test cannot complete because of an exception during execution.",
}
SINGLE_TEST_QUESTIONS = {
    "Q3": "Assign the test one of two labels: 'PASSED' or 'NOT_PASSED'.",
    "Q4": "Assign the test one of the following labels: 'PASSED', 'FAILED', 'ERROR'.",
}
ANCHORED_QUESTIONS = {
    "Q-bin": "Are all of the provided tests expected to complete successfully with 'PASSED' outcome?",
    "Q-sort": "Order the provided tests so that all tests labeled 'PASSED' appear first.",
    "Q-bin-per-test": "Assign each test one of two labels: 'PASSED' or 'NOT_PASSED'.",
    "Q-label-per-test": "Assign each test one of the following labels: 'PASSED', 'FAILED', 'ERROR'.",
}
BUDGETS_S = [5, 60, 300]
TIME_QUESTIONS = {
    "Q-seconds": "Predict the wall-clock time in seconds for the provided command to run test_workload.py with pytest.",
    "Q-budget-5s": "Will the provided command finish within 5s of wall-clock time?",
    "Q-budget-60s": "Will the provided command finish within 60s of wall-clock time?",
    "Q-budget-300s": "Will the provided command finish within 300s of wall-clock time?",
}
BUCKET_QUESTION = "Choose the bucket that the wall-clock time of the provided command falls into: "
TOP_QUESTION = (
    "List the top {n} function{plural} of this repository by exclusive (self) wall-clock time when the "
    "provided command runs test_workload.py with pytest, most expensive first. Identify each function "
    "by its file path, its first line number and its qualified name."
)
TOP_N = [1, 5, 20]

LABELS_DESCRIPTION = json.dumps(TEST_LABELS)


def short_number(value: Column) -> Column:
    """A whole number without decimals, any other as it is."""
    return F.regexp_replace(value.cast("string"), r"\.0$", "")


def bucket_labels(dividers: Column | str) -> Column:
    """`<10s`, `10-20s`, `20-45s`, `>45s` from three dividers."""
    edges = F.transform(F.col(dividers) if isinstance(dividers, str) else dividers, short_number)
    count = F.size(edges)
    inner = F.transform(
        F.slice(edges, 2, count - 1), lambda high, at: F.concat(F.get(edges, at), F.lit("-"), high, F.lit("s"))
    )
    return F.concat(
        F.array(F.concat(F.lit("<"), F.get(edges, F.lit(0)), F.lit("s"))),
        inner,
        F.array(F.concat(F.lit(">"), F.element_at(edges, -1), F.lit("s"))),
    )


def bucket_prompt(labels: Column) -> Column:
    return F.concat(F.lit(BUCKET_QUESTION), F.array_join(labels, ", "), F.lit("."))


def fits_budget(time: Column, budget: float) -> Column:
    return time <= F.lit(budget)


def constants(questions: dict[str, str]) -> list[Column]:
    return [F.lit(text).alias(name) for name, text in questions.items()]
