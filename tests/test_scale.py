"""Plans and state calls that must not grow with what a query asks of its tables."""

import pathlib

import pytest
from pyspark.sql import Row

import __spark_entry__ as entry
from runlens.operators import scoring
from runlens.streaming import jobs

SF = "/root/testdata/sf0.001"
tables = pytest.mark.skipif(not pathlib.Path(SF).exists(), reason="driver tables not present")


@tables
@pytest.mark.parametrize(
    "name, scans", [("value_tables", 2), ("hot_truth", 2), ("build_samples", 2), ("with_prompts", 4), ("benchmark_dataset", 6), ("score_hot", 4)]
)
def test_lines_are_read_once_per_use(spark, name, scans):
    plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet [l_") <= scans


@tables
def test_rankings_are_shuffled_by_sample_only(spark):
    plan = entry.queries()["score_hot"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 4 and plan.count("REPARTITION_BY_COL") == 4


def test_scores_of_repeated_and_missing_rows(spark):
    task = "hot_methods_time"
    responses = spark.createDataFrame([("m", "s"), ("m", "s"), ("n", "s"), ("m", None)], "model string, sample_id string")
    preds = spark.createDataFrame([("m", "s", task, 0, "a"), ("m", "s", task, 1, "x"), (None, "s", task, 0, "b")], "model string, sample_id string, subtask string, pos int, name string")
    truth = spark.createDataFrame([("s", task, 0, "a"), (None, task, 0, "a")], "sample_id string, subtask string, pos int, name string")
    values = spark.createDataFrame([("s", task, "a", 4.0), ("s", task, "a", 4.0), (None, task, "a", 1.0)], "sample_id string, subtask string, name string, value double")
    got = scoring.score_hot(responses, preds, truth, values).where(f"subtask = '{task}'").collect()
    assert len(got) == 4
    by = {(r["model"], r["sample_id"]): r for r in got}
    told = by["m", "s"]
    # The name listed twice counts twice, on both sides.
    assert told["executed_ratio"] == pytest.approx(2 / 3) and told["recall_at_5_top1"] == 1.0
    assert told["ndcg_at_5"] == pytest.approx(8 / (4 + 4 / 1.584962500721156))
    assert told["ndcg_pred_oracle"] == pytest.approx(1.0)
    assert by["n", "s"]["ndcg_at_5"] == 0.0 and by["n", "s"]["ndcg_pred_oracle"] is None and by["n", "s"]["recall_at_5_top1"] == 0.0
    assert by["m", None]["executed_ratio"] == 0.0 and by["m", None]["recall_at_5_top1"] is None


class Held:
    """A state variable that counts its calls."""

    def __init__(self):
        self.held, self.calls = {}, 0

    def __getattr__(self, name):
        def call(key=(), value=None):
            self.calls += 1
            if name in ("update", "updateValue"):
                self.held[key if name == "updateValue" else ()] = value if name == "updateValue" else key
            elif name == "clear":
                self.held.clear()
            return {"get": self.held.get(()), "getValue": self.held.get(key), "containsKey": key in self.held}.get(name)

        return call


class Handle:
    def __init__(self):
        self.states = []

    def getMapState(self, *_):
        self.states.append(Held())
        return self.states[-1]

    getValueState = getMapState


def test_a_run_costs_a_few_state_calls_whatever_units_it_has():
    handle, units = Handle(), jobs.OpenUnits()
    units.init(handle)

    def batch(*rows):
        return [(r["run"], r["units"]) for r in units.handleInputRows(("r",), iter([Row(unit=u, seq=s, expected=200, state=t) for u, s, t in rows]), None)]

    assert batch(*[(f"u{i}", s, "pending" if s == 0 else "active" if i == 7 else "succeeded") for i in range(200) for s in (0, 1)]) == []
    assert sum(s.calls for s in handle.states) <= 6
    assert batch(("u3", 2, "failed")) == []
    assert batch(("u7", 2, "failed"), ("u7", 1, "active")) == [("r", 200)]
    assert batch(("u7", 3, "active")) == [] and batch(("u7", 4, "failed")) == []
