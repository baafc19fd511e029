"""Frames that come several times in one plan: on own rows, against the oracles."""

import collections
import datetime
import re

import duckdb
import pytest

import __spark_entry__ as entry
from runlens.operators import traces
from tools.check_oracle import canon

LINES = """l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double,
           l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"""
ORDERS = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    day = datetime.datetime(1996, 1, 1)
    rows = [
        (i // 9, i % 31, i % 16, i % 7 + 1, float(i * 7 % 50 + 1), 1000.0 + i * 911 % 50_000, i % 11 / 100, i % 9 / 100, "ANR"[i % 3], "FO"[i % 2], day)
        for i in range(400)
    ]
    at = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(rows, LINES).write.parquet(f"{at}/lineitem.parquet")
    # Orders may come twice, also with another customer, and their keys may be null.
    orders = [(i % 43 if i < 50 else None, i * 3 % 20, "FOP"[i % 3], 20_000.0 + i * 9_973 % 480_000, day, PRIORITIES[i % 5]) for i in range(52)]
    spark.createDataFrame(orders, ORDERS).write.parquet(f"{at}/orders.parquet")
    return str(at)


def oracle(folder, name, *tables):
    with duckdb.connect() as duck:
        for table in tables:
            duck.execute(f"create view {table} as select * from '{folder}/{table}.parquet/*.parquet'")
        answer = duck.execute(entry.oracle_sql()[name])
        columns = [d[0] for d in answer.description]
        return canon(columns, answer.fetchall())


def defined(df):
    """How often a plan defines each table expression; Spark tells them apart by id only."""
    plan = df._jdf.queryExecution().analyzed().toString()
    return collections.Counter(re.findall(r"CTERelationDef (\d+)", plan))


@pytest.mark.parametrize("name", ["leaderboard", "rank_models"])
def test_boards_define_no_table_expression_twice(spark, folder, name):
    df = entry.queries()[name](spark, folder)
    assert max(defined(df).values(), default=0) <= 1
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == oracle(folder, name, "lineitem")


def test_functions_of_a_flat_dataset_are_shuffled_by_test_once(spark, folder):
    df = entry.queries()["benchmark_dataset"](spark, folder)
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == oracle(folder, "benchmark_dataset", "lineitem", "orders")
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert not re.findall(r"Exchange hashpartitioning\(instance_id#\d+, test#\d+, [a-z]", plan)
    assert len(re.findall(r"(?<!Reused)Exchange hashpartitioning\(l_orderkey#", plan)) <= 1
    assert plan.count("partial_collect_list(struct(pos, ") == 1


def test_rows_laid_out_are_the_same_rows(spark):
    rows = [("a", "t", 1, None), ("a", "t", 1, None), ("a", None, 2, "x"), (None, None, 3, "y"), ("a", "t", None, "z")]
    df = spark.createDataFrame(rows, "instance_id string, test string, pos int, name string")
    assert collections.Counter(tuple(r) for r in traces.laid_out(df, traces.KEYS).collect()) == collections.Counter(rows)
