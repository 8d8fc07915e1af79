"""Plan shape guards for every registered query: no cartesian or nested-loop joins, column
pruning into the scans, and identical results with 1 and many shuffle partitions."""

import re

import pytest

import __spark_entry__ as entry
from sylva.plans.catalog import QUERIES
from conftest import SF_SMALL
from tools.oracle_check import table_hash

NAMES = sorted(QUERIES)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NAMES)
def test_no_cartesian_or_nested_loop(spark, name):
    plan = _plan(entry.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_scans_are_pruned(spark):
    plan = _plan(entry.queries()["emissions_products"](spark, SF_SMALL))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert schemas
    # lineitem has 11 columns; no scan reads them all
    assert all(s.count(":") < 11 for s in schemas)


@pytest.mark.parametrize("name", ["cohort_groups", "split_disturbed", "emissions_products", "resolve_events"])
def test_same_result_with_one_or_many_partitions(spark, name):
    fn = entry.queries()[name]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        results = []
        for n in ("1", "11"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            df = fn(spark, SF_SMALL)
            results.append(table_hash(df.columns, [tuple(r) for r in df.collect()]))
        assert results[0] == results[1]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
