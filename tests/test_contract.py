"""Every registered query against its SQL, and the plans of all of them."""

import os
import re
import sys

import duckdb
import pytest
from conftest import SMALL, plan_of

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as contract
import check

from stratalake.plans.catalog import QUERIES
from stratalake.plans.oracle import oracle_queries

# These run jobs of their own; what they return is a read or a finished report.
RUNNING = {
    "fact_year_pruned", "dq_fact_grain", "dq_monitor_report", "event_quarantine", "event_store_merged", "silver_event_incremental", "table_published", "silver_student_digests",
    "fact_years_updated", "dq_volume_history",
    *(name for name in QUERIES if name.startswith(("bronze_", "batch_", "event_stream_"))),
}


@pytest.fixture(scope="module")
def connection():
    found = duckdb.connect()
    for table in check.TABLES:
        found.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    return found


def test_every_query_has_sql():
    assert set(QUERIES) == set(oracle_queries())
    assert set(QUERIES) <= set(contract.queries()) and set(oracle_queries()) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, connection, name):
    same, got, want, _, types = check.compare(spark, connection, SMALL, name)
    assert len(want[1]) > 0
    assert same, (got[0], want[0], len(got[1]), len(want[1]), types)


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["id_municipio", "ano", "rede", "taxa_realizada", "target", "gap"]
    assert df.count() > 0


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in RUNNING])
def test_plans_have_no_cross_join_python_or_cache(spark, settings, name):
    """Without broadcasts, as on large inputs, every join is an equi-join over a shuffle."""
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    plan = plan_of(QUERIES[name](spark, SMALL))
    assert not re.search(r"CartesianProduct|NestedLoop|Broadcast|Python|Pandas|InMemoryTableScan|CollectLimit", plan)
