"""Every registered query against its SQL, on the smallest of the given tables."""

import os
import sys
from pathlib import Path

import duckdb
import pytest

from conftest import SF_DIR, plan_of

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

import __spark_entry__ as entry  # noqa: E402
from check import TABLES, compare  # noqa: E402

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason=f"no tables in {SF_DIR}")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(entry.library_queries()) == set(entry.library_sql())


@pytest.mark.parametrize("name", list(entry.library_queries()))
def test_query_equals_sql(spark, duck, name):
    sql = entry.oracle_sql()[name]
    result, _ = compare(spark, duck, SF_DIR, name, entry.queries()[name], sql)
    assert result.startswith("ok"), result


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_scans_read_only_what_they_need(spark):
    plan = plan_of(entry.scan_project(spark, SF_DIR))
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string>" in plan
    plan = plan_of(entry.carry_over(spark, SF_DIR))
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in plan
    plan = plan_of(entry.upsert_audit(spark, SF_DIR))
    assert "event_type" not in plan and "props" not in plan
