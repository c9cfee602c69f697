"""Every registered query against its SQL on the smallest tables."""

import importlib.util
import os
import subprocess
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"


def load(name, path):
    spec = importlib.util.spec_from_file_location(name, path)
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


entry = load("entry", f"{ROOT}/__spark_entry__.py")
check = load("check_oracle", f"{ROOT}/tools/check_oracle.py")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in check.TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 90


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


FOREIGN = f"""
import importlib.util
from pyspark.sql import SparkSession
spec = importlib.util.spec_from_file_location("entry", {f"{ROOT}/__spark_entry__.py"!r})
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
print("rows", entry.entry(spark).count())
"""


def test_a_session_made_elsewhere_gets_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", FOREIGN], cwd=tmp_path, env=env, timeout=180,
                          capture_output=True, text=True)
    assert "rows " in done.stdout, done.stderr[-2000:]


@pytest.mark.parametrize("name", entry.queries())
def test_query_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    assert "BatchEvalPython" not in plan  # no row-at-a-time functions
    got = check.rows_of(df.columns, df.collect())
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    result = duck.execute(sql)
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == check.rows_of(columns, result.fetchall())
