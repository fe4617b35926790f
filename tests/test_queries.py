"""Every registered query against its SQL, and the shape of the plans."""

import os
import re
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as driver
from weatherloom.plans.catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def sortable(rows):
    return sorted(rows, key=lambda row: tuple((value is None, "" if value is None else value) for value in row))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows_as_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sortable(tuple(row[c] for c in columns) for row in df.collect())
    result = con.execute(ORACLES[name])
    theirs = [d[0] for d in result.description]
    assert sorted(theirs) == columns
    order = [theirs.index(c) for c in columns]
    assert got == sortable(tuple(row[i] for i in order) for row in result.fetchall())


def test_none_lacks_sql():
    assert set(QUERIES) == set(ORACLES)


WRITES_FIRST = {
    "read_stations", "read_inventory", "dimension_row_counts", "read_observations", "read_landed_years",
    "parquet_by_country", "csv_gz_round_trip", "expanded_bytes", "dense_months",
    "element_counts_from_rollup", "country_year_means_from_rollup", "file_sizes", "read_year_file",
    "landed_changes", "landed_rollup", "relanded_years", "unread_lines", "line_counts", "read_lines_of_broken_files",
    "observation_columns",
}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITES_FIRST))
def test_plans_have_no_python_and_no_nested_loops(spark, plan_of, name):
    plan = plan_of(QUERIES[name](spark, SF))
    assert not re.search(r"Python|ArrowEval|BatchEval|MapInPandas", plan)
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_entry(spark):
    assert driver.entry(spark).count() > 0


def test_without_the_packages_of_the_text_part_the_rest_is_there():
    code = "import sys; sys.modules['xxhash'] = None; import __spark_entry__ as e; print(sorted(e.queries()) == sorted(e.QUERIES))"
    done = subprocess.run([sys.executable, "-W", "ignore", "-c", code], cwd=os.path.dirname(driver.__file__), capture_output=True, text=True, timeout=120)
    assert done.stdout.strip() == "True", done.stderr
