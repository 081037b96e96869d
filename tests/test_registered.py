"""Every registered query against its SQL in DuckDB, over whole tables (scale 0.01, or $TEST_SF)."""

import math
import os
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry_point
from tallyproof.operators.checks import BREAK_CHECKS
from tallyproof.plans.oracle import ORACLE
from tallyproof.plans.registry import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()

SF = os.environ.get("TEST_SF", "0.01")

# Spark type -> DuckDB type that a result column must have.
TYPES = {
    "int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "date": "DATE", "double": "DOUBLE",
    "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return float(value) if isinstance(value, Decimal) else value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{data(SF)}/{name}.parquet')")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert QUERIES.items() <= entry_point.queries().items() and ORACLE.items() <= entry_point.oracle_sql().items()


def test_every_active_check_shows_both_colours(spark, data):
    rows = QUERIES["dq_result"](spark, data("0.01")).collect()
    for check in BREAK_CHECKS:
        if check.result and check.rule != "constant":
            assert {r[check.result] for r in rows} == {"Green", "Red"}, check.label
    assert any("Completeness" in r.comments for r in rows) and any(r.completeness_count == 0 for r in rows)


def test_planted_cases_occur(spark, data):
    sides = QUERIES["recon_counts"](spark, data("0.01")).collect()
    assert any(r.bi_count == 0 for r in sides) and any(r.gru_count == 0 for r in sides)
    assert any(r.n_load_date > 0 for r in QUERIES["recon_counters"](spark, data("0.01")).collect())
    assert any(r.count_a > 1 and r.count_b > 1 for r in QUERIES["table_copy_compare"](spark, data("0.01")).collect())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(name, spark, data, duck):
    df = QUERIES[name](spark, data(SF))
    got = [tuple(r) for r in df.collect()]
    cursor = duck.execute(ORACLE[name])
    columns = {d[0]: str(d[1]) for d in cursor.description}
    want = cursor.fetchall()
    assert want, "the check compares nothing"
    assert sorted(df.columns) == sorted(columns)
    assert {c: TYPES[t] for c, t in df.dtypes} == columns
    assert _rows(df.columns, got) == _rows(list(columns), want)


def test_entry(spark):
    df = entry_point.entry(spark)
    assert len(df.columns) == 34
    assert df.count() > 0


def test_a_late_run_reads_its_stored_history_as_a_table(spark, data):
    """The first split is computed once: the plan of the second reads orders for the new rows only."""
    found = QUERIES["scd2_late"](spark, data("0.001"))
    assert found._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") <= 2
