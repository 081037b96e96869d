"""Reconciliation and declared rules on hand-made rows."""

from datetime import date

import pytest
from pyspark.sql import types as T

from tallyproof.operators import contracts, recon

GRAIN = "dwh_business_date int, instance string, row_type string, cluster_type string"
DAY, LATER, TODAY = date(2026, 6, 24), date(2026, 6, 26), date(2026, 7, 1)


def coloured(spark, gru, bi, status, updated=DAY, created=DAY):
    row = (20260624, "I", "R", "NY", gru, bi, status, updated, created, "success" if gru == bi else "fail")
    schema = GRAIN + (", gru_count bigint, bi_count bigint, gru_status string, gru_updated_date date, "
                      "bi_created_date date, bi_status string")
    return spark.createDataFrame([row], schema)


@pytest.mark.parametrize("gru,bi,status,updated,created,colour", [
    (5, 5, "Completed", DAY, DAY, "green"),
    (5, 4, "Completed", DAY, DAY, "red"),
    (5, 5, " FAILED ", DAY, DAY, "red"),
    (5, 4, "snapshot copied", LATER, LATER, "red"),
    (5, 5, "snapshot Copied", LATER, DAY, "purple"),
    (5, 5, "Snapshot Copied", LATER, LATER, "purple"),
    (5, 5, "Snapshot Copied", DAY, LATER, "amber"),
    (5, 5, "Completed", LATER, DAY, "green"),
    (5, 5, "Completed", DAY, LATER, "amber"),
    (5, 5, None, None, None, "green"),
])
def test_colours(spark, gru, bi, status, updated, created, colour):
    got = recon.status_colour(coloured(spark, gru, bi, status, updated, created)).first()
    assert got.colour == colour
    assert got.status == ("success" if gru == bi else "fail")


def test_counts_keep_grains_of_either_side(spark):
    source = spark.createDataFrame([(1, "I", "R", "NY", 5, "Completed"), (1, None, "R", "NY", 2, "Completed"),
                                    (1, "I", "R", "NJ", 1, "Failed")], GRAIN + ", gru_count bigint, gru_status string")
    target = spark.createDataFrame([(1, "I", "R", "NY", 5), (1, None, "R", "NY", 2), (1, "X", "R", None, 3)],
                                   GRAIN + ", bi_count bigint")
    got = {(r.instance, r.cluster_type): (r.gru_count, r.bi_count, r.gru_status, r.bi_status)
           for r in recon.recon_counts(source, target).collect()}
    assert got == {
        ("I", "NY"): (5, 5, "Completed", "success"), (None, "NY"): (2, 2, "Completed", "success"),
        ("I", "NJ"): (1, 0, "Failed", "fail"), ("X", None): (0, 3, None, "fail"),
    }


def test_count_by_grain(spark):
    rows = spark.createDataFrame([(1, "I", "R", "NY")] * 3 + [(1, None, "R", "NY")], GRAIN)
    assert {(r.instance, r.n) for r in recon.count_by_grain(rows, "n").collect()} == {("I", 3), (None, 1)}


@pytest.mark.parametrize("gru,bi,status,updated,state", [
    (5, 5, "Completed", DAY, 0), (5, 3, "Completed", DAY, 1), (5, 0, None, None, 1), (5, 6, "Completed", DAY, 2),
    (5, 5, "Snapshot Copied", LATER, 3), (5, 5, "Snapshot Copied", DAY, 0),
])
def test_count_table(spark, gru, bi, status, updated, state):
    table = recon.count_table(coloured(spark, gru, bi, status, updated), TODAY)
    assert table.columns == recon.COUNT_SCHEMA.names
    assert contracts.schema_contract(table, recon.COUNT_SCHEMA).isEmpty()
    row = table.first()
    assert (row.status, row.update_date, row.dwh_business_date) == (contracts.COUNT_STATES[state], TODAY, DAY)
    assert contracts.domain_violations(table, "status", contracts.COUNT_STATES).isEmpty()


def test_stamp_updates(spark):
    schema = "k int, status string, comments string, update_date date"
    stored = spark.createDataFrame([(1, "a", "c", DAY), (2, "a", None, DAY), (3, "a", "c", DAY), (None, "a", "c", DAY),
                                    (5, "a", "c", DAY)], schema)
    incoming = spark.createDataFrame([(1, "a", "c"), (2, "a", "c"), (3, "b", "c"), (None, "a", "c"), (6, "n", None)],
                                     "k int, status string, comments string")
    got = {r.k: (r.status, r.comments, r.update_date)
           for r in recon.stamp_updates(stored, incoming, ["k"], ["status", "comments"], TODAY).collect()}
    assert got == {1: ("a", "c", DAY), 2: ("a", "c", TODAY), 3: ("b", "c", TODAY), None: ("a", "c", DAY),
                   5: ("a", "c", DAY), 6: ("n", None, TODAY)}


def test_theme_filter(spark):
    df = spark.createDataFrame([("Breaks", 1), ("AM", 2), (None, 3)], "theme string, k int")
    assert [r.k for r in recon.theme_filter(df, "Breaks").collect()] == [1]


def test_cluster_domain(spark):
    df = spark.createDataFrame([("NY",), ("NJ",), ("NY/NJ",), (None,), ("ny",), (None,)], "cluster_type string")
    got = {tuple(r) for r in contracts.domain_violations(df, "cluster_type", contracts.CLUSTERS).collect()}
    assert got == {("NY/NJ", 1), (None, 2), ("ny", 1)}


def test_schema_contract(spark):
    df = spark.createDataFrame([("1", None, 1), ("x", 2, 2), (None, 3, 3)], "a string, b int, c int")
    expected = T.StructType([
        T.StructField("a", T.IntegerType(), False), T.StructField("b", T.IntegerType(), False),
        T.StructField("d", T.DateType(), True),
    ])
    got = {tuple(r) for r in contracts.schema_contract(df, expected).collect()}
    assert got == {("a", "type", None), ("d", "missing", None), ("c", "extra", None), ("a", "null", 1),
                   ("a", "uncastable", 1), ("b", "null", 1)}
    assert contracts.schema_contract(df, df.schema).isEmpty()
    assert contracts.schema_contract(df, expected, check_values=False).count() == 3


@pytest.mark.parametrize("text,fits", [
    ("12", True), (" +7 ", True), ("-3", True), ("\t5\n", True), ("99999999999", False), ("1.5", False), ("", False),
    ("L1", False), ("1 2", False), (" ", False),
])
def test_uncastable_agrees_with_the_cast(spark, text, fits):
    df = spark.createDataFrame([(text,)], "a string")
    assert (df.selectExpr("try_cast(a AS int)").first()[0] is not None) is fits
    got = contracts.schema_contract(df, T.StructType([T.StructField("a", T.IntegerType())]))
    assert ("uncastable" in {r.problem for r in got.collect()}) is not fits
