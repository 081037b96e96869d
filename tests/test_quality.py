"""Checks, counters and the result row on hand-made rows."""

from datetime import date, datetime

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyproof.functions import is_blank, zero_pad
from tallyproof.operators import counters as counting
from tallyproof.operators.checks import (
    BREAK_CHECKS,
    DUPLICATE_KEYS,
    GRAIN,
    HIERARCHY_COLUMNS,
    Check,
    reading,
    strict_hierarchy,
)
from tallyproof.operators.quality import (
    _as_int,
    RESULT_SCHEMA,
    completeness,
    default_routing,
    dq_result,
    route_on_fly,
)
from tallyproof.plans import supplied

RUN = datetime(2024, 6, 2, 6, 30)
FACT = (
    "item_id bigint, instance string, row_type string, cluster_type string, dwh_business_date int, lvid string, "
    "ownership_id bigint, local_currency string, statement_date date, set_id int, corr_acc_no string, "
    "bran_code bigint, agent_code int"
)
VIEW = (
    "dwh_business_date int, instance string, row_type string, cluster_type string, lvid_region string, "
    "lvid_description string, lvid_country string, rec_type string, rec_type_2 string, currency string, "
    "fx_rate double, item_value_date date, ownership_id bigint, "
    + ", ".join(f"{c} string" for c in HIERARCHY_COLUMNS)
)
STATUS = "dwh_business_date int, cluster_type string, status string"
DAY = date(2024, 6, 1)


def fact_row(**changes):
    row = dict(item_id=1, instance="I", row_type="R", cluster_type="NY", dwh_business_date=20240601, lvid="L",
               ownership_id=5, local_currency="USD", statement_date=DAY, set_id=1, corr_acc_no="A", bran_code=1,
               agent_code=1)
    return row | changes


def view_row(**changes):
    row = dict(dwh_business_date=20240601, instance="I", row_type="R", cluster_type="NY", lvid_region="EU",
               lvid_description="D", lvid_country="FR", rec_type="T", rec_type_2="T2", currency="USD", fx_rate=1.0,
               item_value_date=DAY, ownership_id=5, **{c: "x" for c in HIERARCHY_COLUMNS})
    return row | changes


def frame(spark, rows, schema):
    names = [part.split()[0] for part in schema.split(", ")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], schema)


def result(spark, facts, views, statuses=(), **options):
    return dq_result(
        frame(spark, facts, FACT), frame(spark, views, VIEW), spark.createDataFrame(list(statuses), STATUS),
        RUN, **options,
    )


def on_view(spark, rows, label, checks=BREAK_CHECKS, schema=VIEW):
    chosen = [c for c in checks if c.label == label]
    return counting.counters(frame(spark, rows, schema), chosen).first()[chosen[0].counter]


def test_blank_is_null_or_spaces_only(spark):
    df = spark.createDataFrame([(None, 1), ("", 2), ("  ", 3), ("\t", 4), ("x", 5)], "s string, n int")
    assert [r[0] for r in df.orderBy("n").select(is_blank(df, "s")).collect()] == [True, True, True, False, False]


@pytest.mark.parametrize("kind", ["int", "date", "double", "boolean", "timestamp", "decimal(5,2)"])
def test_blank_of_other_types_is_null(spark, kind):
    df = spark.sql(f"SELECT CAST(NULL AS {kind}) AS c")
    assert df.select(is_blank(df, "c")).first()[0] is True


def test_rate_exemptions(spark):
    rows = [
        view_row(fx_rate=None, currency="USD"),
        view_row(fx_rate=None, currency=" acu "),
        view_row(fx_rate=None, currency="FOZ"),
        view_row(fx_rate=None, currency=None),
        view_row(fx_rate=1.0, currency="USD"),
    ]
    assert on_view(spark, rows, "FX_Rate") == 1


def test_hierarchy_counts_nulls_below_an_owner_only(spark):
    rows = [
        view_row(l8_owner=None), view_row(l1_group=" "), view_row(l3_group=None, ownership_id=None), view_row(),
    ]
    assert on_view(spark, rows, "Ownership_Hierarchy") == 1
    coded = [r | {"ownership_code": c} for r, c in zip(rows, ["c", "c", None, " "])]
    strict = strict_hierarchy("ownership_code")
    assert on_view(spark, coded, "Ownership_Hierarchy", strict, VIEW + ", ownership_code string") == 3


def test_duplicates_count_rows_across_clusters_and_null_items(spark):
    rows = [
        fact_row(item_id=1, cluster_type="NY"), fact_row(item_id=1, cluster_type="NJ"),
        fact_row(item_id=2), fact_row(item_id=None), fact_row(item_id=None),
        fact_row(item_id=1, instance="J"), fact_row(item_id=7, cluster_type=None), fact_row(item_id=8, cluster_type=None),
        fact_row(item_id=8, cluster_type=None),
    ]
    got = counting.duplicate_counts(frame(spark, rows, FACT), DUPLICATE_KEYS)
    found = {(r.instance, r.cluster_type): (r.n_rows, r.n_duplicate) for r in got.collect()}
    assert found == {("I", "NY"): (4, 3), ("I", "NJ"): (1, 1), ("J", "NY"): (1, 0), ("I", None): (3, 2)}


def test_duplicates_when_the_grain_lies_within_the_key(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a"), (1, "b"), (None, None)], "id int, g string")
    got = counting.duplicate_counts(df, ["id", "g"], ["g"])
    assert {tuple(r) for r in got.collect()} == {("a", 3, 2), ("b", 1, 0), (None, 1, 0)}


def test_duplicates_equal_the_window_form_on_skewed_rows(spark, data):
    fact = supplied.fact(spark, data("0.001"))
    # A third of all rows gets one item.
    skewed = fact.withColumn("item_id", F.when(F.col("k") % 3 == 0, F.lit(7)).otherwise(F.col("item_id")))
    over = F.count(F.lit(1)).over(Window.partitionBy(*DUPLICATE_KEYS))
    window = skewed.withColumn("seen", over).groupBy(*GRAIN).agg(
        F.count(F.lit(1)), F.count_if(F.col("seen") > 1)
    )
    got = counting.duplicate_counts(skewed, DUPLICATE_KEYS)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, map(tuple, window.collect())))


def test_clashing_hashes_stop_the_job(spark, monkeypatch):
    monkeypatch.setattr(counting, "_grain_tag", lambda extra: F.lit(0).cast("bigint"))
    rows = [fact_row(), fact_row(cluster_type="NJ", item_id=2)]
    with pytest.raises(Exception, match="share one hash"):
        counting.duplicate_counts(frame(spark, rows, FACT), DUPLICATE_KEYS).collect()


def test_duplicate_check_needs_keys(spark):
    with pytest.raises(ValueError):
        counting.counters(frame(spark, [fact_row()], FACT), reading(BREAK_CHECKS, "fact"))


@pytest.mark.parametrize("column,label", [
    (c.columns[0], c.label) for c in BREAK_CHECKS if c.reads == "fact" and c.rule == "blank" and c.label != "Instance"
])
def test_each_fact_check_alone(spark, column, label):
    row = result(spark, [fact_row(**{column: None})], [view_row()]).first()
    assert row.comments == f"Failed checks: {label}"
    assert row.current_status == "Open"


@pytest.mark.parametrize("column,label", [
    (c.columns[0], c.label) for c in BREAK_CHECKS if c.reads == "view" and c.rule != "hierarchy"
])
def test_each_view_check_alone(spark, column, label):
    row = result(spark, [fact_row()], [view_row(**{column: None})]).first()
    assert row.comments == f"Failed checks: {label}"


def test_clean_row(spark):
    row = result(spark, [fact_row()], [view_row()]).first()
    assert (row.comments, row.current_status, row.completeness_count) == ("All checks passed", "No_Issue", 0)
    assert (row.soe_id_null_check, row.user_hierarchy_null_check, row.action_date_null_check) == ("N/A",) * 3
    assert (row.theme, row.kpi_id, row.run_date, row.run_time) == ("Breaks", "", "2024-06-02", RUN)


def test_result_has_the_table_layout(spark):
    df = result(spark, [fact_row()], [view_row()])
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in RESULT_SCHEMA]
    assert len(RESULT_SCHEMA) == 34


def test_failures_are_listed_in_reporting_order(spark):
    row = result(
        spark, [fact_row(agent_code=None, lvid=" "), fact_row()], [view_row(rec_type="")],
        [(20240601, "NY", "Completed")] * 3,
    ).first()
    assert row.comments == "Failed checks: Completeness, Duplicate, LVID, Rec_Type, Agent_Code"
    assert row.completeness_count == 3


def test_completeness_counts_finished_loads_of_the_cluster(spark):
    statuses = [(20240601, "NY", "Completed"), (20240601, "NY", "completed"), (20240601, "NJ", "Completed"),
                (20240531, "NY", "Completed"), (20240601, None, "Completed")]
    row = result(spark, [fact_row()], [view_row()], statuses).first()
    assert (row.completeness_count, row.current_status) == (1, "No_Issue")
    row = result(spark, [fact_row(cluster_type=None)], [view_row(cluster_type=None)], statuses).first()
    assert row.completeness_count == 1


def test_completeness_colour(spark):
    grains = spark.createDataFrame([(1, "NY", 2), (1, "NJ", 2), (1, "X", 0)],
                                   "dwh_business_date int, cluster_type string, n_rows bigint")
    source = spark.createDataFrame([(1, "NY", 2), (1, "NJ", 3)],
                                   "dwh_business_date int, cluster_type string, source_count bigint")
    got = {r.cluster_type: r.completeness_status for r in completeness(grains, source).collect()}
    assert got == {"NY": "Green", "NJ": "Red", "X": "Green"}


def test_source_count_beyond_int_stops_the_job(spark):
    counts = spark.createDataFrame([(2**31 - 1,), (2**31,)], "source_count bigint")
    fits = counts.where("source_count < 2147483648").select(_as_int(F.col("source_count"))).first()[0]
    assert fits == 2**31 - 1
    with pytest.raises(Exception, match="exceeds the INT"):
        counts.select(_as_int(F.col("source_count"))).collect()


def test_null_grain_keys_match(spark):
    key = dict(instance=None, row_type=None)
    row = result(spark, [fact_row(**key)], [view_row(**key)]).first()
    assert row.comments == "Failed checks: Instance"


def test_missing_view_grain(spark):
    facts, views = [fact_row(), fact_row(instance="J")], [view_row()]
    with pytest.raises(Exception, match="missing from the view"):
        result(spark, facts, views).collect()
    rows = {r.instance: r for r in result(spark, facts, views, on_missing_view="red").collect()}
    assert rows["I"].current_status == "No_Issue"
    assert rows["J"].lvid_region_null_check == "Red"
    assert rows["J"].duplicate_check == "Green"
    with pytest.raises(ValueError):
        result(spark, facts, views, on_missing_view="ignore")


def test_one_business_date_and_none(spark):
    facts = [fact_row(), fact_row(dwh_business_date=20240531, lvid=None)]
    views = [view_row(), view_row(dwh_business_date=20240531)]
    assert [r.current_status for r in result(spark, facts, views, business_date=20240601).collect()] == ["No_Issue"]
    assert result(spark, facts, views).count() == 2
    assert result(spark, facts, views, business_date=20240101).count() == 0


def test_routing(spark):
    wide = result(spark, [fact_row(lvid=None)], [view_row()])
    shown = {r.check_name for r in route_on_fly(wide, default_routing(), "dashboard").collect()}
    counted = {r.check_name: r.check_status for r in route_on_fly(wide, default_routing(), "count_table").collect()}
    assert len(shown) == 9 and shown < set(counted)
    assert counted["lvid_null_check"] == "Red"
    assert not {"soe_id_null_check", "action_date_null_check", "user_hierarchy_null_check"} & set(counted)
    one = route_on_fly(wide, {"lvid_null_check": "Yes", "set_id_null_check": "N/A"}, "dashboard")
    assert [r.check_status for r in one.collect()] == ["Red"]


def test_own_suite_on_another_table(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", "x", 1), ("b", " ", 2)], "g string, v string, k int")
    suite = [Check("Dup", None, "t", "duplicate"), Check("V", None, "t", "blank", ("v",))]
    got = counting.counters(df, suite, ["g"], ["k"])
    assert {tuple(r) for r in got.collect()} == {("a", 2, 2, 1), ("b", 1, 0, 1)}


def test_zero_pad_keeps_long_numbers(spark):
    df = spark.createDataFrame([(7,), (123456,), (None,)], "n bigint")
    assert [r[0] for r in df.select(zero_pad(F.col("n"), 4)).collect()] == ["0007", "123456", None]
