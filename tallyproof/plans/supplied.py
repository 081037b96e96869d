"""The inputs of the registered queries, derived in full from the supplied Parquet tables.

The tables hold no NULL and no blank text, so arithmetic on the part key plants them; rows of
suppliers 10 to 29 of every fifty stay clean. Every function reads whole tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyproof.operators.recon import count_by_grain


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _nth(key: str, n: int) -> Column:
    return F.col(key) % n == 0


def _year_date(year: Column) -> Column:
    return (year * 10000 + 101).cast("int")


def _cluster(key: str) -> Column:
    return F.when(F.col(key) % 2 == 0, F.lit("NY")).otherwise(F.lit("NJ"))


def _in_year(df: DataFrame, column: str, year: int | None) -> DataFrame:
    if year is None:
        return df
    first, after = (F.lit(f"{y}-01-01").cast("timestamp_ntz") for y in (year, year + 1))
    return df.where((F.col(column) >= first) & (F.col(column) < after))


def fact(spark: SparkSession, sf_dir: str, year: int | None = None) -> DataFrame:
    """Ledger fact from lineitem; the business date is the first of January of the ship year.

    ``year`` names one business date as a range of ship dates, which reaches the Parquet reader.
    """
    lines = _in_year(table(spark, sf_dir, "lineitem"), "l_shipdate", year)
    clean = (F.col("l_suppkey") % 50).between(10, 29)
    lines = lines.withColumns({"clean": clean, "k": F.when(clean, F.lit(1)).otherwise(F.col("l_partkey"))})
    flag, line_status = F.col("l_returnflag"), F.col("l_linestatus")
    order_line = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    clean_item = (F.col("l_orderkey") * 1000000 + F.col("l_partkey")) * 10 + F.col("l_linenumber")
    return lines.select(
        F.when(F.col("clean"), clean_item).when(~_nth("k", 211), order_line).alias("item_id"),
        F.when(F.col("clean"), F.lit("INST_C"))
        .when(F.col("l_suppkey") % 50 == 7, F.lit(None))
        .when(F.col("l_suppkey") % 50 == 8, F.lit("  "))
        .otherwise(F.concat(F.lit("INST_"), flag)).alias("instance"),
        line_status.alias("row_type"),
        _cluster("l_suppkey").alias("cluster_type"),
        _year_date(F.year("l_shipdate")).alias("dwh_business_date"),
        F.when((flag == "A") & _nth("k", 97), F.lit(None))
        .when((flag == "A") & _nth("k", 89), F.lit(" "))
        .otherwise(F.concat(F.lit("L"), F.col("l_partkey").cast("string"))).alias("lvid"),
        F.when(~((line_status == "F") & _nth("k", 101)), F.col("l_suppkey")).alias("ownership_id"),
        F.when((flag == "N") & _nth("k", 83), F.lit("")).otherwise(F.lit("USD")).alias("local_currency"),
        F.when(~((flag == "R") & _nth("k", 79)), F.to_date("l_shipdate")).alias("statement_date"),
        F.when(~((flag == "A") & _nth("k", 107)), F.col("l_linenumber")).alias("set_id"),
        F.when((flag == "N") & _nth("k", 103), F.lit(" ")).when(~((flag == "R") & _nth("k", 103)), F.col("l_partkey").cast("string")).alias("corr_acc_no"),
        F.when(~((line_status == "O") & _nth("k", 109)), F.col("l_suppkey")).alias("bran_code"),
        F.when(~((F.col("l_suppkey") % 2 == 0) & _nth("k", 73)), F.col("l_linenumber")).alias("agent_code"),
        "k", "l_partkey", "l_suppkey", "l_tax", "l_shipdate",
    )


def fact_view(spark: SparkSession, sf_dir: str, year: int | None = None, base: DataFrame | None = None) -> DataFrame:
    """The fact with region, country, record types, exchange rate and the owner hierarchy.

    ``base`` is the fact where the caller has it already, which saves building it again.
    """
    base = fact(spark, sf_dir, year) if base is None else base
    # One table after the other: each is then judged by its own file size, and broadcast if small.
    # Left joins: a row without its part or supplier must reach the checks that are to find it.
    part = F.when(~(_nth("k", 113) & (F.col("row_type") == "F")), F.col("l_partkey"))
    supplier = F.when(~(_nth("k", 139) & (F.col("row_type") == "O")), F.col("l_suppkey"))
    joined = (
        base.join(table(spark, sf_dir, "part"), part == F.col("p_partkey"), "left")
        .join(table(spark, sf_dir, "supplier"), supplier == F.col("s_suppkey"), "left")
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"), "left")
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    )
    last_digit = F.col("k") % 10
    open_rows = F.col("row_type") == "O"
    # As text, because each step of a column expression is a round trip to the JVM.
    levels = [
        f"IF(k % {start + i} = 0 AND row_type = 'O', NULL, '{kind[0]}{i}') AS l{i}_{kind}"
        for i in range(1, 9)
        for start, kind in ((600, "group"), (700, "owner"))
    ]
    return joined.select(
        *base.columns,
        F.when(~((F.col("r_name") == "ASIA") & _nth("k", 61)), F.col("r_name")).alias("lvid_region"),
        F.col("p_name").alias("lvid_description"),
        F.when(_nth("k", 67) & (F.col("cluster_type") == "NJ"), F.lit(" "))
        .otherwise(F.col("n_name")).alias("lvid_country"),
        F.when(_nth("k", 127) & (F.col("cluster_type") == "NY"), F.lit("  ")).otherwise(F.col("p_type")).alias("rec_type"),
        F.when(~(_nth("k", 71) & (F.col("row_type") == "F")), F.col("p_brand")).alias("rec_type_2"),
        F.when(last_digit == 0, F.lit(None)).when(last_digit == 1, F.lit(" acu "))
        .when(last_digit == 2, F.lit("GOZ")).otherwise(F.lit("USD")).alias("currency"),
        F.when(~((last_digit < 3) | ((F.col("k") % 53 == 3) & (F.col("cluster_type") == "NY"))),
               1.0 + F.col("l_tax")).alias("fx_rate"),
        F.when(~(_nth("k", 131) & open_rows), F.to_date("l_shipdate")).alias("item_value_date"),
        F.when(_nth("k", 599) & open_rows, F.lit(" "))
        .otherwise(F.concat(F.lit("s"), F.col("l_suppkey").cast("string"))).alias("ownership_code"),
        *[F.expr(level) for level in levels],
    )


def source_status(spark: SparkSession, sf_dir: str, year: int | None = None) -> DataFrame:
    """Source load status from orders; one cluster has no loads at all in 1996."""
    state = F.col("o_orderstatus")
    orders = _in_year(table(spark, sf_dir, "orders"), "o_orderdate", year)
    return orders.where((F.year("o_orderdate") != 1996) | (F.col("o_custkey") % 2 == 0)).select(
        _year_date(F.year("o_orderdate")).alias("dwh_business_date"),
        _cluster("o_custkey").alias("cluster_type"),
        F.when(state == "F", F.lit("Completed")).when(state == "O", F.lit("Running"))
        .otherwise(F.lit("Failed")).alias("status"),
    )


def cob_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Close-of-business flags: a row per day and kind of event, 35 kinds; some rows are there twice."""
    kind = F.concat("event_type", F.lit("_"), (F.col("user_id") % 7).cast("string"))
    n = F.col("n")
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.to_date("ts").alias("cob_date"), kind.alias("row_type"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            "cob_date",
            F.col("cob_date").alias("dwh_business_date"),
            "row_type",
            F.when(n % 3 == 0, F.lit("fail")).otherwise(F.lit("pass")).alias("flag"),
            F.when(n % 5 == 0, F.lit(None))
            .when((n % 3 == 0) | (n % 7 == 1), F.lit("Y"))
            .otherwise(F.lit("N")).alias("status"),
            F.explode(F.sequence(F.lit(1), F.when(n % 2 == 0, F.lit(2)).otherwise(F.lit(1)))).alias("copy"),
        )
        .drop("copy")
    )


def gru_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source side of the reconciliation, one row per grain."""
    n = F.col("gru_count")
    first = F.to_date(F.col("dwh_business_date").cast("string"), "yyyyMMdd")
    rows = _recon_rows(spark, sf_dir, F.concat(F.lit("INST_"), F.col("l_returnflag")))
    return (
        count_by_grain(rows, "gru_count")
        .withColumn(
            "gru_status",
            F.when(n % 5 == 0, F.lit("Failed")).when((n % 5).isin(1, 2), F.lit("Snapshot Copied"))
            .otherwise(F.lit("Completed")),
        )
        .withColumn("gru_updated_date", F.date_add(first, F.when(n % 3 == 0, F.lit(1)).otherwise(F.lit(0))))
        .withColumn("gru_created_date", F.date_add(first, (n % 2).cast("int")))
    )


def bi_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Warehouse side: returned lines of one supplier in fifty were booked under another instance, and one grain a year is not there."""
    astray = (F.col("l_suppkey") % 50 == 44) & (F.col("l_returnflag") == "A")
    instance = F.when(astray, F.lit("INST_X")).otherwise(F.concat(F.lit("INST_"), F.col("l_returnflag")))
    n = F.col("bi_count")
    first = F.to_date(F.col("dwh_business_date").cast("string"), "yyyyMMdd")
    rows = _recon_rows(spark, sf_dir, instance)
    lost = (F.col("dwh_business_date") % 20000 == 10101) & (F.col("instance") == "INST_R") & (F.col("cluster_type") == "NJ")
    return count_by_grain(rows.where(~lost), "bi_count").withColumn(
        "bi_created_date", F.date_add(first, F.when(n % 4 == 0, F.lit(2)).otherwise(F.lit(0)))
    )


def _recon_rows(spark: SparkSession, sf_dir: str, instance: Column) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        _year_date(F.year("l_shipdate")).alias("dwh_business_date"),
        instance.alias("instance"),
        F.col("l_linestatus").alias("row_type"),
        _cluster("l_suppkey").alias("cluster_type"),
    )


def lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lookup rows from events, in three environments; some lack their row type."""
    env = F.col("user_id") % 3
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.when(env == 0, F.lit("NY")).when(env == 1, F.lit("NJ")).otherwise(F.lit("IN")).alias("environment"),
        F.date_format("ts", "yyyyMMdd").cast("int").alias("dwh_business_date"),
        F.when(~_nth("event_id", 41), F.col("event_type")).alias("row_type"),
        F.col("ts").alias("created_ts"),
    )


def event_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact that belongs to the lookup: an amount for every row, and a correction for some of the rows."""
    amounts = lookup(spark, sf_dir).join(table(spark, sf_dir, "events").select("event_id", "value"), "event_id")
    copies = F.sequence(F.lit(0), F.when(_nth("event_id", 5), F.lit(1)).otherwise(F.lit(0)))
    return amounts.withColumn("correction", F.explode(copies)).withColumnRenamed("value", "amount")


def loaded(rows: DataFrame) -> DataFrame:
    """Of lookup or fact rows, those loaded so far: two environments have got to different hours, the third is new."""
    until = F.when(F.col("environment") == "NY", F.lit("2024-01-20 10:30:00")).when(F.col("environment") == "NJ", F.lit("2024-01-22 17:45:10"))
    return rows.where(F.col("created_ts") < until.cast("timestamp_ntz"))


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stamped rows to be numbered; one in 500 lacks its date."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.when(~_nth("event_id", 500), F.to_date("ts")).alias("run_date"),
        F.col("ts").alias("run_ts"),
        F.date_format("ts", "HH:mm:ss").alias("run_time"),
        F.col("event_type").alias("check_name"),
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run history from orders."""
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus",
        F.to_date("o_orderdate").alias("run_date"),
        F.year("o_orderdate").alias("period"),
        F.col("o_orderdate").alias("run_time"),
    )


def effective_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Effective-dated rows from orders: finished ones are closed after 30 days, others are open."""
    start = F.to_date("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus",
        start.alias("effective_from"),
        F.when(F.col("o_orderstatus") == "F", F.date_add(start, 30)).alias("effective_to"),
        F.col("o_orderdate").alias("run_time"),
    )
