"""The study's four input tables derived from the generic test tables.

Two cohorts, both computed by Spark from whole driver tables (every row of
``orders``, ``customer``, ``lineitem`` and ``events`` is read; the derived tables
grow with them). The same rules are written as DuckDB SQL in
``ceasekit.oracle_sql`` so results can be compared engine against engine.

Cohort A (long history): cease requests, monthly snapshots, calls and usage from
orders, customers and line items. Cohort B (one dense month): an observation set
over all customers and daily usage from events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ceasekit.config import CRM_KEEP, CRM_ULTRA, ChurnConfig

CFG = ChurnConfig()
ID = CFG.id_col

# Fixed values of the derived attributes (category lists are picked by key modulo).
TECHNOLOGIES = ("MPF", "FTTC", "FTTP", "SOGEA")
SALES_CHANNELS = ("Other", "Online - Search", "Online - Ambient", "Field", "Online - Other",
                  "Outbound", "Inbound", "Retail", None)
CRM_NAMES = (*CRM_KEEP, *CRM_ULTRA, "Broadband Basic", None)
SPEEDS = (18, 35, 40, 65, 150, 1000)
FIXTURE_EXCLUDED_REASONS = ("1-URGENT", "2-HIGH")
CEASE_PRICE = 435_000          # a finished order from this price on counts as a cease request
FIXTURE_CONFIG = CFG.with_(excluded_reasons=FIXTURE_EXCLUDED_REASONS)

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def pick(index: Column, values) -> Column:
    """CASE index WHEN 0 THEN values[0] ... (null entries give null)."""
    expr = None
    for i, v in enumerate(values):
        lit = F.lit(v)
        expr = F.when(index == i, lit) if expr is None else expr.when(index == i, lit)
    return expr


def cease(spark: SparkSession, sf_dir: str, least_price: float = CEASE_PRICE) -> DataFrame:
    """Cease requests: finished orders of a total price of ``least_price`` or more (0: all finished orders)."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    placed = F.to_date("o_orderdate")
    return o.where((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") >= least_price)).select(
        F.col("o_custkey").cast("string").alias(ID),
        placed.alias("cease_placed_date"),
        F.when(k % 3 == 0, F.lit(None).cast("date")).otherwise(F.date_add(placed, 30)).alias("cease_completed_date"),
        F.when(k % 5 == 0, F.lit(None).cast("string")).otherwise(F.col("o_orderpriority"))
        .alias("reason_description_insight"),
    )


def customer_info(spark: SparkSession, sf_dir: str, tasks: int | None = None) -> DataFrame:
    """One snapshot per customer and month from the first order month to the first
    cease month, else to the last order month of the whole table. With ``tasks`` the customers are
    dealt over that many partitions by their id before they become snapshots, so that no snapshot is shuffled."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    last_month = o.select(F.trunc(F.max("o_orderdate"), "month")).scalar()
    first = o.groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_ts"))
    first_cease = cease(spark, sf_dir).groupBy(ID).agg(
        F.trunc(F.min("cease_placed_date"), "month").alias("m1c"))
    base = (c.join(first, c.c_custkey == first.o_custkey)
            .withColumn(ID, F.col("c_custkey").cast("string"))
            .join(first_cease, ID, "left")
            .withColumn("m0", F.trunc("first_ts", "month"))
            .withColumn("m1", F.coalesce("m1c", last_month)))
    if tasks:
        base = base.repartition(tasks, ID)
    base = (base
            .withColumn("datevalue", F.explode(F.sequence("m0", "m1", F.expr("interval 1 month")))))
    key = F.col("c_custkey")
    months = (F.year("datevalue") - F.year("m0")) * 12 + F.month("datevalue") - F.month("m0")
    return base.select(
        ID,
        F.col("datevalue").cast("date").alias("datevalue"),
        F.col("c_mktsegment").alias("contract_status"),
        (key % 4).cast("int").alias("contract_dd_cancels"),
        (key % 2).cast("int").alias("dd_cancel_60_day"),
        F.when(key % 13 == 0, F.lit(None).cast("double"))
        .otherwise((months * 30 - 170 + key % 7).cast("double")).alias("ooc_days"),
        pick(F.col("c_nationkey") % 4, TECHNOLOGIES).alias("technology"),
        pick(key % 6, SPEEDS).cast("int").alias("speed"),
        F.when(key % 11 == 0, F.lit(None).cast("double")).otherwise(F.col("c_acctbal") / 90).alias("line_speed"),
        pick(F.col("c_nationkey") % 9, SALES_CHANNELS).alias("sales_channel"),
        pick(key % 10, CRM_NAMES).alias("crm_package_name"),
        F.datediff("datevalue", F.to_date("first_ts")).cast("int").alias("tenure_days"),
    )


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.where(F.col("o_orderstatus") == "O").select(
        F.col("o_custkey").cast("string").alias(ID), F.to_date("o_orderdate").alias("event_date"))


def usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cohort A usage: one row per line item, dated by its ship date."""
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("o_custkey").cast("string").alias(ID),
        F.to_date("l_shipdate").alias("calendar_date"),
        F.col("l_extendedprice").alias("usage_download_mbs"),
        F.col("l_quantity").alias("usage_upload_mbs"),
    )


def observation_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cohort B: every customer, observed in January (even key) or February (odd
    key) 2024; churned when the customer has a cease request in cohort A."""
    c = table(spark, sf_dir, "customer")
    churners = cease(spark, sf_dir).select(ID).distinct().withColumn("churned", F.lit(1))
    return (c.select(F.col("c_custkey").cast("string").alias(ID),
                     F.when(F.col("c_custkey") % 2 == 1, F.lit("2024-02-01"))
                     .otherwise(F.lit("2024-01-01")).cast("date").alias("behav_win"))
            .join(churners, ID, "left")
            .select(ID, "behav_win", F.coalesce("churned", F.lit(0)).cast("int").alias("churned")))


def usage_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cohort B usage from all events; odd users shifted by 31 days."""
    e = table(spark, sf_dir, "events")
    u = F.col("user_id")
    return e.select(
        u.cast("string").alias(ID),
        F.date_add(F.to_date("ts"), F.when(u % 2 == 1, 31).otherwise(0)).alias("calendar_date"),
        F.col("value").alias("usage_download_mbs"),
        F.get_json_object("props", "$.k").cast("double").alias("usage_upload_mbs"),
    )
