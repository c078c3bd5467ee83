"""Registered queries: one small query per base operator (E, J, A, W, O, U).

Operators that a composite query already exercises are registered again under
their own id as an alias of that query (same Spark function, same oracle).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ceasekit.catalog import QUERIES, SQL, query
from ceasekit.catalog.study import study
from ceasekit.functions import dates as D
from ceasekit.functions.categories import clean_name_sql
from ceasekit.functions.buckets import line_speed_bucket
from ceasekit.operators.prefix import prefix_scan
from ceasekit.operators.relational import existence_flag, keep_first, key_set_overlap, same_month_join, union_aligned
from ceasekit.operators.stats import crosstab_with_margins, sorted_string_agg, summary_stats
from ceasekit.plans import quality as Q

ID = "unique_customer_identifier"
ATTRS = ("contract_status, contract_dd_cancels, dd_cancel_60_day, ooc_days, technology, speed, line_speed, "
         "sales_channel, crm_package_name, tenure_days")


@query("e1_select_reorder", f"SELECT datevalue AS snapshot_month, {ID}, {ATTRS} FROM customer_info")
def e1(spark, d):
    i = study(spark, d).info
    return i.select(F.col("datevalue").alias("snapshot_month"), ID, *[c for c in i.columns if c not in (ID, "datevalue")])


@query("e2_derived_literal", f"SELECT {ID}, datevalue, 0 AS churned, tenure_days / 30 AS tenure_months FROM customer_info")
def e2(spark, d):
    i = study(spark, d).info
    return i.select(ID, "datevalue", F.lit(0).alias("churned"), (F.col("tenure_days") / 30).alias("tenure_months"))


@query("e3_drop_columns", "SELECT * EXCLUDE (ooc_days, line_speed) FROM customer_info")
def e3(spark, d):
    return study(spark, d).info.drop("ooc_days", "line_speed")


@query("e4_comparison_logic", """
SELECT * FROM customer_info WHERE (speed >= 65 AND contract_status <> 'BUILDING') OR NOT (tenure_days < 1000)""")
def e4(spark, d):
    c = F.col
    return study(spark, d).info.where(((c("speed") >= 65) & (c("contract_status") != "BUILDING")) | ~(c("tenure_days") < 1000))


@query("e5_not_in_with_null", "SELECT * FROM cease WHERE reason_description_insight NOT IN ('1-URGENT', '2-HIGH')")
def e5(spark, d):
    return study(spark, d).cease.where(~F.col("reason_description_insight").isin("1-URGENT", "2-HIGH"))


@query("e6_between", "SELECT * FROM customer_info WHERE ooc_days BETWEEN -100 AND 50")
def e6(spark, d):
    return study(spark, d).info.where(F.col("ooc_days").between(-100, 50))


@query("e7_null_nan_tests", """
SELECT count_if(ooc_days IS NULL) AS ooc_null, count_if(isnan(ooc_days)) AS ooc_nan,
       count_if(line_speed IS NOT NULL) AS line_speed_present FROM customer_info""")
def e7(spark, d):
    c = F.col
    return study(spark, d).info.agg(F.count_if(c("ooc_days").isNull()).alias("ooc_null"),
                                    F.count_if(F.isnan("ooc_days")).alias("ooc_nan"),
                                    F.count_if(c("line_speed").isNotNull()).alias("line_speed_present"))


@query("e8_searched_case", f"""
SELECT {ID}, datevalue, CASE WHEN line_speed IS NULL THEN 'Missing' WHEN line_speed < 0 THEN 'Below 0' """
       + " ".join(f"WHEN line_speed >= {lo} AND line_speed < {lo + 10} THEN '{lo}-{lo + 9}'" for lo in range(0, 100, 10))
       + " WHEN line_speed >= 100 AND line_speed < 109 THEN '100-108' ELSE 'Over 108' END AS line_speed_bucket FROM customer_info")
def e8(spark, d):
    return study(spark, d).info.select(ID, "datevalue", line_speed_bucket("line_speed").alias("line_speed_bucket"))


@query("e9_fill_null", f"SELECT {ID}, datevalue, COALESCE(line_speed, 0.0) AS line_speed, COALESCE(ooc_days, 0.0) AS ooc_days FROM customer_info")
def e9(spark, d):
    return study(spark, d).info.select(ID, "datevalue", "line_speed", "ooc_days").fillna(0.0, subset=["line_speed", "ooc_days"])


@query("e10_arithmetic", """
SELECT contract_status, count(*) - count(line_speed) AS missing_line_speed,
       CAST(count(line_speed) AS DOUBLE) * 100.0 / count(*) AS pct_present FROM customer_info GROUP BY 1""")
def e10(spark, d):
    return study(spark, d).info.groupBy("contract_status").agg(
        (F.count(F.lit(1)) - F.count("line_speed")).alias("missing_line_speed"),
        F.try_divide(F.count("line_speed") * F.lit(100.0), F.count(F.lit(1))).alias("pct_present"))


@query("e11_round", """
SELECT contract_status, round(avg(churned) * 100, 1) AS churn_pct, round(avg(line_speed), 3) AS avg_line_speed
FROM raw_info GROUP BY 1""")
def e11(spark, d):
    return study(spark, d).raw_info.groupBy("contract_status").agg(
        F.round(F.avg("churned") * 100, 1).alias("churn_pct"), F.round(F.avg("line_speed"), 3).alias("avg_line_speed"))


@query("e12_e13_month_start_shift", """
SELECT unique_customer_identifier, cease_placed_date, CAST(date_trunc('month', cease_placed_date) AS DATE) AS cease_month,
       CAST(date_trunc('month', cease_placed_date) - INTERVAL 1 MONTH AS DATE) AS prev_month,
       CAST(cease_placed_date - INTERVAL 1 MONTH AS DATE) AS placed_minus_1m FROM cease""")
def e12(spark, d):
    c = study(spark, d).cease
    return c.select(ID, "cease_placed_date", D.month_start("cease_placed_date").alias("cease_month"),
                    D.month_shift(D.month_start("cease_placed_date"), -1).alias("prev_month"),
                    D.month_shift("cease_placed_date", -1).alias("placed_minus_1m"))


@query("e14_e15_date_parts", """
SELECT unique_customer_identifier, calendar_date, year(calendar_date) AS y, month(calendar_date) AS m,
       day(calendar_date) AS dom, week(calendar_date) AS iso_week, day(last_day(calendar_date)) AS days_in_month
FROM usage""")
def e14(spark, d):
    u = study(spark, d).usage
    c = "calendar_date"
    return u.select(ID, c, F.year(c).cast("bigint").alias("y"), F.month(c).cast("bigint").alias("m"),
                    F.dayofmonth(c).cast("bigint").alias("dom"), F.weekofyear(c).cast("bigint").alias("iso_week"),
                    D.days_in_month(c).cast("bigint").alias("days_in_month"))


@query("e16_day_difference", """
SELECT unique_customer_identifier, cease_placed_date, CAST(date_diff('day', cease_placed_date, cease_completed_date) AS DOUBLE) AS days_to_complete
FROM cease""")
def e16(spark, d):
    c = study(spark, d).cease
    return c.select(ID, "cease_placed_date", D.day_diff("cease_completed_date", "cease_placed_date").cast("double").alias("days_to_complete"))


@query("e17_iso_week_label", """
SELECT cease_placed_date, CAST(isoyear(cease_placed_date) AS VARCHAR) || '-W' || lpad(CAST(week(cease_placed_date) AS VARCHAR), 2, '0') AS year_week
FROM cease""")
def e17(spark, d):
    return study(spark, d).cease.select("cease_placed_date", D.iso_year_week("cease_placed_date").alias("year_week"))


@query("e18_string_to_date", """
SELECT o_orderkey, TRY_CAST(strftime(o_orderdate, '%Y-%m-%d') AS DATE) AS parsed,
       TRY_CAST(o_orderpriority AS DATE) AS not_a_date FROM orders""")
def e18(spark, d):
    o = study(spark, d).table("orders")
    return o.select("o_orderkey", D.to_date_safe(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("parsed"),
                    D.to_date_safe("o_orderpriority").alias("not_a_date"))


@query("e19_category_column_name", """
SELECT DISTINCT crm_package_name,
       'crm_package_' || lower(replace(replace(replace(replace(crm_package_name, ' ', '_'), '(', ''), ')', ''), '-', '_')) AS column_name
FROM customer_info WHERE crm_package_name IS NOT NULL""")
def e19(spark, d):
    i = study(spark, d).info.where(F.col("crm_package_name").isNotNull())
    return i.select("crm_package_name", clean_name_sql("crm_package_", "crm_package_name", "crm").alias("column_name")).distinct()


@query("j1_inner_join", f"SELECT c.{ID}, c.event_date, r.churned FROM calls c JOIN raw_info r ON c.{ID} = r.{ID}")
def j1(spark, d):
    s = study(spark, d)
    return s.calls.join(s.raw_info.select(ID, "churned"), ID)


@query("j1_inner_join_bucketed", f"""
SELECT u.{ID}, u.calendar_date, count(*) AS usage_rows, c.cease_placed_date FROM usage u JOIN (
  SELECT {ID}, min(cease_placed_date) AS cease_placed_date FROM cease GROUP BY 1) c ON u.{ID} = c.{ID} GROUP BY ALL""")
def j1_bucketed(spark, d):
    """Daily usage with the customer's first cease request, joined on the usage's buckets."""
    s = study(spark, d)
    first = s.cease.groupBy(ID).agg(F.min("cease_placed_date").alias("cease_placed_date"))
    return s.usage_daily.select(ID, "calendar_date", "usage_rows").join(first, ID)


@query("j3_left_join", f"""
SELECT r.{ID}, r.churned, CAST(u.usage_days AS DOUBLE) AS usage_days FROM raw_info r LEFT JOIN usage_days_a u ON r.{ID} = u.{ID}""")
def j3(spark, d):
    from ceasekit.plans.features import usage_days
    s = study(spark, d)
    return s.raw_info.select(ID, "churned").join(usage_days(s.usage_behav_month, s.cfg), ID, "left") \
        .withColumn("usage_days", F.col("usage_days").cast("double"))


@query("j4_left_anti", f"SELECT DISTINCT {ID} FROM customer_info WHERE {ID} NOT IN (SELECT {ID} FROM calls)")
def j4(spark, d):
    s = study(spark, d)
    return s.info.select(ID).distinct().join(s.calls.select(ID), ID, "left_anti")


@query("j5_existence_flag", f"""
SELECT r.{ID}, r.churned, CASE WHEN EXISTS (SELECT 1 FROM calls c WHERE c.{ID} = r.{ID}) THEN 1 ELSE 0 END AS has_calls
FROM raw_info r""")
def j5(spark, d):
    s = study(spark, d)
    return existence_flag(s.raw_info.select(ID, "churned"), s.calls, [ID], "has_calls")


@query("j6_same_month_join", f"""
SELECT c.{ID}, c.event_date, r.behav_win FROM calls c JOIN raw_info r
  ON c.{ID} = r.{ID} AND CAST(date_trunc('month', c.event_date) AS DATE) = r.behav_win""")
def j6(spark, d):
    s = study(spark, d)
    return same_month_join(s.calls, s.raw_info.select(ID, "behav_win"), ID, "event_date", "behav_win")


@query("j7_event_after_date", f"""
SELECT c.{ID}, c.cease_placed_date, count(*) AS usage_rows_after
FROM usage u JOIN (SELECT DISTINCT {ID}, cease_placed_date FROM cease) c
  ON u.{ID} = c.{ID} AND u.calendar_date > c.cease_placed_date GROUP BY 1, 2""")
def j7(spark, d):
    s = study(spark, d)
    r = Q.usage_rows_after(s.usage, s.cease, ID, "calendar_date", "cease_placed_date")
    return r.where(F.col("after") > 0).select(ID, "cease_placed_date", F.col("after").alias("usage_rows_after"))


@query("a1_global_count", "SELECT count(*) AS n FROM usage")
def a1(spark, d):
    return study(spark, d).usage.agg(F.count(F.lit(1)).alias("n"))


@query("a2_grouped_count", "SELECT technology, count(*) AS n, count(line_speed) AS n_line_speed FROM customer_info GROUP BY 1")
def a2(spark, d):
    return study(spark, d).info.groupBy("technology").agg(F.count(F.lit(1)).alias("n"), F.count("line_speed").alias("n_line_speed"))


@query("a3_min_max_avg_sum", f"""
SELECT {ID}, min(calendar_date) AS first_day, max(calendar_date) AS last_day, avg(usage_download_mbs) AS avg_download,
       sum(usage_upload_mbs) AS total_upload FROM usage GROUP BY 1""")
def a3(spark, d):
    return study(spark, d).usage.groupBy(ID).agg(
        F.min("calendar_date").alias("first_day"), F.max("calendar_date").alias("last_day"),
        F.avg("usage_download_mbs").alias("avg_download"), F.sum("usage_upload_mbs").alias("total_upload"))


@query("a4_count_distinct", f"""
SELECT count(DISTINCT {ID}) AS customers, count(DISTINCT ({ID}, calendar_date)) AS customer_days,
       count(DISTINCT reason) AS reasons
FROM (SELECT u.{ID}, u.calendar_date, NULL::VARCHAR AS reason FROM usage u)""".replace(
    f"count(DISTINCT ({ID}, calendar_date))", f"count(DISTINCT CASE WHEN {ID} IS NOT NULL AND calendar_date IS NOT NULL THEN {ID} || '|' || CAST(calendar_date AS VARCHAR) END)"))
def a4(spark, d):
    u = study(spark, d).usage
    return u.agg(F.count_distinct(ID).alias("customers"), F.count_distinct(ID, "calendar_date").alias("customer_days"),
                 F.count_distinct(F.lit(None).cast("string")).alias("reasons"))


@query("a5_conditional_count", """
SELECT count_if(cease_completed_date IS NULL) AS open_ceases,
       count(CASE WHEN reason_description_insight = '5-LOW' THEN 1 END) AS low_priority FROM cease""")
def a5(spark, d):
    c = study(spark, d).cease
    return c.agg(F.count_if(F.col("cease_completed_date").isNull()).alias("open_ceases"),
                 F.count(F.when(F.col("reason_description_insight") == "5-LOW", 1)).alias("low_priority"))


@query("a14_distinct_rows", f"SELECT DISTINCT {ID}, cease_placed_date, reason_description_insight FROM cease")
def a14(spark, d):
    return study(spark, d).cease.select(ID, "cease_placed_date", "reason_description_insight").distinct()


@query("w4_running_total", """
SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity, sum(l_quantity) OVER w AS quantity_so_far, CAST(count(*) OVER w AS BIGINT) AS lines_so_far,
       max(l_quantity) OVER w AS most_so_far
FROM lineitem WINDOW w AS (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def w4(spark, d):
    """Running totals over all line items by date and key: a prefix scan, no task with all rows."""
    lines = study(spark, d).table("lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity")
    return prefix_scan(lines, ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], {
        "quantity_so_far": ("sum", F.col("l_quantity")), "lines_so_far": ("sum", F.lit(1).cast("long")), "most_so_far": ("max", F.col("l_quantity"))})


@query("o1_sort", "SELECT contract_status, technology, count(*) AS n FROM customer_info GROUP BY 1, 2")
def o1(spark, d):
    return study(spark, d).info.groupBy("contract_status", "technology").agg(F.count(F.lit(1)).alias("n")) \
        .orderBy(F.col("n").desc(), "contract_status", F.col("technology").asc_nulls_last())


@query("o3_top_k", f"SELECT {ID}, tenure_days FROM raw_info ORDER BY tenure_days DESC, {ID} LIMIT 20")
def o3(spark, d):
    return study(spark, d).raw_info.select(ID, "tenure_days").orderBy(F.col("tenure_days").desc(), ID).limit(20)


@query("a6_two_level_aggregation", """
SELECT l_suppkey, count(*) AS orders, sum(lines) AS lines, max(quantity) AS most_quantity
FROM (SELECT l_suppkey, l_orderkey, count(*) AS lines, sum(l_quantity) AS quantity FROM lineitem GROUP BY 1, 2) GROUP BY 1""")
def a6(spark, d):
    """Lines per supplier and order, then orders per supplier."""
    per = study(spark, d).table("lineitem").groupBy("l_suppkey", "l_orderkey").agg(F.count(F.lit(1)).alias("lines"), F.sum("l_quantity").alias("quantity"))
    return per.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("orders"), F.sum("lines").cast("double").alias("lines"), F.max("quantity").alias("most_quantity"))


@query("a8_order_price_statistics", """
SELECT count(x) AS n, avg(x) AS mean, stddev_samp(x) AS stddev, min(x) AS min, quantile_cont(x, 0.25) AS p25,
       quantile_cont(x, 0.5) AS p50, quantile_cont(x, 0.75) AS p75, max(x) AS max FROM (SELECT CAST(o_totalprice AS DOUBLE) AS x FROM orders)""")
def a8(spark, d):
    return summary_stats(study(spark, d).table("orders"), "o_totalprice")


@query("a11_line_status_crosstab", """
SELECT coalesce(l_returnflag, 'All') AS l_returnflag, count_if(l_linestatus = 'F') AS "l_linestatus_F", count_if(l_linestatus = 'O') AS "l_linestatus_O",
       count(*) AS "l_linestatus_All" FROM lineitem GROUP BY ROLLUP (l_returnflag)""")
def a11(spark, d):
    out = crosstab_with_margins(study(spark, d).table("lineitem"), "l_returnflag", "l_linestatus", ["F", "O"])
    return out.select("l_returnflag", *[F.col(c).cast("double").alias(c) if c != "l_linestatus_All" else F.col(c) for c in out.columns[1:]])


@query("a12_segments_per_nation", """
SELECT c_nationkey, string_agg(DISTINCT c_mktsegment, ', ' ORDER BY c_mktsegment) AS segments FROM customer GROUP BY 1""")
def a12(spark, d):
    return study(spark, d).table("customer").groupBy("c_nationkey").agg(sorted_string_agg("c_mktsegment").alias("segments"))


@query("j2_join_on_id_and_month", f"""
SELECT i.{ID}, i.datevalue, count(*) AS calls FROM customer_info i JOIN calls c
  ON i.{ID} = c.{ID} AND i.datevalue = CAST(date_trunc('month', c.event_date) AS DATE) GROUP BY 1, 2""")
def j2(spark, d):
    """Calls in the month of each snapshot: both keys in one equi-join, calls counted per customer and month first."""
    s = study(spark, d)
    per = s.calls.groupBy(ID, F.trunc("event_date", "month").alias("datevalue")).agg(F.count(F.lit(1)).alias("calls"))
    return s.info.select(ID, "datevalue").join(per, [ID, "datevalue"])


@query("o2_order_priority_places", """
SELECT o_orderpriority, list_position(['3-MEDIUM', '1-URGENT', '5-LOW', '2-HIGH', '4-NOT SPECIFIED'], o_orderpriority) AS place, count(*) AS n
FROM orders GROUP BY 1""")
def o2(spark, d):
    """Priorities in a given order that is not that of their names."""
    wanted = F.array(*[F.lit(x) for x in ("3-MEDIUM", "1-URGENT", "5-LOW", "2-HIGH", "4-NOT SPECIFIED")])
    return study(spark, d).table("orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n")) \
        .withColumn("place", F.array_position(wanted, F.col("o_orderpriority")).cast("int")).orderBy("place")


@query("u1_suppliers_and_customers", """
SELECT s_name AS name, s_nationkey AS nationkey, s_acctbal AS acctbal FROM supplier UNION ALL
SELECT c_name, c_nationkey, c_acctbal FROM customer""")
def u1(spark, d):
    """Suppliers and customers under one set of columns, given in different orders."""
    t = study(spark, d).table
    a = t("supplier").select(F.col("s_acctbal").alias("acctbal"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nationkey"))
    b = t("customer").select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("acctbal"), F.col("c_nationkey").alias("nationkey"))
    return union_aligned([a, b], ["name", "nationkey", "acctbal"])


@query("u2_key_set_overlap", """
SELECT count_if(b IS NULL) AS only_in_first, count_if(a IS NULL) AS only_in_last, count_if(a IS NOT NULL AND b IS NOT NULL) AS in_both
FROM (SELECT DISTINCT c_custkey AS a FROM customer) FULL JOIN (SELECT DISTINCT o_custkey AS b FROM orders WHERE o_orderstatus = 'P') ON a = b""")
def u2(spark, d):
    """Customers against those with a pending order."""
    t = study(spark, d).table
    pending = t("orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("k"))
    got = key_set_overlap(t("customer").select(F.col("c_custkey").alias("k")), pending, "k")
    return got.select(*[F.col(c).cast("double").alias(c) for c in got.columns])


@query("w1_first_order_per_customer", """
SELECT o_custkey, o_orderkey, o_orderdate FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)
WHERE rn = 1""")
def w1(spark, d):
    """The first order of each customer."""
    orders = study(spark, d).table("orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return keep_first(orders, "o_custkey", ["o_orderdate", "o_orderkey"])


@query("w3_lag_difference", """
SELECT *, CAST(n - lag(n) OVER (ORDER BY month) AS DOUBLE) AS change,
       CAST((n - lag(n) OVER (ORDER BY month)) AS DOUBLE) * 100.0 / lag(n) OVER (ORDER BY month) AS pct_change
FROM (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, count(l_orderkey) AS n FROM lineitem GROUP BY 1)""")
def w3(spark, d):
    """Line items shipped per month and their change."""
    lines = study(spark, d).table("lineitem").select("l_orderkey", F.trunc("l_shipdate", "month").alias("month"))
    return Q.period_change(lines, "month", "l_orderkey", "n")


# Operators whose query is a composite one (same Spark function and oracle).
ALIASES = {
    "j8_wide_feature_join": "f11_gold_dataset",
    "j9_lookup_merge": "p4_collapse_mapping_table",
    "a7_first_value_per_group": "d7_reason_per_month",
    "a9_approx_quantiles": "p12_rate_by_tenure_decile_approx",
    "a10_qcut": "p15_rate_by_download_decile",
    "a13_correlation_matrix": "f14_correlation_matrix",
    "w2_seeded_random_pick": "d4_sample_month",
}

# Operators whose query is the whole composite job, as a query of its own (same oracle); the short forms above
# keep names of their own.
WHOLE = {
    "a8_summary_statistics": "p16_tenure_summary",
    "a11_crosstab_margins": "p10_flag_label_crosstab",
    "a12_sorted_string_agg": "p4_collapse_mapping_table",
    "o2_custom_category_order": "p13_rate_by_fixed_bucket",
    "u1_union_aligned": "d12_observation_set",
    "w1_row_number_keep_first": "d11_dedup_earliest",
}


def _whole(target: str):
    def run(spark, d):
        return QUERIES[target](spark, d)
    return run


def register_aliases() -> None:
    for name, target in WHOLE.items():
        if target in QUERIES and name not in QUERIES:
            QUERIES[name], SQL[name] = _whole(target), SQL[target]
    for alias, target in ALIASES.items():
        if target in QUERIES and alias not in QUERIES:
            QUERIES[alias] = QUERIES[target]
            if target in SQL:
                SQL[alias] = SQL[target]
