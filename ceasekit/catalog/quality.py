"""Registered queries: data-quality and trend jobs (Q1-Q20)."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ceasekit.catalog import SQL, query
from ceasekit.catalog.study import study
from ceasekit.operators.prefix import landed
from ceasekit.plans import quality as Q
from ceasekit.sources import fixtures as FX
from ceasekit.sources import io as IO

ID = "unique_customer_identifier"
WEEK_SQL = "CAST(isoyear({d}) AS VARCHAR) || '-W' || lpad(CAST(week({d}) AS VARCHAR), 2, '0')"


def _tables(s):
    return {"cease": s.cease, "customer_info": s.info, "calls": s.calls, "usage": s.usage}


@query("q1_table_stats", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS total_rows, count(DISTINCT {ID}) AS distinct_keys, "
    f"CAST(count(*) AS DOUBLE) / count(DISTINCT {ID}) AS rows_per_key FROM {t}"
    for t in ("cease", "customer_info", "calls", "usage")))
def q1(spark, d):
    s = study(spark, d)
    out = None
    for name, df in _tables(s).items():
        x = Q.table_stats(df, ID).select(F.lit(name).alias("table_name"), "*")
        out = x if out is None else out.unionByName(x)
    return out


@query("q2_date_range", """
SELECT 'cease' AS table_name, min(cease_placed_date) AS min_date, max(cease_placed_date) AS max_date,
       count(DISTINCT cease_placed_date) AS distinct_periods FROM cease
UNION ALL SELECT 'customer_info', min(datevalue), max(datevalue), count(DISTINCT datevalue) FROM customer_info
UNION ALL SELECT 'usage', min(calendar_date), max(calendar_date), count(DISTINCT calendar_date) FROM usage""")
def q2(spark, d):
    s = study(spark, d)
    parts = [("cease", s.cease, "cease_placed_date"), ("customer_info", s.info, "datevalue"),
             ("usage", s.usage, "calendar_date")]
    out = None
    for name, df, c in parts:
        x = Q.date_range(df, c).select(F.lit(name).alias("table_name"), "*")
        out = x if out is None else out.unionByName(x)
    return out


@query("q3_cease_by_day", "SELECT cease_placed_date, count(*) AS cease_count FROM cease GROUP BY 1")
def q3a(spark, d):
    return Q.counts_by_period(study(spark, d).cease, "cease_placed_date", "cease_count")


@query("q3_customers_by_month", f"SELECT datevalue, count({ID}) AS customer_count FROM customer_info GROUP BY 1")
def q3b(spark, d):
    return Q.counts_by_period(study(spark, d).info, "datevalue", "customer_count", key=ID)


@query("q4_period_change", f"""
SELECT datevalue, customer_count, CAST(customer_count - lag(customer_count) OVER (ORDER BY datevalue) AS DOUBLE) AS change,
       CAST((customer_count - lag(customer_count) OVER (ORDER BY datevalue)) AS DOUBLE) * 100.0
         / lag(customer_count) OVER (ORDER BY datevalue) AS pct_change
FROM (SELECT datevalue, count({ID}) AS customer_count FROM customer_info GROUP BY 1)""")
def q4(spark, d):
    return Q.period_change(study(spark, d).info, "datevalue", ID)


@query("q5_membership_movement", f"""
SELECT (SELECT count(*) FROM (SELECT DISTINCT {ID} FROM customer_info WHERE datevalue = (SELECT min_month FROM info_scalars))
        WHERE {ID} NOT IN (SELECT {ID} FROM customer_info WHERE datevalue = (SELECT max_month FROM info_scalars))) AS only_in_first,
       (SELECT count(*) FROM (SELECT DISTINCT {ID} FROM customer_info WHERE datevalue = (SELECT max_month FROM info_scalars))
        WHERE {ID} NOT IN (SELECT {ID} FROM customer_info WHERE datevalue = (SELECT min_month FROM info_scalars))) AS only_in_last,
       (SELECT count(*) FROM (SELECT DISTINCT {ID} FROM customer_info WHERE datevalue = (SELECT max_month FROM info_scalars))
        WHERE {ID} IN (SELECT {ID} FROM customer_info WHERE datevalue = (SELECT min_month FROM info_scalars))) AS in_both""")
def q5(spark, d):
    return Q.membership_movement(study(spark, d).info, ID, "datevalue")


@query("q6_grain_check", f"""
SELECT CAST(sum(n) AS BIGINT) AS total_rows, count(*) AS distinct_keys, CAST(sum(n - 1) AS BIGINT) AS duplicates,
       CASE WHEN sum(n - 1) = 0 THEN 1 ELSE 0 END AS grain_ok
FROM (SELECT {ID}, datevalue, count(*) AS n FROM customer_info GROUP BY ALL)""")
def q6(spark, d):
    return Q.grain_check(study(spark, d).info, [ID, "datevalue"])


@query("q6_grain_check_usage", f"""
SELECT CAST(sum(n) AS BIGINT) AS total_rows, count(*) AS distinct_keys, CAST(sum(n - 1) AS BIGINT) AS duplicates,
       CASE WHEN sum(n - 1) = 0 THEN 1 ELSE 0 END AS grain_ok
FROM (SELECT {ID}, calendar_date, count(*) AS n FROM usage GROUP BY ALL)""")
def q6u(spark, d):
    return Q.grain_check(study(spark, d).usage, [ID, "calendar_date"])


@query("q7_avg_periods_per_key", f"SELECT avg(n) AS avg_periods FROM (SELECT {ID}, count(*) AS n FROM customer_info GROUP BY 1)")
def q7(spark, d):
    return Q.avg_periods_per_key(study(spark, d).info, ID)


_WEEKLY = f"""SELECT year_week, count(*) AS days_in_week, CAST(sum(churns) AS BIGINT) AS weekly_churns
FROM (SELECT {WEEK_SQL.format(d='cease_placed_date')} AS year_week, cease_placed_date, count(*) AS churns
      FROM cease GROUP BY 1, 2) GROUP BY 1"""


@query("q8_weekly_churn", _WEEKLY)
def q8(spark, d):
    return Q.weekly_counts(study(spark, d).cease, "cease_placed_date")


@query("q8_weekly_churn_all_orders", f"""SELECT year_week, count(*) AS days_in_week, CAST(sum(churns) AS BIGINT) AS weekly_churns
FROM (SELECT {WEEK_SQL.format(d='CAST(o_orderdate AS DATE)')} AS year_week, CAST(o_orderdate AS DATE) AS d, count(*) AS churns
      FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2) GROUP BY 1""")
def q8all(spark, d):
    """Every finished order as a cease request."""
    return Q.weekly_counts(FX.cease(spark, d, least_price=0), "cease_placed_date")


@query("q9_active_balance", f"""
SELECT *, CAST((SELECT count(*) FROM customer_info WHERE datevalue = (SELECT min_month FROM info_scalars)) - cumulative_churns AS BIGINT) AS active_customers
FROM (SELECT *, CAST(sum(weekly_churns) OVER (ORDER BY year_week ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cumulative_churns
      FROM ({_WEEKLY}))""")
def q9(spark, d):
    s = study(spark, d)
    return Q.active_balance(s.cease, s.info, "cease_placed_date", "datevalue")


@query("q10_usage_to_event_gap", f"""
SELECT u.{ID}, min(u.calendar_date) AS first_usage_date, max(u.calendar_date) AS last_usage_date, c.cease_placed_date,
       CAST(date_diff('day', max(u.calendar_date), c.cease_placed_date) AS INTEGER) AS days_diff_usage_to_cease
FROM usage u JOIN cease c ON u.{ID} = c.{ID} GROUP BY u.{ID}, c.cease_placed_date""")
def q10(spark, d):
    s = study(spark, d)
    return Q.usage_to_event_gap(s.usage, s.cease, ID, "calendar_date", "cease_placed_date") \
        .withColumn("days_diff_usage_to_cease", F.col("days_diff_usage_to_cease").cast("int"))


@query("q10_gap_summary", f"""
SELECT count(x) AS n, avg(x) AS mean, stddev_samp(x) AS stddev, CAST(min(x) AS DOUBLE) AS min,
       quantile_cont(x, 0.25) AS p25, quantile_cont(x, 0.5) AS p50, quantile_cont(x, 0.75) AS p75, CAST(max(x) AS DOUBLE) AS max
FROM (SELECT date_diff('day', max(u.calendar_date), c.cease_placed_date) AS x
      FROM usage u JOIN cease c ON u.{ID} = c.{ID} GROUP BY u.{ID}, c.cease_placed_date)""")
def q10s(spark, d):
    from ceasekit.operators.stats import summary_stats
    s = study(spark, d)
    g = Q.usage_to_event_gap(s.usage, s.cease, ID, "calendar_date", "cease_placed_date")
    return summary_stats(g, "days_diff_usage_to_cease")


@query("q10_usage_to_event_gap_bucketed", SQL["q10_usage_to_event_gap"])
def q10b(spark, d):
    """The gaps from the bucketed daily usage: its side is neither shuffled nor sorted again."""
    s = study(spark, d)
    return Q.usage_to_event_gap(s.usage_daily, s.cease, ID, "calendar_date", "cease_placed_date") \
        .withColumn("days_diff_usage_to_cease", F.col("days_diff_usage_to_cease").cast("int"))


@query("q11_usage_after_completed", f"""
SELECT count(DISTINCT u.{ID}) AS customers, count(*) AS records
FROM usage u JOIN cease c ON u.{ID} = c.{ID} WHERE u.calendar_date > c.cease_completed_date""")
def q11(spark, d):
    s = study(spark, d)
    return Q.usage_after(s.usage, s.cease, ID, "calendar_date", "cease_completed_date")


@query("q12_usage_after_placed", f"""
SELECT count(DISTINCT u.{ID}) AS customers, count(*) AS records
FROM usage u JOIN cease c ON u.{ID} = c.{ID} WHERE u.calendar_date > c.cease_placed_date""")
def q12(spark, d):
    s = study(spark, d)
    return Q.usage_after(s.usage, s.cease, ID, "calendar_date", "cease_placed_date")


@query("q13_null_rate", """
SELECT count_if(cease_completed_date IS NULL) AS null_rows, count(*) AS total_rows,
       CAST(count_if(cease_completed_date IS NULL) AS DOUBLE) * 100.0 / count(*) AS pct_null FROM cease""")
def q13(spark, d):
    return Q.null_rate(study(spark, d).cease, "cease_completed_date")


@query("q14_missing_in_other", f"""
SELECT count(*) AS customers_without_usage FROM (SELECT DISTINCT {ID} FROM customer_info
WHERE {ID} NOT IN (SELECT {ID} FROM usage))""")
def q14(spark, d):
    s = study(spark, d)
    return Q.missing_in_other(s.info, s.usage, ID).agg(F.count(F.lit(1)).alias("customers_without_usage"))


@query("q15_missing_full_rows", f"""
SELECT * FROM customer_info i LEFT JOIN cease c USING ({ID}) WHERE {ID} NOT IN (SELECT {ID} FROM usage)""")
def q15(spark, d):
    s = study(spark, d)
    return Q.missing_full_rows(s.info, s.usage, s.cease, ID)


_WITHOUT_USAGE_B = f"SELECT * FROM customer_info i LEFT JOIN cease c USING ({ID}) WHERE {ID} NOT IN (SELECT {ID} FROM usage_b WHERE {ID} IS NOT NULL)"


@query("q15_missing_full_rows_b", _WITHOUT_USAGE_B)
def q15b(spark, d):
    """Snapshots (with their cease requests) of the customers without any of the dense daily usage: most of them."""
    s = study(spark, d)
    return Q.missing_full_rows(s.info, s.usage_b, s.cease, ID)


@query("q15_export_missing", _WITHOUT_USAGE_B)
def q15e(spark, d):
    """The same rows exported as CSV, part files written by the tasks, and read back with their types."""
    rows = q15b(spark, d)
    path = IO.export_csv(rows, IO.scratch_path(spark, "without-usage-csv"))
    return IO.read_csv(spark, path, rows.schema)


@query("q5_sketch_check", """
SELECT q.*, true AS sizes_within FROM (""" + SQL["q5_membership_movement"] + ") q")
def q5s(spark, d):
    """The exact sizes, and whether the estimates from one theta sketch per month are within three standard errors
    (of a sketch of 2^14 keys: 1 / sqrt(2^14 - 1) of the union's size)."""
    s = study(spark, d)
    sketches = landed(Q.period_sketches(s.info, ID, "datevalue"), "period-sketches")
    guess = landed(Q.estimated_movement(sketches, "datevalue"), "period-estimates")
    exact = Q.membership_movement(s.info, ID, "datevalue")
    names = ("only_in_first", "only_in_last", "in_both")
    bound = 3 / math.sqrt(2 ** 14 - 1) * guess.select("in_either").scalar() + 0.5
    within = [F.abs(F.col(c) - guess.select(c).scalar()) <= bound for c in names]
    return exact.select(*names, (within[0] & within[1] & within[2]).alias("sizes_within"))


def _missing_sql(table: str, cols) -> str:
    parts = []
    for c, t in cols:
        cond = f"{c} IS NULL OR isnan({c})" if t == "double" else f"{c} IS NULL"
        parts.append(f"SELECT '{c}' AS column_name, count_if({cond}) AS missing FROM {table}")
    return " UNION ALL ".join(parts)


INFO_TYPES = [(ID, "string"), ("datevalue", "date"), ("contract_status", "string"), ("contract_dd_cancels", "int"),
              ("dd_cancel_60_day", "int"), ("ooc_days", "double"), ("technology", "string"), ("speed", "int"),
              ("line_speed", "double"), ("sales_channel", "string"), ("crm_package_name", "string"),
              ("tenure_days", "int")]
SILVER_TYPES = [INFO_TYPES[0], ("behav_win", "date"), ("churned", "int")] + INFO_TYPES[2:]


@query("q16_missing_values_info", _missing_sql("customer_info", INFO_TYPES))
def q16(spark, d):
    return Q.missing_values(study(spark, d).info)


@query("q16_missing_values_silver", _missing_sql("raw_info", SILVER_TYPES))
def q16s(spark, d):
    return Q.missing_values(study(spark, d).raw_info)


CATS = ("contract_status", "technology", "sales_channel", "crm_package_name")


@query("q17_categorical_cardinality", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS distinct_values "
    f"FROM customer_info" for c in CATS))
def q17(spark, d):
    return Q.categorical_cardinality(study(spark, d).info, CATS)


@query("q18_value_distribution", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS n FROM customer_info GROUP BY 2"
    for c in ("contract_status", "technology", "sales_channel")))
def q18(spark, d):
    return Q.value_distribution(study(spark, d).info, ["contract_status", "technology", "sales_channel"])


@query("q19_null_rows", "SELECT * FROM customer_info WHERE ooc_days IS NULL")
def q19(spark, d):
    return Q.null_rows(study(spark, d).info, "ooc_days")


@query("q20_label_balance", "SELECT churned, count(*) AS n FROM raw_info GROUP BY 1")
def q20(spark, d):
    return Q.label_balance(study(spark, d).raw_info, "churned")
