"""Registered queries: attrition-rate profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ceasekit.catalog import query
from ceasekit.catalog.features import _crm_sql, _sales_sql, usage_sql
from ceasekit.catalog.study import study
from ceasekit.functions.buckets import LINE_SPEED_BUCKETS, LINE_SPEED_ORDER
from ceasekit.functions.categories import crm_package_clean, sales_channel_clean
from ceasekit.operators.stats import sorted_string_agg
from ceasekit.plans import fits as FT
from ceasekit.plans import observation as OB
from ceasekit.plans import profiles as PR
from ceasekit.operators.polyfit import fit_groups, value_at
from ceasekit.operators.prefix import landed

ID = "unique_customer_identifier"


def _rate_sql(col: str, name: str | None = None, src: str = "raw_info", overall: bool = False, extra: str = "") -> str:
    name = name or col
    tail = ("CAST(sum(sum(churned)) OVER () AS DOUBLE) / sum(count(*)) OVER () AS overall_churn_rate" if overall
            else "CAST(count(*) AS DOUBLE) * 100.0 / sum(count(*)) OVER () AS pct_of_total")
    ex = f", {extra}" if extra else ""
    return f"""
SELECT {col} AS {name}{ex}, count(*) AS total_customers, CAST(sum(churned) AS DOUBLE) / count(*) AS churn_rate, {tail}
FROM {src} GROUP BY ALL"""


@query("p1_overall_rate", "SELECT CAST(avg(churned) AS DOUBLE) AS churn_rate, count(*) AS total_customers FROM raw_info")
def p1(spark, d):
    s = study(spark, d)
    return PR.overall_rate(s.raw_info, s.cfg)


def _p2(col, overall=False):
    def fn(spark, d):
        s = study(spark, d)
        return PR.rate_by_category(s.raw_info, col, s.cfg, with_overall=overall)
    return fn


for _c in ("contract_status", "contract_dd_cancels", "dd_cancel_60_day", "technology", "speed", "sales_channel"):
    query(f"p2_rate_by_{_c}", _rate_sql(_c))(_p2(_c))
query("p2_rate_by_crm_package_name", _rate_sql("crm_package_name", overall=True))(_p2("crm_package_name", True))


@query("p3_rate_by_sales_channel_collapsed", _rate_sql(_sales_sql(), "sales_channel_clean"))
def p3a(spark, d):
    s = study(spark, d)
    return PR.rate_by_category(s.raw_info, sales_channel_clean(), s.cfg, name="sales_channel_clean")


@query("p3_rate_by_crm_package_collapsed", _rate_sql(_crm_sql(), "crm_package_clean"))
def p3b(spark, d):
    s = study(spark, d)
    return PR.rate_by_category(s.raw_info, crm_package_clean(), s.cfg, name="crm_package_clean")


@query("p4_collapse_mapping_table", f"""
SELECT g.crm_package_clean, m.original_categories, g.total_customers, g.churn_rate, g.overall_churn_rate
FROM ({_rate_sql(_crm_sql(), 'crm_package_clean', overall=True)}) g
JOIN (SELECT crm_package_clean,
             array_to_string(list_sort(list(DISTINCT crm_package_name) FILTER (WHERE crm_package_name IS NOT NULL)), ', ')
               AS original_categories
      FROM (SELECT crm_package_name, {_crm_sql()} AS crm_package_clean FROM raw_info) GROUP BY 1) m
  USING (crm_package_clean)""")
def p4(spark, d):
    s = study(spark, d)
    r = s.raw_info.withColumn("crm_package_clean", crm_package_clean())
    stats = PR.rate_by_category(r, "crm_package_clean", s.cfg, with_overall=True)
    mapping = r.groupBy("crm_package_clean").agg(sorted_string_agg("crm_package_name").alias("original_categories"))
    return stats.join(mapping, "crm_package_clean").select(
        "crm_package_clean", "original_categories", "total_customers", "churn_rate", "overall_churn_rate")


@query("p5_rate_by_day_in_range", """
SELECT ooc_days, CAST(avg(churned) AS DOUBLE) AS churn_rate, count(*) AS customer_count
FROM raw_info WHERE ooc_days IS NOT NULL AND ooc_days BETWEEN -150 AND 170 GROUP BY 1""")
def p5(spark, d):
    s = study(spark, d)
    return PR.rate_by_value_in_range(s.raw_info, "ooc_days", -150, 170, s.cfg)


def _p6_sql(min_size: int) -> str:
    return f"""
SELECT CAST(gid + 1 AS INTEGER) AS bucket, ds / dc AS ooc_mid, CAST(bs AS DOUBLE) / bn AS churn_rate, CAST(bn AS BIGINT) AS n
FROM (
  WITH RECURSIVE days AS (
    SELECT *, row_number() OVER (ORDER BY v) AS rn FROM (
      SELECT CAST(ooc_days AS DOUBLE) AS v, count(*) AS n, CAST(sum(churned) AS DOUBLE) AS s
      FROM raw_info WHERE ooc_days IS NOT NULL AND ooc_days BETWEEN -170 AND -80 GROUP BY 1)),
  walk AS (
    SELECT rn, n AS bn, s AS bs, v AS ds, 1 AS dc, n >= {min_size} AS closed, 0 AS gid FROM days WHERE rn = 1
    UNION ALL
    SELECT d.rn,
           CASE WHEN w.closed THEN 0 ELSE w.bn END + d.n,
           CASE WHEN w.closed THEN 0 ELSE w.bs END + d.s,
           CASE WHEN w.closed THEN 0 ELSE w.ds END + d.v,
           CASE WHEN w.closed THEN 0 ELSE w.dc END + 1,
           CASE WHEN w.closed THEN 0 ELSE w.bn END + d.n >= {min_size},
           w.gid + CASE WHEN w.closed THEN 1 ELSE 0 END
    FROM walk w JOIN days d ON d.rn = w.rn + 1)
  SELECT * FROM walk WHERE closed OR rn = (SELECT max(rn) FROM days))"""


@query("p6_min_size_buckets", _p6_sql(1000))
def p6(spark, d):
    s = study(spark, d)
    return PR.min_size_buckets(s.raw_info, "ooc_days", -170, -80, 1000, s.cfg)


@query("p6_min_size_buckets_40", _p6_sql(40))
def p6b(spark, d):
    s = study(spark, d)
    return PR.min_size_buckets(s.raw_info, "ooc_days", -170, -80, 40, s.cfg)


@query("p7_poly_fit")
def p7(spark, d):
    s = study(spark, d)
    pts = PR.rate_by_value_in_range(s.raw_info, "ooc_days", -150, 170, s.cfg)
    return FT.fit_summary(pts, "ooc_days", "churn_rate", 7)


@query("p7_fit_check", """
SELECT CAST(k AS INTEGER) AS power, (SELECT count(DISTINCT ooc_days) FROM raw_info WHERE ooc_days BETWEEN -150 AND 170) AS n_points,
       true AS orthogonal FROM range(8) t(k)""")
def p7c(spark, d):
    """The residuals of P7's fit are orthogonal to every power of x up to its degree."""
    s = study(spark, d)
    pts = PR.rate_by_value_in_range(s.raw_info, "ooc_days", -150, 170, s.cfg)
    return FT.normal_equations(pts, "ooc_days", "churn_rate", 7).select(
        "power", "n_points", (F.col("residual") < 1e-6).alias("orthogonal"))


def _seasonal_returns(s):
    """Return flags of all line items by the day of the year of their shipment, counted from its
    middle: enough rows for buckets of the study's size of 1000."""
    days = (F.dayofyear("l_shipdate") - 183).cast("double").alias("ooc_days")
    return s.table("lineitem").select(days, (F.col("l_returnflag") == "R").cast("int").alias(s.cfg.label_col))


def _seasonal_buckets(s):
    return PR.min_size_buckets(_seasonal_returns(s), "ooc_days", -170, 170, 1000, s.cfg)


@query("p8_weighted_poly_fit")
def p8(spark, d):
    return FT.fit_summary(_seasonal_buckets(study(spark, d)), "ooc_mid", "churn_rate", 6, weight="n")


@query("p8_fit_check", """
SELECT CAST(k AS INTEGER) AS power, true AS orthogonal,
       (SELECT count(*) FROM lineitem WHERE dayofyear(l_shipdate) - 183 BETWEEN -170 AND 170) AS customers FROM range(7) t(k)""")
def p8c(spark, d):
    """The weighted residuals of P8's fit are orthogonal to every power of x; the buckets hold all rows in the range."""
    return FT.normal_equations(_seasonal_buckets(study(spark, d)), "ooc_mid", "churn_rate", 6, weight="n").select(
        "power", (F.col("residual") < 1e-6).alias("orthogonal"), F.col("weight").cast("long").alias("customers"))


@query("p11_poly_curve")
def p11(spark, d):
    f = FT.poly_fit(_seasonal_buckets(study(spark, d)), "ooc_mid", "churn_rate", 6, weight="n")
    return FT.poly_curve(spark, f)


@query("p11_curve_check", """
SELECT kind, CASE kind WHEN 'grid' THEN 500 ELSE 2 END AS points, true AS same_curve FROM (VALUES ('grid'), ('point')) t(kind)""")
def p11c(spark, d):
    """The curve against the polynomial of the same points by Chebyshev moments, a fit of its own."""
    buckets = landed(_seasonal_buckets(study(spark, d)), "seasonal-buckets")
    curve = FT.poly_curve(spark, FT.poly_fit(buckets, "ooc_mid", "churn_rate", 6, weight="n"))
    other = fit_groups(buckets, [], "ooc_mid", "churn_rate", 6, weight="n").first()         # seven coefficients
    at = value_at(F.col("x"), F.lit(other.x_min), F.lit(other.x_max), F.array(*map(F.lit, other.coefficients)))
    return curve.withColumn("_at", at).groupBy("kind").agg(F.count(F.lit(1)).cast("int").alias("points"),
                                                           F.every(F.abs(F.col("_at") - F.col("prediction")) < 1e-6).alias("same_curve"))


@query("p7_lines_by_segment", """
SELECT l_linestatus, l_returnflag, count(*) AS n_points, regr_slope(l_extendedprice, l_quantity) AS slope,
       regr_intercept(l_extendedprice, l_quantity) AS intercept, regr_r2(l_extendedprice, l_quantity) AS r2
FROM lineitem GROUP BY 1, 2""")
def p7l(spark, d):
    """A line per segment of all line items, all segments in one scan."""
    lines = fit_groups(study(spark, d).table("lineitem"), ["l_linestatus", "l_returnflag"], "l_quantity", "l_extendedprice", 1)
    half, mid = (F.col("x_max") - F.col("x_min")) / 2, (F.col("x_max") + F.col("x_min")) / 2
    slope = F.col("coefficients")[1] / half
    return lines.select("l_linestatus", "l_returnflag", "n_points", slope.alias("slope"), (F.col("coefficients")[0] - slope * mid).alias("intercept"), "r2")


@query("p7_fits_by_technology", f"""
SELECT technology, CAST(k AS INTEGER) AS power, count(*) AS n_points, true AS orthogonal FROM raw_info, range(5) t(k)
WHERE ooc_days IS NOT NULL GROUP BY 1, 2""")
def p7t(spark, d):
    """A polynomial of degree 4 of the label over the days per technology; its residuals are orthogonal to every power."""
    rows = study(spark, d).raw_info.where(F.col("ooc_days").isNotNull()).select("technology", "ooc_days", "churned")
    fits = fit_groups(rows, ["technology"], "ooc_days", "churned", 4).withColumnRenamed("technology", "_t")
    both = rows.join(fits, F.col("technology").eqNullSafe(F.col("_t")))
    s = (2 * F.col("ooc_days") - F.col("x_min") - F.col("x_max")) / (F.col("x_max") - F.col("x_min"))
    residual = F.col("churned") - value_at(F.col("ooc_days"), F.col("x_min"), F.col("x_max"), F.col("coefficients"))
    sums = both.groupBy("technology").agg(F.count(F.lit(1)).alias("n_points"), F.array(*[
        F.abs(F.sum(residual * F.pow(s, F.lit(k)))) / F.count(F.lit(1)) < 1e-9 for k in range(5)]).alias("_ok"))
    return sums.select("technology", "n_points", F.posexplode("_ok").alias("power", "orthogonal"))


_PROBS = [0.1, 0.25, 0.5, 0.75, 0.9, 0.99]


@query("a9_exact_quantiles", f"""
SELECT unnest({_PROBS}) AS p, unnest(quantile_cont(CAST(l_extendedprice AS DOUBLE), {_PROBS})) AS q FROM lineitem""")
def a9_exact(spark, d):
    from ceasekit.operators.stats import exact_quantiles
    q = exact_quantiles(study(spark, d).table("lineitem"), "l_extendedprice", _PROBS)
    return spark.createDataFrame([(p, float(v)) for p, v in zip(_PROBS, q, strict=True)], "p double, q double")


@query("a9_rank_check", f"SELECT unnest({_PROBS}) AS p, count(*) AS n_rows, true AS within FROM lineitem")
def a9_rank(spark, d):
    """Whether the rank of each approximate quantile is within 0.01 n of the one asked for."""
    rows = study(spark, d).table("lineitem").select(F.col("l_extendedprice").cast("double").alias("x"))
    edges = PR.quantile_edges(rows, "x", _PROBS, exact=False, rel_error=0.01)
    at = [F.element_at(edges, i + 1) for i in range(len(_PROBS))]
    n = F.count(F.lit(1))
    one = rows.agg(n.alias("n_rows"), F.array(*[F.struct(
        F.lit(p).alias("p"), ((F.count_if(F.col("x") < e) <= (p + 0.01) * n) & (F.count_if(F.col("x") <= e) >= (p - 0.01) * n)).alias("within"))
        for p, e in zip(_PROBS, at, strict=True)]).alias("c"))
    return one.select("n_rows", F.inline("c"))


_ANY_CALL = f"SELECT DISTINCT {ID} FROM calls"
_HAS_USAGE = f"SELECT DISTINCT {ID} FROM usage_behav_month"


def _flag_sql(src: str, name: str) -> str:
    return f"""
SELECT CASE WHEN f.{ID} IS NOT NULL THEN 1 ELSE 0 END AS {name}, CAST(avg(r.churned) AS DOUBLE) AS churn_rate,
       count(*) AS customer_count
FROM raw_info r LEFT JOIN ({src}) f ON r.{ID} = f.{ID} GROUP BY 1"""


@query("p9_rate_by_has_calls", _flag_sql(_ANY_CALL, "has_calls"))
def p9a(spark, d):
    s = study(spark, d)
    return PR.rate_by_flag(s.raw_info, s.calls, "has_calls", s.cfg)


@query("p9_rate_by_has_usage", _flag_sql(_HAS_USAGE, "has_usage"))
def p9b(spark, d):
    s = study(spark, d)
    return PR.rate_by_flag(s.raw_info, s.usage_behav_month, "has_usage", s.cfg)


@query("p10_flag_label_crosstab", f"""
SELECT CASE WHEN grouping(has_usage) = 1 THEN 'All' ELSE CAST(has_usage AS VARCHAR) END AS has_usage,
       CAST(sum(CASE WHEN grouping(churned) = 0 AND churned = 0 THEN n ELSE 0 END) AS BIGINT) AS churned_0,
       CAST(sum(CASE WHEN grouping(churned) = 0 AND churned = 1 THEN n ELSE 0 END) AS BIGINT) AS churned_1,
       CAST(sum(CASE WHEN grouping(churned) = 1 THEN n ELSE 0 END) AS BIGINT) AS churned_All
FROM (SELECT has_usage, churned, count(*) AS n, grouping(has_usage) AS gh
      FROM (SELECT CASE WHEN f.{ID} IS NOT NULL THEN 1 ELSE 0 END AS has_usage, r.churned
            FROM raw_info r LEFT JOIN ({_HAS_USAGE}) f ON r.{ID} = f.{ID})
      GROUP BY CUBE (has_usage, churned)) GROUP BY 1""".replace("grouping(has_usage) = 1", "gh = 1")
       .replace("grouping(churned) = 0 AND churned = 0", "churned IS NOT NULL AND churned = 0")
       .replace("grouping(churned) = 0 AND churned = 1", "churned IS NOT NULL AND churned = 1")
       .replace("grouping(churned) = 1", "churned IS NULL"))
def p10(spark, d):
    s = study(spark, d)
    return PR.flag_label_crosstab(s.raw_info, s.usage_behav_month, "has_usage", s.cfg)


def _edge(e, digits):
    return f"CAST(CAST(CAST({e} AS DECIMAL(38,10)) AS DECIMAL(38,{digits})) AS VARCHAR)"


def _qbucket_sql(c: str, digits: int) -> str:
    q = "(SELECT quantile_cont(CAST({c} AS DOUBLE), [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) FROM raw_info WHERE {c} IS NOT NULL)".format(c=c)
    lab, order = [f"WHEN {c} IS NULL THEN 'Missing'"], [f"WHEN {c} IS NULL THEN 11"]
    for i in range(9):
        e = f"e[{i + 1}]"
        lo = "'0'" if i == 0 else _edge(f"e[{i}]", digits)
        lab.append(f"WHEN {c} <= {e} THEN {lo} || '-' || {_edge(e, digits)}")
        order.append(f"WHEN {c} <= {e} THEN {i + 1}")
    body = (f"SELECT CASE {' '.join(lab)} ELSE {_edge('e[9]', digits)} || '+' END AS {c}_bucket, "
            f"CAST(CASE {' '.join(order)} ELSE 10 END AS INTEGER) AS bucket_order, churned "
            f"FROM raw_info, (SELECT {q} AS e)")
    return _rate_sql(f"{c}_bucket", src=f"({body})", extra="bucket_order")


@query("p12_rate_by_line_speed_decile", _qbucket_sql("line_speed", 1))
def p12a(spark, d):
    s = study(spark, d)
    return PR.rate_by_quantile_bucket(s.raw_info, "line_speed", 1, True, s.cfg)


@query("p12_rate_by_tenure_decile", _qbucket_sql("tenure_days", 0))
def p12b(spark, d):
    s = study(spark, d)
    return PR.rate_by_quantile_bucket(s.raw_info, "tenure_days", 0, True, s.cfg)


@query("p12_rate_by_tenure_decile_approx")
def p12c(spark, d):
    s = study(spark, d)
    return PR.rate_by_quantile_bucket(s.raw_info, "tenure_days", 0, False, s.cfg)


def _fixed_sql(compat: bool) -> str:
    parts = ["WHEN line_speed IS NULL THEN 'Missing'"]
    if not compat:
        parts.append("WHEN line_speed < 0 THEN 'Below 0'")
    for lo, hi, label in LINE_SPEED_BUCKETS:
        cond = f"line_speed BETWEEN {lo} AND {hi}" if compat else f"line_speed >= {lo} AND line_speed < {hi + 1}"
        parts.append(f"WHEN {cond} THEN '{label}'")
    lab = f"CASE {' '.join(parts)} ELSE 'Over 108' END"
    order_list = "[" + ", ".join(f"'{x}'" for x in LINE_SPEED_ORDER) + "]"
    inner = _rate_sql(lab, "line_speed_bucket")
    return f"SELECT *, CAST(list_position({order_list}, line_speed_bucket) AS INTEGER) AS bucket_order FROM ({inner})"


@query("p13_rate_by_fixed_bucket", _fixed_sql(False))
def p13(spark, d):
    s = study(spark, d)
    return PR.rate_by_fixed_bucket(s.raw_info, "line_speed", False, s.cfg)


@query("p13_rate_by_fixed_bucket_compat", _fixed_sql(True))
def p13c(spark, d):
    s = study(spark, d)
    return PR.rate_by_fixed_bucket(s.raw_info, "line_speed", True, s.cfg)


def _usage_bucket_sql(obs: str, days: str) -> str:
    m = "(day(last_day(o.behav_win)) - COALESCE(u.usage_days, 0))"
    lab = (f"CASE WHEN COALESCE(u.usage_days, 0) = 0 THEN 'no_usage' WHEN {m} = 0 THEN 'full_usage' "
           f"WHEN {m} >= 1 AND {m} <= 14 THEN 'missed_1_to_14' ELSE 'missed_15_plus' END")
    return f"""
SELECT {lab} AS usage_bucket, CAST(avg(o.churned) AS DOUBLE) AS churn_rate, count(*) AS customer_count
FROM {obs} o LEFT JOIN {days} u ON o.{ID} = u.{ID} GROUP BY 1"""


@query("p14_rate_by_usage_bucket", _usage_bucket_sql("raw_info", "usage_days_a"))
def p14(spark, d):
    s = study(spark, d)
    return PR.rate_by_usage_bucket(s.raw_info, s.usage_behav_month, s.cfg)


@query("p14_rate_by_usage_bucket_b", _usage_bucket_sql("obs_b", "usage_days_b"))
def p14b(spark, d):
    s = study(spark, d)
    return PR.rate_by_usage_bucket(s.obs_b, OB.usage_in_obs_month(s.usage_b, s.obs_b, s.cfg), s.cfg)


def _decile_sql(obs: str, usage: str, measure: str) -> str:
    tot = (f"SELECT o.{ID}, o.churned, COALESCE(t.total, 0.0) AS total FROM {obs} o LEFT JOIN "
           f"(SELECT {ID}, sum({measure}) AS total FROM {usage} GROUP BY 1) t ON o.{ID} = t.{ID}")
    edges = (f"(SELECT list_sort(list_distinct(quantile_cont(total, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]))) "
             f"FROM ({tot}))")
    return f"""
SELECT CAST(len(list_filter(e[2:len(e) - 1], lambda x: x < total)) AS INTEGER) AS usage_bucket,
       CAST(avg(churned) AS DOUBLE) AS churn_rate, count(*) AS customer_count,
       min(total) AS min_usage_mb, max(total) AS max_usage_mb
FROM ({tot}), (SELECT {edges} AS e) GROUP BY 1"""


@query("p15_rate_by_download_decile", _decile_sql("raw_info", "usage_behav_month", "usage_download_mbs"))
def p15a(spark, d):
    s = study(spark, d)
    return PR.rate_by_usage_decile(s.raw_info, s.usage_behav_month, "usage_download_mbs", s.cfg)


@query("p15_rate_by_upload_decile", _decile_sql("raw_info", "usage_behav_month", "usage_upload_mbs"))
def p15b(spark, d):
    s = study(spark, d)
    return PR.rate_by_usage_decile(s.raw_info, s.usage_behav_month, "usage_upload_mbs", s.cfg)


@query("p15_rate_by_download_decile_b", _decile_sql("obs_b", "usage_obs_b", "usage_download_mbs"))
def p15c(spark, d):
    s = study(spark, d)
    return PR.rate_by_usage_decile(s.obs_b, OB.usage_in_obs_month(s.usage_b, s.obs_b, s.cfg), "usage_download_mbs", s.cfg)


@query("p16_tenure_summary", """
SELECT count(x) AS n, avg(x) AS mean, stddev_samp(x) AS stddev, min(x) AS min, quantile_cont(x, 0.25) AS p25,
       quantile_cont(x, 0.5) AS p50, quantile_cont(x, 0.75) AS p75, max(x) AS max,
       (SELECT count(DISTINCT tenure_days) FROM raw_info) AS distinct_values
FROM (SELECT CAST(tenure_days AS DOUBLE) AS x FROM raw_info)""")
def p16(spark, d):
    return PR.tenure_summary(study(spark, d).raw_info)
