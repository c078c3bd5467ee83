"""Registered queries: gold features (F1-F16)."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from ceasekit.catalog import query
from ceasekit.catalog.study import study
from ceasekit.config import CRM_KEEP, CRM_OTHER, CRM_ULTRA, GOLD_BASE, REDUNDANT_SPEED_COLUMNS, SALES_CHANNEL_MAP
from ceasekit.functions.categories import NAME_STYLES, clean_name
from ceasekit.oracle_sql import register
from ceasekit.plans import features as FE
from ceasekit.plans import observation as OB
from ceasekit.sources import fixtures as FX

ID = "unique_customer_identifier"


def _q(v):
    return str(v) if isinstance(v, int) else "'" + str(v).replace("'", "''") + "'"


def _sales_sql(c="sales_channel"):
    parts = [f"WHEN {c} IN ({', '.join(_q(x) for x in src)}) THEN {_q(t)}" for src, t in SALES_CHANNEL_MAP]
    return f"CASE {' '.join(parts)} ELSE {c} END"


def _crm_sql(c="crm_package_name"):
    return (f"CASE WHEN {c} IN ({', '.join(_q(x) for x in CRM_ULTRA)}) THEN {_q(CRM_ULTRA[0])} "
            f"WHEN {c} IN ({', '.join(_q(x) for x in CRM_KEEP)}) THEN {c} ELSE {_q(CRM_OTHER)} END")


def _collapsed_channels():
    out = set()
    for v in FX.SALES_CHANNELS:
        if v is None:
            continue
        t = next((tgt for src, tgt in SALES_CHANNEL_MAP if v in src), v)
        out.add(t)
    return sorted(out)


# Expected categories of the derived tables (the Spark side discovers them from data).
FIXTURE_CATS = {
    "contract_status": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"],
    "technology": sorted(FX.TECHNOLOGIES),
    "speed": sorted(FX.SPEEDS),
    "sales_channel": _collapsed_channels(),
    "crm_package": sorted({CRM_ULTRA[0], *CRM_KEEP, CRM_OTHER}),
}
SQL_SRC = {"contract_status": "contract_status", "technology": "technology", "speed": "speed",
           "sales_channel": _sales_sql(), "crm_package": _crm_sql()}


def one_hot_sql(group: str) -> list[tuple[str, str]]:
    prefix, _, style, _ = FE.ONE_HOT_SPECS[group]
    names = {}
    for v in FIXTURE_CATS[group]:
        names.setdefault(clean_name(prefix, v, style), []).append(v)
    return [(n, f"CASE WHEN ({SQL_SRC[group]}) IN ({', '.join(_q(v) for v in names[n])}) THEN 1 ELSE 0 END")
            for n in sorted(names)]


OOC_SQL = [("ooc_bucket_under_minus100", "CASE WHEN ooc_days < -100 THEN 1 ELSE 0 END"),
           ("ooc_bucket_minus100_to_50", "CASE WHEN ooc_days BETWEEN -100 AND 50 THEN 1 ELSE 0 END"),
           ("ooc_bucket_over_50", "CASE WHEN ooc_days > 50 THEN 1 ELSE 0 END"),
           ("ooc_bucket_missing", "CASE WHEN ooc_days IS NULL THEN 1 ELSE 0 END")]


def usage_sql(u="usage_days", bw="behav_win"):
    m = f"(day(last_day({bw})) - {u})"
    return [("usage_days_bucket_no_usage", f"CASE WHEN {u} = 0 THEN 1 ELSE 0 END"),
            ("usage_days_bucket_full_usage", f"CASE WHEN {m} = 0 AND {u} > 0 THEN 1 ELSE 0 END"),
            ("usage_days_bucket_missed_1_to_14", f"CASE WHEN {m} >= 1 AND {m} <= 14 THEN 1 ELSE 0 END"),
            ("usage_days_bucket_missed_15_plus", f"CASE WHEN {m} > 14 AND {u} > 0 THEN 1 ELSE 0 END")]


def clean_name_sql_text(group: str) -> str:
    """The column name of a row's category in SQL."""
    prefix, _, style, _ = FE.ONE_HOT_SPECS[group]
    text = f"CAST({SQL_SRC[group]} AS VARCHAR)"
    for old, new in NAME_STYLES[style]:
        text = f"replace({text}, '{old}', '{new}')"
    return f"'{prefix}' || lower({text})"


GOLD_FEATURES = ([n for n, _ in one_hot_sql("contract_status")] + [n for n, _ in OOC_SQL]
                 + [n for g in ("technology", "speed", "sales_channel", "crm_package") for n, _ in one_hot_sql(g)]
                 + [n for n, _ in usage_sql()] + ["has_calls"])
GOLD_NUMERIC = list(GOLD_BASE) + GOLD_FEATURES


def _sel(pairs):
    return ",\n       ".join(f"{e} AS {n}" for n, e in pairs)


register("usage_days_a", f"SELECT {ID}, count(DISTINCT calendar_date) AS usage_days FROM usage_behav_month GROUP BY 1")
register("calls_in_month", f"""
SELECT DISTINCT c.{ID} FROM calls c JOIN raw_info r
  ON c.{ID} = r.{ID} AND CAST(date_trunc('month', c.event_date) AS DATE) = r.behav_win""")
register("gold", f"""
SELECT r.{ID}, {', '.join('r.' + c for c in GOLD_BASE)},
       {_sel(one_hot_sql('contract_status') + OOC_SQL + one_hot_sql('technology') + one_hot_sql('speed')
             + one_hot_sql('sales_channel') + one_hot_sql('crm_package'))},
       {_sel(usage_sql('COALESCE(u.usage_days, 0)', 'r.behav_win'))},
       CASE WHEN k.{ID} IS NOT NULL THEN 1 ELSE 0 END AS has_calls
FROM raw_info r LEFT JOIN usage_days_a u ON r.{ID} = u.{ID} LEFT JOIN calls_in_month k ON r.{ID} = k.{ID}""")


def _group_sql(group):
    return f"SELECT {ID}, {_sel(one_hot_sql(group))} FROM raw_info"


@query("f1_contract_status_features", _group_sql("contract_status"))
def f1(spark, d):
    s = study(spark, d)
    return FE.contract_status_features(s.raw_info, s.cfg)


@query("f2_ooc_days_features", f"SELECT {ID}, {_sel(OOC_SQL)} FROM raw_info")
def f2(spark, d):
    s = study(spark, d)
    return FE.ooc_days_features(s.raw_info, s.cfg)


@query("f3_technology_features", _group_sql("technology"))
def f3(spark, d):
    s = study(spark, d)
    return FE.technology_features(s.raw_info, s.cfg)


@query("f4_speed_features", _group_sql("speed"))
def f4(spark, d):
    s = study(spark, d)
    return FE.speed_features(s.raw_info, s.cfg)


@query("f5_sales_channel_features", _group_sql("sales_channel"))
def f5(spark, d):
    s = study(spark, d)
    return FE.sales_channel_features(s.raw_info, s.cfg)


@query("f6_crm_package_features", _group_sql("crm_package"))
def f6(spark, d):
    s = study(spark, d)
    return FE.crm_package_features(s.raw_info, s.cfg)


@query("f7_usage_days_features", f"""
SELECT r.{ID}, {_sel(usage_sql('COALESCE(u.usage_days, 0)', 'r.behav_win'))}
FROM raw_info r LEFT JOIN usage_days_a u ON r.{ID} = u.{ID}""")
def f7(spark, d):
    s = study(spark, d)
    return FE.usage_days_features(s.raw_info, s.usage_behav_month, s.cfg)


register("usage_obs_b", f"""
SELECT u.*, o.behav_win FROM usage_b u JOIN obs_b o
  ON u.{ID} = o.{ID} AND CAST(date_trunc('month', u.calendar_date) AS DATE) = o.behav_win""")
register("usage_days_b", f"SELECT {ID}, count(DISTINCT calendar_date) AS usage_days FROM usage_obs_b GROUP BY 1")


@query("f7_usage_days_features_b", f"""
SELECT o.{ID}, {_sel(usage_sql('COALESCE(u.usage_days, 0)', 'o.behav_win'))}
FROM obs_b o LEFT JOIN usage_days_b u ON o.{ID} = u.{ID}""")
def f7b(spark, d):
    s = study(spark, d)
    ub = OB.usage_in_obs_month(s.usage_b, s.obs_b, s.cfg)
    return FE.usage_days_features(s.obs_b, ub, s.cfg)


@query("f7_usage_days_features_bucketed", f"""
SELECT r.{ID}, {_sel(usage_sql('COALESCE(u.usage_days, 0)', 'r.behav_win'))}
FROM raw_info r LEFT JOIN usage_days_a u ON r.{ID} = u.{ID}""")
def f7k(spark, d):
    """Usage-day buckets from the bucketed daily usage: the month join and the count need no shuffle of usage."""
    s = study(spark, d)
    return FE.usage_days_features(s.raw_info, OB.daily_usage_in_obs_month(s.usage_daily, s.raw_info, s.cfg), s.cfg)


@query("f8_has_calls_feature", f"""
SELECT r.{ID}, CASE WHEN k.{ID} IS NOT NULL THEN 1 ELSE 0 END AS has_calls
FROM raw_info r LEFT JOIN calls_in_month k ON r.{ID} = k.{ID}""")
def f8(spark, d):
    s = study(spark, d)
    return FE.has_calls_feature(s.raw_info, s.calls, s.cfg)


@query("f9_one_hot", f"SELECT {ID}, datevalue, {_sel(one_hot_sql('technology'))} FROM customer_info")
def f9(spark, d):
    s = study(spark, d)
    vals = FE.distinct_values(s.info, F.col("technology"))
    return s.info.select(ID, "datevalue", *FE.one_hot_group("technology", vals))


register("category_codes", " UNION ALL ".join(
    f"SELECT '{g}' AS category_group, c AS value, CAST(row_number() OVER (ORDER BY c) - 1 AS BIGINT) AS code "
    f"FROM (SELECT DISTINCT {clean_name_sql_text(g)} AS c FROM raw_info) WHERE c IS NOT NULL" for g in FE.ONE_HOT_SPECS))


@query("f9_category_codes", "SELECT * FROM category_codes")
def f9_codes(spark, d):
    """The dictionary of all one-hot groups: dense codes in the order of the column names."""
    return FE.category_codes(study(spark, d).raw_info, FE.category_names())


@query("f9_sparse_one_hot", " UNION ALL ".join(
    f"SELECT r.{ID}, '{g}' AS category_group, k.code, 1.0 AS value FROM raw_info r JOIN category_codes k "
    f"ON k.category_group = '{g}' AND k.value = {clean_name_sql_text(g)}" for g in FE.ONE_HOT_SPECS))
def f9_sparse(spark, d):
    """The entries of every customer's sparse one-hot vectors, by their codes (no vector is made dense)."""
    rows, _ = FE.sparse_features(study(spark, d).raw_info)
    entries = F.array(*[F.struct(F.lit(g).alias("category_group"), F.col(f"{g}_code").alias("code"), F.lit(1.0).alias("value")) for g in FE.ONE_HOT_SPECS])
    return rows.select(ID, F.inline(F.filter(entries, lambda e: e["code"].isNotNull())))


@query("f10_collapse_categories", f"""
SELECT sales_channel, {_sales_sql()} AS sales_channel_clean, {_crm_sql('crm_package_name')} AS crm_package_clean,
       crm_package_name, count(*) AS n
FROM customer_info GROUP BY ALL""")
def f10(spark, d):
    from ceasekit.functions.categories import crm_package_clean, sales_channel_clean
    s = study(spark, d)
    return s.info.groupBy("sales_channel", sales_channel_clean().alias("sales_channel_clean"),
                          crm_package_clean().alias("crm_package_clean"), "crm_package_name") \
        .agg(F.count(F.lit(1)).alias("n"))


@query("f11_gold_dataset", "SELECT * FROM gold")
def f11(spark, d):
    return study(spark, d).gold


@query("f12_drop_redundant", f"SELECT * EXCLUDE ({', '.join(REDUNDANT_SPEED_COLUMNS)}) FROM gold")
def f12(spark, d):
    return FE.drop_redundant(study(spark, d).gold)


def _validate_sql():
    from ceasekit.config import ONE_HOT_PREFIXES
    parts = []
    for p in ONE_HOT_PREFIXES:
        cols = [c for c in GOLD_FEATURES if c.startswith(p)]
        s = " + ".join(cols)
        parts.append(f"SELECT '{p.rstrip('_')}' AS group_name, {len(cols)} AS n_columns, "
                     f"CAST(bool_and(({s}) = 1) AS INTEGER) AS all_rows_sum_to_one, "
                     f"CAST(min({s}) AS BIGINT) AS min_row_sum, CAST(max({s}) AS BIGINT) AS max_row_sum FROM gold")
    return " UNION ALL ".join(parts)


@query("f13_validate_one_hot", _validate_sql())
def f13(spark, d):
    return FE.validate_one_hot(study(spark, d).gold)


def _pairs():
    return [tuple(sorted(p)) for p in combinations(GOLD_NUMERIC, 2)]


def _corr_sql(pairs, where=""):
    items = ", ".join(f"struct_pack(a := '{a}', b := '{b}', r := corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)))"
                      for a, b in pairs)
    return f"SELECT * FROM (SELECT unnest(l, recursive := true) FROM (SELECT [{items}] AS l FROM gold)) {where}"


@query("f14_correlation_matrix", _corr_sql(_pairs()))
def f14(spark, d):
    g = study(spark, d).gold
    return _corr_spark(g)


def _corr_spark(g):
    cols = [c for c in FE.numeric_columns(g)]
    out = FE.correlation_matrix(g, cols)
    return out.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "r")


@query("f15_target_correlation", """
SELECT * FROM (SELECT unnest(l, recursive := true) FROM (SELECT [""" + ", ".join(
    f"struct_pack(feature := '{c}', r := corr(CAST(churned AS DOUBLE), CAST({c} AS DOUBLE)))"
    for c in GOLD_NUMERIC if c != "churned") + "] AS l FROM gold))")
def f15(spark, d):
    return FE.target_correlation(study(spark, d).gold, "churned")


@query("f16_redundant_pairs", _corr_sql(_pairs(), "WHERE abs(r) > 0.99"))
def f16(spark, d):
    return _corr_spark(study(spark, d).gold).where(F.abs("r") > 0.99)
