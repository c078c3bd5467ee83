"""Registered queries: derived inputs and the silver observation set."""

from __future__ import annotations

from pyspark.sql import functions as F

from ceasekit.catalog import query
from ceasekit.catalog.study import study
from ceasekit.plans import observation as OB
from ceasekit.plans.quality import StageAudit
from ceasekit.sources.io import scratch_path

SILVER_COLS = ("unique_customer_identifier, behav_win, churned, contract_status, contract_dd_cancels, "
               "dd_cancel_60_day, ooc_days, technology, speed, line_speed, sales_channel, crm_package_name, tenure_days")


@query("s0_cease", "SELECT * FROM cease")
def s0_cease(spark, d):
    return study(spark, d).cease


@query("s0_customer_info", "SELECT * FROM customer_info")
def s0_customer_info(spark, d):
    return study(spark, d).info


@query("s0_calls", "SELECT * FROM calls")
def s0_calls(spark, d):
    return study(spark, d).calls


@query("s0_usage", "SELECT * FROM usage")
def s0_usage(spark, d):
    return study(spark, d).usage


@query("s0_usage_b", "SELECT * FROM usage_b")
def s0_usage_b(spark, d):
    return study(spark, d).usage_b


@query("s0_obs_b", "SELECT * FROM obs_b")
def s0_obs_b(spark, d):
    return study(spark, d).obs_b


@query("d1_never_churned", """
SELECT DISTINCT unique_customer_identifier FROM customer_info
WHERE unique_customer_identifier NOT IN (SELECT unique_customer_identifier FROM cease)""")
def d1(spark, d):
    s = study(spark, d)
    return OB.never_churned(s.info, s.cease, s.cfg)


@query("d2_complete_to_end", "SELECT * FROM live_ids")
def d2(spark, d):
    s = study(spark, d)
    return OB.complete_to_end(s.info, s.cease, s.cfg)


@query("d3_eligible_months", "SELECT * FROM eligible")
def d3(spark, d):
    s = study(spark, d)
    return OB.eligible_months(s.info, s.cease, s.cfg)


@query("d4_sample_month", "SELECT * FROM sampled")
def d4(spark, d):
    s = study(spark, d)
    return OB.sample_month(s.info, s.cease, s.cfg)


@query("d5_live_baseline", "SELECT * FROM live_baseline")
def d5(spark, d):
    s = study(spark, d)
    return OB.live_baseline(s.info, s.cease, s.cfg)


@query("d6_churn_observation_month", "SELECT * FROM churn_months")
def d6(spark, d):
    s = study(spark, d)
    return OB.churn_observation_month(s.cease, s.cfg)


@query("d7_reason_per_month", "SELECT * FROM churn_reason")
def d7(spark, d):
    s = study(spark, d)
    return OB.reason_per_month(s.cease, s.cfg)


@query("d8_churned_baseline", "SELECT * FROM churned_baseline")
def d8(spark, d):
    s = study(spark, d)
    return OB.churned_baseline(s.info, s.cease, s.cfg)


@query("d9_exclude_first_month", """
SELECT * FROM churned_baseline WHERE behav_win <> (SELECT min_month FROM info_scalars)""")
def d9(spark, d):
    s = study(spark, d)
    return OB.exclude_first_month(OB.churned_baseline(s.info, s.cease, s.cfg), s.info, s.cfg)


@query("d10_exclude_reasons", """
SELECT * FROM churned_baseline WHERE reason_description_insight NOT IN ('1-URGENT', '2-HIGH')""")
def d10(spark, d):
    s = study(spark, d)
    return OB.exclude_reasons(OB.churned_baseline(s.info, s.cease, s.cfg), s.cfg)


@query("d11_dedup_earliest", """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY unique_customer_identifier
  ORDER BY behav_win, reason_description_insight NULLS FIRST) AS rn FROM churned_baseline) WHERE rn = 1""")
def d11(spark, d):
    s = study(spark, d)
    return OB.dedup_earliest(OB.churned_baseline(s.info, s.cease, s.cfg), s.cfg)


@query("d12_observation_set", "SELECT * FROM raw_info")
def d12(spark, d):
    return study(spark, d).raw_info_plan


@query("d13_filter_churned", f"""
SELECT {SILVER_COLS} FROM (
  SELECT r.*, row_number() OVER (PARTITION BY r.unique_customer_identifier ORDER BY r.behav_win) AS rn
  FROM raw_info r LEFT JOIN cease c USING (unique_customer_identifier)
  WHERE r.churned = 0 OR (r.churned = 1 AND c.reason_description_insight IS NOT NULL
                          AND c.reason_description_insight NOT IN ('1-URGENT', '2-HIGH'))) WHERE rn = 1""")
def d13(spark, d):
    s = study(spark, d)
    return OB.filter_churned(s.raw_info, s.cease, s.cfg)


@query("d14_usage_in_obs_month", "SELECT * FROM usage_behav_month")
def d14(spark, d):
    return study(spark, d).usage_behav_month


@query("d20_stage_counts", """
SELECT 'live' AS stage, count(*) AS n FROM live_baseline
UNION ALL SELECT 'churned', count(*) FROM churned_baseline
UNION ALL SELECT 'churned_kept', count(*) FROM churned_kept
UNION ALL SELECT 'observation_set', count(*) FROM raw_info""")
def d20(spark, d):
    """All four counts from the one pass that writes the observation set."""
    s, audit = study(spark, d), StageAudit()
    OB.observation_set(s.info, s.cease, s.cfg, audit.watch).write.parquet(scratch_path(spark, "audited-raw-info"))
    return audit.report(spark)
