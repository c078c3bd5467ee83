"""Observation set on golden mini-tables (edge cases of the silver rules)."""

import datetime as dt

from pyspark.sql import functions as F

from ceasekit.config import ChurnConfig
from ceasekit.plans import observation as OB

D = dt.date
CFG = ChurnConfig()
ID = CFG.id_col

CEASE = [("c1", D(2024, 3, 15), None, "A"), ("c1", D(2024, 3, 20), None, "B"), ("c1", D(2024, 6, 1), None, "C"),
         ("c2", D(2024, 1, 10), None, "Bereavement"), ("c2", D(2024, 5, 10), None, "Price"),
         ("c3", D(2024, 2, 5), None, None), ("c4", D(2024, 2, 10), D(2024, 3, 10), "Price")]


def _info(spark):
    rows = []
    for cid, first, last in [("c1", 1, 8), ("c2", 1, 8), ("c3", 1, 8), ("c4", 2, 8), ("c5", 1, 8), ("c6", 1, 7)]:
        for m in range(first, last + 1):
            rows.append((cid, D(2024, m, 1), "Active", 0, 0, float(m * 10 - 120), "FTTC", 40, 9.5, "Field",
                         "Faster Fibre", m * 30))
    return spark.createDataFrame(rows, f"{ID} string, datevalue date, contract_status string, contract_dd_cancels int, "
                                       "dd_cancel_60_day int, ooc_days double, technology string, speed int, "
                                       "line_speed double, sales_channel string, crm_package_name string, tenure_days int")


def _cease(spark):
    return spark.createDataFrame(CEASE, f"{ID} string, cease_placed_date date, cease_completed_date date, "
                                        "reason_description_insight string")


def ids(df):
    return sorted(r[0] for r in df.select(ID).collect())


def test_live_rules(spark):
    info, cease = _info(spark), _cease(spark)
    assert ids(OB.never_churned(info, cease)) == ["c5", "c6"]
    assert ids(OB.complete_to_end(info, cease)) == ["c5"]          # c6 ends before the last month
    months = sorted(r.datevalue.month for r in OB.eligible_months(info, cease).collect())
    assert months == [1, 2, 3, 4, 5]                                # 3-month buffer before 2024-08
    s = OB.sample_month(info, cease).collect()
    assert len(s) == 1 and s[0].behav_win <= D(2024, 5, 1)


def test_sample_is_repeatable_across_partitioning(spark):
    info, cease = _info(spark), _cease(spark)
    a = OB.sample_month(info.repartition(1), cease).collect()
    b = OB.sample_month(info.repartition(7, "datevalue"), cease).collect()
    assert a == b


def test_churned_rules(spark):
    info, cease = _info(spark), _cease(spark)
    base = {(r[ID], r.behav_win): r.reason_description_insight
            for r in OB.churned_baseline(info, cease).collect()}
    # two ceases in March -> one row, the smaller reason; c2's January cease has no
    # December snapshot; c4 has no January snapshot
    assert base[("c1", D(2024, 2, 1))] == "A"
    assert ("c2", D(2023, 12, 1)) not in base
    assert not any(k[0] == "c4" for k in base)
    kept = {r[ID]: r.behav_win for r in OB.churned_kept(info, cease, CFG).collect()}
    assert kept == {"c1": D(2024, 2, 1), "c2": D(2024, 4, 1)}      # c3: first month and null reason


def test_reasons_filtered_before_dedup(spark):
    info = _info(spark)
    cease = spark.createDataFrame([("c1", D(2024, 3, 1), None, "HomeMove"), ("c1", D(2024, 6, 1), None, "Price")],
                                  f"{ID} string, cease_placed_date date, cease_completed_date date, "
                                  "reason_description_insight string")
    kept = OB.churned_kept(info, cease, CFG).collect()
    assert [(r[ID], r.behav_win) for r in kept] == [("c1", D(2024, 5, 1))]


def test_observation_set_shape(spark):
    info, cease = _info(spark), _cease(spark)
    obs = OB.observation_set(info, cease, CFG)
    assert obs.columns == CFG.silver_columns
    rows = obs.collect()
    assert sorted((r[ID], r.churned) for r in rows) == [("c1", 1), ("c2", 1), ("c5", 0)]
    assert obs.groupBy(ID).count().where("count > 1").count() == 0
    f = OB.filter_churned(obs, cease, CFG)
    assert ids(f) == ["c1", "c2", "c5"]


def test_usage_in_obs_month(spark):
    info, cease = _info(spark), _cease(spark)
    obs = OB.observation_set(info, cease, CFG)
    usage = spark.createDataFrame([("c1", D(2024, 2, 3), 1.0, 1.0), ("c1", D(2024, 3, 1), 1.0, 1.0),
                                   ("c2", D(2024, 4, 30), 2.0, 2.0), ("c9", D(2024, 4, 1), 1.0, 1.0)],
                                  f"{ID} string, calendar_date date, usage_download_mbs double, usage_upload_mbs double")
    got = sorted((r[ID], r.calendar_date) for r in OB.usage_in_obs_month(usage, obs, CFG).collect())
    assert got == [("c1", D(2024, 2, 3)), ("c2", D(2024, 4, 30))]
