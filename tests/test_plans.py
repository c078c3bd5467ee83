"""Physical-plan shape: the properties the scale design depends on.

Checked on the executed (AQE-final) or planned physical plan text, so a change
that silently reintroduces a single-task hot spot, a row-at-a-time Python UDF or
an unpruned scan fails here rather than at 100x the data.
"""

import re

import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as E
from ceasekit.operators.ranking import auc
from ceasekit.operators.relational import keep_first, same_month_join
from ceasekit.plans import features as FE
from ceasekit.plans import observation as OB
from ceasekit.plans import profiles as PR
from ceasekit.sources import fixtures as FX

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _lines_below(txt: str, pattern: str) -> list[str]:
    lines = txt.split("\n")
    i = next(k for k, line in enumerate(lines) if re.search(pattern, line))
    return lines[i + 1:]


def test_keep_first_limits_before_shuffle(spark):
    df = spark.createDataFrame([("a", 3), ("a", 1), ("b", 2)] * 50, "k string, v int")
    txt = _plan(keep_first(df, "k", "v"))
    below = "\n".join(_lines_below(txt, r"Exchange hashpartitioning"))
    assert "WindowGroupLimit" in below and "Partial" in below, txt


def test_auc_aggregates_before_range_exchange(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"s": rng.integers(0, 5, 500) / 5.0, "y": rng.integers(0, 2, 500)})
    txt = _plan(auc(spark.createDataFrame(pdf), "s", "y"))
    below = "\n".join(_lines_below(txt, r"Exchange rangepartitioning"))
    assert re.search(r"HashAggregate\(keys=\[(_s|_groupingexpression)", below), txt
    assert "partial_sum" in below and "BatchEvalPython" not in txt


def test_same_month_join_uses_both_keys(spark):
    calls = FX.calls(spark, SF)
    obs = FX.observation_b(spark, SF).select(FX.ID, "behav_win")
    txt = _plan(same_month_join(calls, obs, FX.ID, "event_date", "behav_win"))
    m = re.search(r"(SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin) \[([^\]]*)\]", txt)
    assert m and "unique_customer_identifier" in m.group(2) and "_m" in m.group(2), txt


def test_fixture_scan_prunes_columns_and_pushes_filter(spark):
    txt = FX.calls(spark, SF)._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in txt.split("\n") if "FileScan parquet" in line)
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,O)]" in scan, scan
    schema = re.search(r"ReadSchema: struct<([^>]*)>", scan).group(1)
    assert set(f.split(":")[0] for f in schema.split(",")) == {"o_custkey", "o_orderstatus", "o_orderdate"}


BAD = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")
PLAN_ONLY_SKIP = ("m6_", "m7_", "m8_", "m9_model", "m10_model", "m11_", "m12_", "m13_", "p7_", "p8_", "p11_", "st1_",
                  "s3_", "s7_", "s8_")


@pytest.mark.parametrize("prefix", ["d", "f", "p", "q", "j", "a", "w", "o", "u", "e", "m", "s"])
def test_no_cross_product_or_row_udf(spark, prefix):
    # the driver-style registry over the smallest data; model fits and writers are skipped (they execute)
    bad = {}
    for name, fn in E.queries().items():
        if not name.startswith(prefix) or name.startswith(PLAN_ONLY_SKIP):
            continue
        txt = fn(spark, SF)._jdf.queryExecution().executedPlan().toString()
        hits = [b for b in BAD if b in txt]
        if hits:
            bad[name] = hits
    assert not bad, bad


def test_builders_on_unlanded_inputs(spark):
    # the registry reads landed layers; here the whole plan from the raw tables is seen
    cfg = FX.FIXTURE_CONFIG
    info, cease, usage, calls = (f(spark, SF) for f in (FX.customer_info, FX.cease, FX.usage, FX.calls))
    raw = OB.observation_set(info, cease, cfg)
    month = OB.usage_in_obs_month(usage, raw, cfg)
    built = {"observation_set": raw, "usage_month": month, "gold": FE.gold_dataset(raw, month, calls, cfg),
             "rates": PR.rate_by_category(raw, "contract_status", cfg), "usage_rates": PR.rate_by_usage_bucket(raw, month, cfg)}
    for name, df in built.items():
        txt = _plan(df)
        assert "FileScan parquet" in txt and not [b for b in BAD if b in txt], (name, txt)


@pytest.mark.parametrize("name", ["j1_inner_join_bucketed", "q10_usage_to_event_gap_bucketed", "f7_usage_days_features_bucketed"])
def test_bucketed_usage_is_not_shuffled(spark, name):
    """With joins by sorting, as for large tables: no exchange above the bucketed scan, up to and with its join or group."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = _plan(E.queries()[name](spark, SF)).split("\n")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    at = next(k for k, line in enumerate(lines) if "FileScan" in line and "usage_daily" in line)
    depth = lambda line: len(re.match(r"[\s:|+\-]*", line).group())
    above, level = [], depth(lines[at])
    for line in reversed(lines[:at]):
        if depth(line) < level:
            above.append(line)
            level = depth(line)
    join = next(line for line in above if "Join" in line)
    below_join = above[:above.index(join)]
    assert "Bucketed: true" in lines[at] and not any("Exchange" in line for line in below_join), "\n".join(lines)
