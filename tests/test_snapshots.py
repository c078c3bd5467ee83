"""The monthly snapshots: dealt by customer before they are made, read in buckets afterwards, right with repeated customers."""

import pytest

from ceasekit.catalog import study as ST
from ceasekit.plans import observation as OB
from ceasekit.plans import quality as Q
from ceasekit.sources import fixtures as FX
from tests.oracle_check import compare
from tests.study_rows import write_study

ID = "unique_customer_identifier"


@pytest.fixture(scope="module")
def sf(tmp_path_factory):
    return write_study(tmp_path_factory.mktemp("study"), doubled=9)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _above(txt: str, node: str) -> str:
    lines = txt.split("\n")
    return "\n".join(lines[:next(i for i, line in enumerate(lines) if node in line)])


def test_customers_are_dealt_before_they_become_snapshots(spark, sf):
    txt = _plan(FX.customer_info(spark, sf, 6))
    assert "Exchange" not in _above(txt, "Generate") and "REPARTITION_BY_NUM" in txt, txt
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(FX.customer_info(spark, sf, 6)) == rows(FX.customer_info(spark, sf))


def test_snapshots_are_neither_shuffled_nor_sorted(spark, sf):
    s = ST.study(spark, sf)
    for df in (OB.live_baseline(s.info, s.cease, s.cfg), OB.churned_baseline(s.info, s.cease, s.cfg), OB.eligible_months(s.info, s.cease, s.cfg)):
        txt = _plan(df)
        scans = [i for i, line in enumerate(txt.split("\n")) if "FileScan" in line and "datevalue" in line]
        assert scans and "Bucketed: true" in txt and "SortMergeJoin" not in txt and "ShuffledHashJoin" in txt, txt
    single = _plan(s.info.groupBy(ID).count())
    assert "Exchange hashpartitioning" not in single, single


def test_repeated_customers_keep_their_rows(spark, sf):
    for name in ("d3_eligible_months", "d5_live_baseline", "d8_churned_baseline", "d12_observation_set", "d20_stage_counts"):
        assert all(v == "OK" for v in compare(spark, sf, [name], verbose=False).values()), name


def test_number_of_buckets_grows_with_the_customers(spark, tmp_path, monkeypatch):
    sf = write_study(tmp_path, customers=80)
    monkeypatch.setattr(ST, "CUSTOMERS_PER_BUCKET", 3)
    assert ST.Study(spark, sf).info.rdd.getNumPartitions() > 0
    wanted = ST.Study(spark, sf).info.groupBy(ID).count()
    assert "SelectedBucketsCount: 27 out of 27" in _plan(wanted), _plan(wanted)


def test_missing_in_other_ships_each_key_once_per_task(spark):
    a = spark.createDataFrame([("a",), ("b",), (None,), ("a",)], f"{ID} string")
    b = spark.createDataFrame([("b",)] * 300 + [(None,)], f"{ID} string").repartition(3)
    got = Q.missing_in_other(a, b, ID)
    assert sorted(r[0] or "" for r in got.collect()) == ["", "a"]
    txt = _plan(got)
    assert txt.count("HashAggregate") >= 4 or txt.count("hashpartitioning") == txt.count("HashAggregate") // 2, txt
