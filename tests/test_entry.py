"""Driver contract and a sample of engine-against-engine checks."""

import re

import pytest

import __spark_entry__ as E
from tests.oracle_check import compare


def test_registry_consistent():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    named = {i for n in q for i in re.findall(r"(?:^|(?<=_))[a-z]\d+(?=_)", n)}
    sizes = {"s": 13, "e": 19, "j": 9, "a": 14, "w": 4, "o": 3, "u": 2, "q": 20, "d": 14, "f": 16, "p": 16, "m": 13}
    assert not {f"{k}{i}" for k, n in sizes.items() for i in range(1, n + 1)} - named
    assert len({id(f) for f in q.values()}) >= len(q) - 8        # few queries under two names


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert set(df.columns) == {"contract_status", "total_customers", "churn_rate", "pct_of_total"}


@pytest.mark.parametrize("name", ["d12_observation_set", "q6_grain_check", "f11_gold_dataset",
                                  "p6_min_size_buckets_40", "p15_rate_by_download_decile", "m9_auc",
                                  "m10_classification_report", "s10_random_sample"])
def test_oracle_sample(spark, name):
    res = compare(spark, "/root/testdata/sf0.01", [name], verbose=False)
    assert res and all(v == "OK" for v in res.values()), res
