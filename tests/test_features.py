"""Feature rules: buckets, collapse maps, one-hot names, gold shape."""

import datetime as dt
import math

from pyspark.sql import functions as F

from ceasekit.functions.buckets import line_speed_bucket, ooc_bucket_columns, usage_day_columns
from ceasekit.functions.categories import clean_name, crm_package_clean, one_hot, sales_channel_clean
from ceasekit.plans import features as FE

D = dt.date


def test_ooc_buckets_null_and_nan(spark):
    vals = [(-100.5,), (-100.0,), (50.0,), (50.5,), (None,), (float("nan"),)]
    df = spark.createDataFrame(vals, "ooc_days double")
    got = [tuple(r) for r in df.select(*ooc_bucket_columns()).collect()]
    assert got == [(1, 0, 0, 0), (0, 1, 0, 0), (0, 1, 0, 0), (0, 0, 1, 0), (0, 0, 0, 1), (0, 0, 1, 0)]


def test_line_speed_buckets(spark):
    vals = [(-1.0,), (9.0,), (9.5,), (10.0,), (108.0,), (108.5,), (109.0,), (None,)]
    df = spark.createDataFrame(vals, "line_speed double")
    new = [r[0] for r in df.select(line_speed_bucket("line_speed")).collect()]
    old = [r[0] for r in df.select(line_speed_bucket("line_speed", compat=True)).collect()]
    assert new == ["Below 0", "0-9", "0-9", "10-19", "100-108", "100-108", "Over 108", "Missing"]
    assert old == ["Over 108", "0-9", "Over 108", "10-19", "100-108", "Over 108", "Over 108", "Missing"]


def test_usage_day_buckets_by_month_length(spark):
    rows = [(28, D(2023, 2, 1)), (29, D(2024, 2, 1)), (29, D(2024, 4, 1)), (30, D(2024, 4, 1)),
            (0, D(2024, 1, 1)), (17, D(2024, 1, 1)), (16, D(2024, 1, 1))]
    df = spark.createDataFrame(rows, "usage_days int, behav_win date")
    got = [tuple(r) for r in df.select(*usage_day_columns("usage_days", "behav_win")).collect()]
    assert got == [(0, 1, 0, 0), (0, 1, 0, 0), (0, 0, 1, 0), (0, 1, 0, 0), (1, 0, 0, 0), (0, 0, 1, 0), (0, 0, 0, 1)]


def test_collapse_maps(spark):
    df = spark.createDataFrame([("Other",), ("Online - Search",), ("Field",), ("Inbound",), (None,)], "sales_channel string")
    assert [r[0] for r in df.select(sales_channel_clean()).collect()] == ["Unknown", "Online - Organic", "Other",
                                                                           "Inbound", None]
    df2 = spark.createDataFrame([("Ultra Fibre Optic Broadband",), ("Faster Fibre",), ("Tiny",), (None,)], "crm_package_name string")
    assert [r[0] for r in df2.select(crm_package_clean()).collect()] == ["Ultra Fibre Optic", "Faster Fibre", "Other", "Other"]


def test_names_and_collisions(spark):
    assert clean_name("crm_package_", "Fibre 65 (FTTC-OR)", "crm") == "crm_package_fibre_65_fttc_or"
    assert clean_name("sales_channel_", "Online - Organic", "channel") == "sales_channel_online__organic"
    df = spark.createDataFrame([("A B",), ("a_b",), (None,)], "s string")
    cols = one_hot("s", ["A B", "a_b"], "x_", "status")
    out = df.select(*cols)
    assert out.columns == ["x_a_b"]
    assert [r[0] for r in out.collect()] == [1, 1, 0]



def test_categories_one_job_matches_per_group_without_a_cap(spark):
    from ceasekit.config import ChurnConfig
    rows = [(f"s{i % 3}", f"t{i % 2}", [18, 35, None][i % 3], ["Other", "Field", None][i % 3],
             ["Faster Fibre", None][i % 2]) for i in range(30)]
    df = spark.createDataFrame(rows, "contract_status string, technology string, speed int, sales_channel string, "
                                     "crm_package_name string")
    got = FE.categories(df)
    want = {g: FE.distinct_values(df, FE._source(g)) for g in FE.ONE_HOT_SPECS}
    assert got == want and got["speed"] == [18, 35]
    wide = spark.range(700).selectExpr("concat('s', id % 350) AS contract_status", "'t' AS technology", "1 AS speed",
                                       "'Field' AS sales_channel", "'x' AS crm_package_name")
    assert len(FE.categories(wide)["contract_status"]) == 350


def test_pairwise_pearson_matches_pandas(spark):
    import numpy as np
    import pandas as pd
    rng = np.random.default_rng(1)
    n = 300
    pdf = pd.DataFrame({"a": rng.normal(size=n), "b": rng.integers(0, 2, n).astype(float),
                        "c": rng.normal(size=n) * 1000 + 5e6, "k": np.ones(n)})
    pdf.loc[::7, "a"] = None
    pdf["d"] = pdf["c"] * 0.5 + rng.normal(size=n)
    df = spark.createDataFrame(pdf)
    got = {(r.a, r.b): r.r for r in FE.correlation_matrix(df, ["a", "b", "c", "d", "k"]).collect()}
    want = pdf.corr()
    for (x, y), r in got.items():
        w = want.loc[x, y]
        assert (math.isnan(r) and math.isnan(w)) if (r is not None and math.isnan(r)) or math.isnan(w) else abs(r - w) < 1e-9


def test_pairwise_pearson_many_batches_and_partitions(spark):
    import numpy as np
    import pandas as pd
    rng = np.random.default_rng(3)
    n = 2000
    pdf = pd.DataFrame({"a": rng.normal(size=n) * 1e-3 + 1e9, "b": rng.normal(size=n),
                        "k": np.full(n, 0.1), "z": rng.integers(0, 3, n).astype(float)})
    pdf["c"] = pdf["b"] * 2 + rng.normal(size=n) * 0.1
    pdf.loc[pdf.index < 500, "b"] = None          # whole batches without b
    pdf.loc[::3, "c"] = None
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        df = spark.createDataFrame(pdf).repartition(5)
        got = {(r.a, r.b): r.r for r in FE.correlation_matrix(df, list(pdf.columns)).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    from fractions import Fraction

    def exact(x, y):                 # rational arithmetic: column a defeats pandas' float centering
        m = pdf[x].notna() & pdf[y].notna()
        xs, ys = [Fraction(v) for v in pdf[x][m]], [Fraction(v) for v in pdf[y][m]]
        mx, my = sum(xs) / len(xs), sum(ys) / len(ys)
        sxx, syy = sum((a - mx) ** 2 for a in xs), sum((b - my) ** 2 for b in ys)
        if sxx == 0 or syy == 0:
            return float("nan")
        return float(sum((a - mx) * (b - my) for a, b in zip(xs, ys))) / math.sqrt(float(sxx) * float(syy))

    assert len(got) == 10
    for (x, y), r in got.items():
        w = exact(x, y)
        if math.isnan(w):
            assert math.isnan(r), (x, y, r)
        else:
            assert abs(r - w) < 1e-12, (x, y, r, w)
