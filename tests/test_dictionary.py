"""Category codes and sparse one-hot vectors for many categories, against plain Python."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ceasekit.operators.dictionary import category_codes, one_hot_vectors, with_codes
from ceasekit.operators.prefix import landed
from ceasekit.plans import features as FE


def test_two_hundred_thousand_categories(spark):
    """One value holds a third of the rows; no value reaches the driver on the way."""
    n = 200_000
    name = F.concat(F.lit("c"), F.col("id").cast("string"))
    rows = spark.range(n).select("id", name.alias("a"), (F.col("id") % 3).alias("b"))
    rows = rows.unionByName(spark.range(n, n + n // 2).select("id", F.lit("c7").alias("a"), F.lit(None).cast("long").alias("b")))
    groups = {"a": F.col("a"), "b": F.col("b")}
    codes = landed(category_codes(rows, groups), "test-codes")
    assert codes.where("category_group = 'a'").count() == n
    a = {r.value: r.code for r in codes.where("category_group = 'a' AND code % 20011 = 5").collect()}
    order = sorted(f"c{i}" for i in range(n))
    assert a and all(order[c] == v for v, c in a.items())
    assert {r.value: r.code for r in codes.where("category_group = 'b'").collect()} == {"0": 0, "1": 1, "2": 2}
    out = one_hot_vectors(with_codes(rows, groups, codes), ["a", "b"], codes)
    whole = FE.assembled(out.withColumn("x", F.lit(2.5)), ["x"], ["a", "b"])
    where = {v: i for i, v in enumerate(order)}
    for r in whole.where("id % 9973 = 7 OR id = 200001").collect():
        v = r.features
        assert v.size == 1 + n + 3 and r.a_vector.size == n and v.indices[0] == 0 and v.values[0] == 2.5
        want = [0, 1 + where[r.a]] + ([] if r.b is None else [1 + n + r.b])
        assert v.indices.tolist() == want and np.allclose(v.values[1:], 1)
    assert out.count() == n + n // 2


def test_nulls_empty_and_clean_names(spark):
    rows = spark.createDataFrame([(1, "A b", None), (2, "a_B", None), (3, None, None)], "id long, contract_status string, technology string")
    names = FE.category_names(["contract_status", "technology"])
    codes = category_codes(rows, names)
    assert [(r.category_group, r.value, r.code) for r in codes.collect()] == [("contract_status", "contract_status_a_b", 0)]
    out = one_hot_vectors(with_codes(rows, names, codes), list(names), codes).orderBy("id").collect()
    assert [r.contract_status_vector.toArray().tolist() for r in out] == [[1.0], [1.0], [0.0]]
    assert all(r.technology_code is None and r.technology_vector.numNonzeros() == 0 for r in out)
    assert category_codes(rows.where("id < 0"), names).count() == 0


def test_wide_form_refuses_more_than_it_can_hold(spark, monkeypatch):
    rows = spark.range(20).select(F.col("id").cast("string").alias("v"))
    monkeypatch.setattr(FE, "WIDE_VALUES", 20)
    assert len(FE.distinct_values(rows, F.col("v"))) == 20
    monkeypatch.setattr(FE, "WIDE_VALUES", 19)
    with pytest.raises(ValueError):
        FE.distinct_values(rows, F.col("v"))
