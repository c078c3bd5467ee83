"""Checked CSV scan, deduplicated rewrite of plain and partitioned tables, normal equations of a fit."""

import numpy as np
from pyspark.sql.types import DateType, IntegerType, StringType, StructField, StructType

from ceasekit.plans.fits import normal_equations
from ceasekit.sources import io as IO


def test_csv_counts_what_does_not_convert(spark):
    path = IO.scratch_path(spark, "odd-csv")
    spark.createDataFrame([("a", "1", "2024-01-31"), ("b", "x", "2024-02-30"), ("c", None, None)], "id string, n string, day string") \
        .write.option("header", True).csv(path)
    schema = StructType([StructField("id", StringType()), StructField("n", IntegerType()), StructField("day", DateType())])
    rows, report = IO.read_csv_checked(spark, path, schema)
    assert rows.schema == schema and rows.where("n IS NULL").count() == 2 and rows.count() == 3
    assert {r.column_name: r.rejected for r in report.collect()} == {"id": 0, "n": 1, "day": 1}


def test_rewrite_keeps_partitioning_and_first_rows(spark):
    IO.create_namespace(spark, "ceasekit_test")
    df = spark.createDataFrame([(1, 2, "x"), (1, 1, "y"), (2, 5, "x")], "id int, n int, p string")
    for name, parts in (("plain", []), ("parted", ["p"])):
        full, root = f"ceasekit_test.{name}", IO.scratch_path(spark, name)
        IO.drop_table(spark, full)
        IO.write_table(df, full, f"{root}/v-0", partition_by=parts)
        for _ in range(2):                       # a second rewrite changes nothing
            out = IO.rewrite_deduplicated(spark, full, "id", "n", root)
            assert sorted((r.id, r.n, r.p) for r in out.collect()) == [(1, 1, "y"), (2, 5, "x")]
        assert [c.name for c in spark.catalog.listColumns(full) if c.isPartition] == parts
        assert sum(t.name.startswith(name) for t in spark.catalog.listTables("ceasekit_test")) == 1
        IO.drop_table(spark, full)


def test_normal_equations_against_numpy(spark):
    rng = np.random.default_rng(4)
    x, w = np.arange(30.0), rng.integers(1, 9, 30)
    y = 1 + 0.1 * x + rng.normal(size=30)
    points = spark.createDataFrame([(float(a), float(b), int(c)) for a, b, c in zip(x, y, w)], "x double, y double, n long")
    got = normal_equations(points, "x", "y", 3, weight="n").orderBy("power").collect()
    assert [r.power for r in got] == [0, 1, 2, 3] and all(r.n_points == 30 and r.weight == w.sum() and r.residual < 1e-9 for r in got)
