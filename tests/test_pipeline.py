"""Medallion run end to end, written layers read back, and incremental landing."""

from pyspark.sql import functions as F

from ceasekit.catalog.study import study
from ceasekit.plans.pipeline import run_medallion
from ceasekit.sources.io import scratch_path
from ceasekit.sources.fixtures import FIXTURE_CONFIG
from ceasekit.streaming.ingest import land_files

SF = "/root/testdata/sf0.001"


def test_medallion(spark):
    s = study(spark, SF)
    raw = {"cease": s.cease, "customer_info": s.info, "calls": s.calls, "usage": s.usage}
    out = run_medallion(spark, raw, scratch_path(spark, "medallion"), FIXTURE_CONFIG, prefix="t")
    gold = out["gold.modeling_dataset"]
    assert gold.count() == out["silver.raw_info"].count() > 0
    assert gold.groupBy("unique_customer_identifier").count().where("count > 1").count() == 0
    assert "package_speed_18" not in out["gold.modeling_dataset_reduced"].columns
    audit = {r.stage: r.n for r in out["audit"].collect()}
    assert audit["bronze.cease"] == s.cease.count()


def test_incremental_landing_adds_only_new_files(spark):
    s = study(spark, SF)
    src, tgt, ck = (scratch_path(spark, n) for n in ("src", "tgt", "ck"))
    s.cease.where(F.col("cease_placed_date") < "1998-01-01").write.mode("append").parquet(src)
    land_files(spark, src, s.cease.schema, tgt, ck)
    first = spark.read.parquet(tgt).count()
    s.cease.where(F.col("cease_placed_date") >= "1998-01-01").write.mode("append").parquet(src)
    land_files(spark, src, s.cease.schema, tgt, ck)
    assert spark.read.parquet(tgt).count() == s.cease.count() >= first
