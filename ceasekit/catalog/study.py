"""The derived study tables of one test-data directory, built lazily on Spark.

Derived inputs (bronze), silver and gold are written as parquet under the
session's shared checkpoint folder and read back, once per session and
directory, so the many small profile queries do not recompute the whole
lineage; the written table also cuts lineage for recovery.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ceasekit.plans import features as FE
from ceasekit.plans import observation as OB
from ceasekit.sources import fixtures as FX

CFG = FX.FIXTURE_CONFIG
BUCKETS = 16            # of the daily usage; on a cluster about its size / 256 MB
CUSTOMERS_PER_BUCKET = 10_000       # of the monthly snapshots: under a million rows, which one task sorts or groups in memory
_MEMO: dict = {}
_BRONZE: dict = {}


def bronze(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """Derived input table ``name``, landed once per session as parquet under the
    checkpoint folder (the bronze layer) and read from there afterwards."""
    from ceasekit.sources.io import scratch_path
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _BRONZE:
        path = scratch_path(spark, f"bronze-{name}")
        df = build(spark, sf_dir)
        # files clustered by customer; ``rebalance`` lets AQE size the partitions
        # (advisory bytes) and split a hot customer over several files
        df.hint("rebalance", CFG.id_col).write.mode("overwrite").parquet(path)
        _BRONZE[key] = path
    return spark.read.parquet(_BRONZE[key])


def bucketed_bronze(spark: SparkSession, sf_dir: str, name: str, build, buckets: int) -> DataFrame:
    """Like :func:`bronze`, as a table in buckets of the customer: joins and groups by customer do not shuffle it.
    ``build`` is given the number of buckets and deals its rows over them."""
    from ceasekit.sources.io import create_namespace, scratch_path, write_table
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _BRONZE:
        path = scratch_path(spark, f"bronze-{name}")
        create_namespace(spark, "ceasekit_bronze")
        table = f"ceasekit_bronze.{name}_{path[-12:]}"
        write_table(build(spark, sf_dir, buckets), table, path, bucket_by=(buckets, CFG.id_col), dealt=True)
        _BRONZE[key] = table
    return spark.table(_BRONZE[key])


class Study:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self.cfg = spark, sf_dir, CFG

    def table(self, name: str) -> DataFrame:
        return FX.table(self.spark, self.sf_dir, name)

    @cached_property
    def cease(self) -> DataFrame:
        return bronze(self.spark, self.sf_dir, "cease", FX.cease)

    @cached_property
    def info(self) -> DataFrame:
        buckets = max(BUCKETS, -(-self.table("customer").count() // CUSTOMERS_PER_BUCKET))
        return bucketed_bronze(self.spark, self.sf_dir, "customer_info", FX.customer_info, buckets)

    @cached_property
    def calls(self) -> DataFrame:
        return bronze(self.spark, self.sf_dir, "calls", FX.calls)

    @cached_property
    def usage(self) -> DataFrame:
        return bronze(self.spark, self.sf_dir, "usage", FX.usage)

    @cached_property
    def usage_daily(self) -> DataFrame:
        """Usage per customer and day, in buckets of the customer: read by key without a shuffle."""
        from ceasekit.plans.quality import daily_usage
        from ceasekit.sources.io import create_namespace, scratch_path, write_table
        create_namespace(self.spark, "ceasekit_silver")
        path = scratch_path(self.spark, "usage-daily")
        daily = daily_usage(self.usage, self.cfg.id_col, self.cfg.usage_date_col, [self.cfg.download_col, self.cfg.upload_col])
        return write_table(daily, f"ceasekit_silver.usage_daily_{path[-12:]}", path, bucket_by=(BUCKETS, self.cfg.id_col))

    @cached_property
    def obs_b(self) -> DataFrame:
        return bronze(self.spark, self.sf_dir, "observation_b", FX.observation_b)

    @cached_property
    def usage_b(self) -> DataFrame:
        return bronze(self.spark, self.sf_dir, "usage_b", FX.usage_b)

    @cached_property
    def raw_info_plan(self) -> DataFrame:
        return OB.observation_set(self.info, self.cease, self.cfg)

    def _landed(self, name: str, df: DataFrame) -> DataFrame:
        """Write ``df`` once as parquet under the shared checkpoint folder and read it
        back: one computation, lineage cut (``checkpoint()`` would compute twice)."""
        from ceasekit.sources.io import scratch_path
        path = scratch_path(self.spark, name)
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    @cached_property
    def raw_info(self) -> DataFrame:
        return self._landed("silver-raw-info", self.raw_info_plan)

    @cached_property
    def usage_behav_month(self) -> DataFrame:
        return self._landed("silver-usage-month", OB.usage_in_obs_month(self.usage, self.raw_info, self.cfg))

    @cached_property
    def gold(self) -> DataFrame:
        g = FE.gold_dataset(self.raw_info, self.usage_behav_month, self.calls, self.cfg)
        return self._landed("gold", g)


def study(spark: SparkSession, sf_dir: str) -> Study:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _MEMO:
        _MEMO[key] = Study(spark, sf_dir)
    return _MEMO[key]


def reset() -> None:
    _MEMO.clear()
