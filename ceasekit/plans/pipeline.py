"""The medallion run: bronze -> silver -> gold, each layer a written table.

Every layer is read back from storage before the next one is built, which cuts
lineage (a lost executor recomputes from the last written layer, not from the
raw files) and lets the many small audits scan a compact table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ceasekit.config import ChurnConfig
from ceasekit.plans import features as FE
from ceasekit.plans import observation as OB
from ceasekit.plans import quality as Q
from ceasekit.sources.io import create_namespace, table_format, write_table


def run_medallion(spark: SparkSession, raw: dict[str, DataFrame], root: str, cfg: ChurnConfig = ChurnConfig(),
                  prefix: str = "churn") -> dict[str, DataFrame]:
    """Land ``raw`` (cease, customer_info, calls, usage), build silver and gold.

    Usage in the observation month is stored partitioned by that month, so a
    later per-month read prunes files.
    """
    fmt = table_format(spark)
    for layer in ("bronze", "silver", "gold"):
        create_namespace(spark, f"{prefix}_{layer}")
    root = root.rstrip("/")
    out, audit = {}, Q.StageAudit()

    def write(name: str, df: DataFrame, path: str, **kw) -> DataFrame:
        """Written and counted in one pass."""
        return write_table(audit.watch(name, df), f"{prefix}_{name}", f"{root}/{path}", fmt, **kw)

    for name, df in raw.items():
        out[f"bronze.{name}"] = write(f"bronze.{name}", df, f"bronze/{name}")
    info, cease = out["bronze.customer_info"], out["bronze.cease"]
    raw_info = write("silver.raw_info", OB.observation_set(info, cease, cfg), "silver/raw_info")
    ubm = write("silver.usage_behav_month", OB.usage_in_obs_month(out["bronze.usage"], raw_info, cfg), "silver/usage_behav_month",
                partition_by=[cfg.behav_col])
    gold = write("gold.modeling_dataset", FE.gold_dataset(raw_info, ubm, out["bronze.calls"], cfg), "gold/modeling_dataset")
    reduced = write("gold.modeling_dataset_reduced", FE.drop_redundant(gold), "gold/modeling_dataset_reduced")
    out.update({"silver.raw_info": raw_info, "silver.usage_behav_month": ubm, "gold.modeling_dataset": gold,
                "gold.modeling_dataset_reduced": reduced})
    out["audit"] = audit.report(spark)
    return out
