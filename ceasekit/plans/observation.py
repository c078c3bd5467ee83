"""Silver observation set: one row per customer at its observation month.

Live customers get a reproducible random eligible month; churned customers the
month before their cease month. Every step is lazy; global scalars (first and
last snapshot month) are scalar subqueries, not driver round trips.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ceasekit.config import ChurnConfig
from ceasekit.functions.dates import month_shift, month_start
from ceasekit.functions.keys import order_key
from ceasekit.operators.relational import keep_first, same_month_join, union_aligned

DEFAULT = ChurnConfig()


def _attrs(info: DataFrame, cfg: ChurnConfig) -> list[str]:
    return [c for c in info.columns if c not in (cfg.id_col, cfg.month_col)]


def max_month(info: DataFrame, cfg: ChurnConfig = DEFAULT):
    """Last snapshot month of the whole table, as a scalar subquery Column."""
    return info.select(F.max(cfg.month_col)).scalar()


def _unwatched(name: str, df: DataFrame) -> DataFrame:
    return df


def min_month(info: DataFrame, cfg: ChurnConfig = DEFAULT):
    return info.select(F.min(cfg.month_col)).scalar()


def never_churned(info: DataFrame, cease: DataFrame, cfg: ChurnConfig = DEFAULT) -> DataFrame:
    """Distinct customer ids of the snapshots without any cease request."""
    return info.select(cfg.id_col).distinct().join(cease.select(cfg.id_col), cfg.id_col, "left_anti")


def complete_to_end(info: DataFrame, cease: DataFrame, cfg: ChurnConfig = DEFAULT) -> DataFrame:
    """Never-churned customers whose last snapshot is the last month in the data."""
    last = info.groupBy(cfg.id_col).agg(F.max(cfg.month_col).alias("last_customer_month"))
    return (last.join(cease.select(cfg.id_col), cfg.id_col, "left_anti")
            .where(F.col("last_customer_month") == max_month(info, cfg)))


def eligible_months(info: DataFrame, cease: DataFrame, cfg: ChurnConfig = DEFAULT) -> DataFrame:
    """D3: distinct (id, month) of live complete customers, at least ``buffer_months``
    before the last month."""
    live = complete_to_end(info, cease, cfg).select(cfg.id_col)
    cutoff = month_shift(max_month(info, cfg), -cfg.buffer_months)
    return (info.where(F.col(cfg.month_col) <= cutoff).select(cfg.id_col, cfg.month_col)
            .join(live.hint("shuffle_hash"), cfg.id_col, "left_semi").distinct())


def sample_month(info: DataFrame, cease: DataFrame, cfg: ChurnConfig = DEFAULT) -> DataFrame:
    """One eligible month per live customer, chosen by a seeded md5 order key.

    One aggregate over the snapshots gives both the customer's last month and the
    sampled month (``min_by`` with the key; months after the cutoff get a null key
    and are skipped); the aggregate is partial, so it ships one row per customer
    and map task, whatever the key distribution.
    """
    mm = max_month(info, cfg)
    cutoff = month_shift(mm, -cfg.buffer_months)
    m = F.col(cfg.month_col)
    per_id = info.groupBy(cfg.id_col).agg(
        F.max(m).alias("_last"),
        F.min_by(m, F.when(m <= cutoff, order_key(cfg.id_col, m, seed=cfg.seed))).alias(cfg.behav_col))
    return (per_id.where((F.col("_last") == mm) & F.col(cfg.behav_col).isNotNull())
            .join(cease.select(cfg.id_col), cfg.id_col, "left_anti")
            .select(cfg.id_col, cfg.behav_col))


def _snapshots_of(months: DataFrame, info: DataFrame, cfg: ChurnConfig) -> DataFrame:
    """The snapshots of each customer's month in ``months`` (few rows per customer), joined on the customer alone:
    a table in buckets of the customer is not shuffled then. ``months`` is the hashed side, so the snapshots,
    many times as many, are not sorted either."""
    wanted = months.withColumnRenamed(cfg.behav_col, "_month").hint("shuffle_hash")
    at = F.datediff(F.col(cfg.month_col), F.col("_month")) == 0
    return wanted.join(info, cfg.id_col).where(at).withColumnRenamed(cfg.month_col, cfg.behav_col)


def live_baseline(info: DataFrame, cease: DataFrame, cfg: ChurnConfig = DEFAULT) -> DataFrame:
    """The snapshot of the sampled month with all attributes, churned = 0."""
    return (_snapshots_of(sample_month(info, cease, cfg), info, cfg)
            .select(cfg.id_col, cfg.behav_col, F.lit(0).alias(cfg.label_col), *_attrs(info, cfg)))


def churn_observation_month(cease: DataFrame, cfg: ChurnConfig = DEFAULT) -> DataFrame:
    """Cease month and the month before it (the observation month)."""
    cm = month_start(cfg.placed_col)
    return cease.select(cfg.id_col, cfg.placed_col, cfg.reason_col,
                        cm.alias("cease_month"), month_shift(cm, -1).alias(cfg.behav_col))


def reason_per_month(cease: DataFrame, cfg: ChurnConfig = DEFAULT) -> DataFrame:
    """One reason per (id, observation month, cease month): the smallest non-null
    reason (order-free, unlike taking the first row)."""
    return (churn_observation_month(cease, cfg)
            .groupBy(cfg.id_col, cfg.behav_col, "cease_month")
            .agg(F.min(cfg.reason_col).alias(cfg.reason_col)))


def churned_baseline(info: DataFrame, cease: DataFrame, cfg: ChurnConfig = DEFAULT) -> DataFrame:
    """Reason rows joined to the snapshot of the observation month (inner: a
    churner without that snapshot is dropped), churned = 1."""
    return (_snapshots_of(reason_per_month(cease, cfg), info, cfg)
            .select(cfg.id_col, cfg.behav_col, F.lit(1).alias(cfg.label_col), cfg.reason_col, *_attrs(info, cfg)))


def exclude_first_month(df: DataFrame, info: DataFrame, cfg: ChurnConfig = DEFAULT) -> DataFrame:
    """Drop observation months equal to the first snapshot month (no history)."""
    return df.where(F.col(cfg.behav_col) != min_month(info, cfg))


def exclude_reasons(df: DataFrame, cfg: ChurnConfig = DEFAULT) -> DataFrame:
    """Drop listed reasons; ``NOT IN`` also drops a null reason."""
    return df.where(~F.col(cfg.reason_col).isin(list(cfg.excluded_reasons)))


def dedup_earliest(df: DataFrame, cfg: ChurnConfig = DEFAULT) -> DataFrame:
    """Earliest observation month per customer."""
    return keep_first(df, cfg.id_col, cfg.behav_col)


def churned_kept(info: DataFrame, cease: DataFrame, cfg: ChurnConfig = DEFAULT, watch=_unwatched) -> DataFrame:
    """D8 -> D9 -> D10 -> D11, in that order (reasons before dedup: an excluded early
    cease lets a later one through)."""
    c = watch("churned", churned_baseline(info, cease, cfg))
    c = exclude_reasons(exclude_first_month(c, info, cfg), cfg)
    return dedup_earliest(c, cfg).drop(cfg.reason_col)


def observation_set(info: DataFrame, cease: DataFrame, cfg: ChurnConfig = DEFAULT, watch=_unwatched) -> DataFrame:
    """Live and churned rows in the fixed silver column order. ``watch`` (name, frame) sees each stage on
    the way, e.g. ``StageAudit.watch``, which counts it in the same pass."""
    cols = [cfg.id_col, cfg.behav_col, cfg.label_col, *_attrs(info, cfg)]
    kept = watch("churned_kept", churned_kept(info, cease, cfg, watch))
    return watch("observation_set", union_aligned([watch("live", live_baseline(info, cease, cfg)), kept], cols))


def filter_churned(raw_info: DataFrame, cease: DataFrame, cfg: ChurnConfig = DEFAULT) -> DataFrame:
    """Keep live rows, and churned rows with at least one cease whose reason is
    present and not excluded; then the earliest row per customer.

    A semi join instead of a left join + filter: a customer with many ceases is not
    multiplied before the dedup, and the result is the same.
    """
    ok = cease.where(F.col(cfg.reason_col).isNotNull() & ~F.col(cfg.reason_col).isin(list(cfg.excluded_reasons)))
    live = raw_info.where(F.col(cfg.label_col) == 0)
    churned = raw_info.where(F.col(cfg.label_col) == 1).join(ok.select(cfg.id_col), cfg.id_col, "left_semi")
    return keep_first(live.unionByName(churned), cfg.id_col, cfg.behav_col)


def usage_in_obs_month(usage: DataFrame, raw_info: DataFrame, cfg: ChurnConfig = DEFAULT) -> DataFrame:
    """Usage rows in the customer's observation month, with that month."""
    obs = raw_info.select(cfg.id_col, cfg.behav_col)
    out = same_month_join(usage, obs, cfg.id_col, cfg.usage_date_col, cfg.behav_col)
    return out.select(*usage.columns, cfg.behav_col)


def daily_usage_in_obs_month(daily: DataFrame, raw_info: DataFrame, cfg: ChurnConfig = DEFAULT) -> DataFrame:
    """D14 from usage bucketed by customer: joined on the customer alone, as a further key would shuffle both
    sides again; the month is a condition. A customer has one observation month, so no pairs arise."""
    obs = raw_info.select(cfg.id_col, cfg.behav_col)
    same_month = F.datediff(month_start(cfg.usage_date_col), cfg.behav_col) == 0
    return daily.join(obs, cfg.id_col).where(same_month).select(*daily.columns, cfg.behav_col)
