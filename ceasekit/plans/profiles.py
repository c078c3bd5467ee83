"""Attrition-rate profiles of the observation set (all aggregated on Spark)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ceasekit.config import ChurnConfig
from ceasekit.operators.prefix import landed, prefix_scan, reached

DEFAULT = ChurnConfig()


def overall_rate(raw_info: DataFrame, cfg: ChurnConfig = DEFAULT) -> DataFrame:
    """Mean of the label and the row count."""
    return raw_info.agg(F.avg(cfg.label_col).cast("double").alias("churn_rate"),
                        F.count(F.lit(1)).alias("total_customers"))


def rate_by_category(df: DataFrame, by, cfg: ChurnConfig = DEFAULT, with_overall: bool = False,
                     name: str | None = None, extra: tuple = ()) -> DataFrame:
    """Customers, churn rate and share of all customers per value of ``by``
    (plus any ``extra`` key columns, e.g. a bucket ordinal).

    The totals are a one-row scalar subquery, so no task sees all groups. ``with_overall`` adds
    the overall rate instead of the share. Largest groups come first.
    """
    col = F.col(by) if isinstance(by, str) else by
    name = name or (by if isinstance(by, str) else "category")
    g = df.groupBy(col.alias(name), *extra).agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.sum(cfg.label_col).alias("_churned"))
    customers = df.select(F.count(F.lit(1))).scalar()
    g = g.withColumn("churn_rate", F.try_divide(F.col("_churned").cast("double"), F.col("total_customers")))
    if with_overall:
        g = g.withColumn("overall_churn_rate",
                         F.try_divide(df.select(F.sum(cfg.label_col)).scalar().cast("double"), customers))
    else:
        g = g.withColumn("pct_of_total",
                         F.try_divide(F.col("total_customers") * F.lit(100.0), customers))
    return g.drop("_churned").orderBy(F.desc("total_customers"), F.col(f"`{name}`"))


def rate_by_value_in_range(raw_info: DataFrame, c: str, lo: float, hi: float,
                           cfg: ChurnConfig = DEFAULT) -> DataFrame:
    """P5: per value of ``c`` within [lo, hi] (non-null): churn rate and customers."""
    return (raw_info.where(F.col(c).isNotNull() & F.col(c).between(lo, hi))
            .groupBy(c).agg(F.avg(cfg.label_col).cast("double").alias("churn_rate"),
                            F.count(F.lit(1)).alias("customer_count")))


def min_size_buckets(raw_info: DataFrame, c: str = "ooc_days", lo: float = -170, hi: float = -80,
                     min_size: int = 1000, cfg: ChurnConfig = DEFAULT) -> DataFrame:
    """Walk the values of ``c`` in [lo, hi] in order and close a bucket as soon
    as it holds at least ``min_size`` customers; the last partial bucket is kept.
    Output: bucket, ooc_mid (plain mean of the values), churn_rate (weighted), n.

    Any number of values: rows are aggregated per value, a prefix scan gives running counts, and a second
    scan links each value to the one after the first running count that completes a bucket starting there.
    Which values really start a bucket is found by pointer doubling from the first one.
    """
    per = (raw_info.where(F.col(c).isNotNull() & F.col(c).between(lo, hi))
           .groupBy(F.col(c).cast("double").alias("v"))
           .agg(F.count(F.lit(1)).alias("n"), F.sum(cfg.label_col).cast("double").alias("s")))
    vals = landed(prefix_scan(per, ["v"], {"upto": ("sum", F.col("n")), "at": ("sum", F.lit(1).cast("long"))}), "values")
    ends = vals.select(F.col("upto").alias("count"), F.lit(0).alias("kind"), "at")
    starts = vals.select((F.col("upto") - F.col("n") + min_size).alias("count"), F.lit(1).alias("kind"), "at")
    closing = F.when(F.col("kind") == 0, F.col("at"))
    closed = prefix_scan(ends.unionByName(starts), [F.col("count").desc(), F.col("kind"), F.col("at")], {"end": ("min", closing)})
    links = closed.where("kind = 1 AND end IS NOT NULL").select("at", (F.col("end") + 1).alias("next"))
    first = reached(links, 1).withColumn("_start", F.lit(1).cast("long"))
    marked = vals.join(first, "at", "left").select("v", "n", "s", F.coalesce("_start", F.lit(0).cast("long")).alias("_start"))
    numbered = prefix_scan(marked, ["v"], {"bucket": ("sum", F.col("_start"))})
    return numbered.groupBy(F.col("bucket").cast("int").alias("bucket")).agg(
        F.avg("v").alias("ooc_mid"), F.try_divide(F.sum("s"), F.sum("n").cast("double")).alias("churn_rate"), F.sum("n").alias("n"))


def quantile_edges(df: DataFrame, c: str, probs, exact: bool = True, rel_error: float = 0.01) -> Column:
    """Quantile edges of ``c`` as an array Column of literals.

    ``exact``: linear interpolation at rank p*(n-1) via :func:`exact_quantiles`
    (bounded memory); else ``percentile_approx`` (bounded sketch, relative error
    ``rel_error``), the same estimator family as ``approxQuantile``. Nulls skipped.
    """
    x = F.col(c).cast("double")
    if exact:
        from ceasekit.operators.stats import exact_quantiles
        q = exact_quantiles(df, c, probs)
    else:
        q = df.select(x.alias("_x")).where(F.col("_x").isNotNull() & ~F.isnan("_x")) \
            .approxQuantile("_x", list(probs), rel_error) or None
    if not q:
        return F.lit(None).cast("array<double>")
    return F.array(*[F.lit(None).cast("double") if v is None else F.lit(float(v)) for v in q])


DECILES = tuple(round(0.1 * i, 1) for i in range(1, 10))


def rate_by_quantile_bucket(raw_info: DataFrame, c: str, digits: int, exact: bool = True,
                            cfg: ChurnConfig = DEFAULT) -> DataFrame:
    """Deciles of ``c`` as buckets ``0-q1`` ... ``q9+`` and ``Missing``."""
    from ceasekit.functions.buckets import quantile_bucket
    e = quantile_edges(raw_info, c, DECILES, exact)
    edges = [F.element_at(e, i + 1) for i in range(len(DECILES))]
    label, order = quantile_bucket(c, edges, digits)
    b = raw_info.select(label.alias(f"{c}_bucket"), order.alias("bucket_order"), cfg.label_col)
    return rate_by_category(b, f"{c}_bucket", cfg, extra=("bucket_order",)).orderBy("bucket_order")


def rate_by_fixed_bucket(raw_info: DataFrame, c: str = "line_speed", compat: bool = False,
                         cfg: ChurnConfig = DEFAULT) -> DataFrame:
    """Line-speed buckets by tens (see ``line_speed_bucket``)."""
    from ceasekit.functions.buckets import line_speed_bucket, line_speed_bucket_order
    g = rate_by_category(raw_info, line_speed_bucket(c, compat), cfg, name=f"{c}_bucket")
    return g.withColumn("bucket_order", line_speed_bucket_order(f"{c}_bucket")).orderBy("bucket_order")


def with_flag(raw_info: DataFrame, facts: DataFrame, name: str, cfg: ChurnConfig = DEFAULT) -> DataFrame:
    from ceasekit.operators.relational import existence_flag
    return existence_flag(raw_info.select(cfg.id_col, cfg.label_col), facts, [cfg.id_col], name)


def rate_by_flag(raw_info: DataFrame, facts: DataFrame, name: str, cfg: ChurnConfig = DEFAULT) -> DataFrame:
    """Churn rate and customers by whether the customer has any row in ``facts``."""
    f = with_flag(raw_info, facts, name, cfg)
    return f.groupBy(name).agg(F.avg(cfg.label_col).cast("double").alias("churn_rate"),
                               F.count(F.lit(1)).alias("customer_count"))


def flag_label_crosstab(raw_info: DataFrame, facts: DataFrame, name: str, cfg: ChurnConfig = DEFAULT) -> DataFrame:
    """P10: flag x label counts with margins."""
    from ceasekit.operators.stats import crosstab_with_margins
    return crosstab_with_margins(with_flag(raw_info, facts, name, cfg), name, cfg.label_col, [0, 1])


def rate_by_usage_bucket(obs: DataFrame, usage_obs_month: DataFrame, cfg: ChurnConfig = DEFAULT) -> DataFrame:
    """Churn rate and customers per usage-day bucket of the observation month."""
    from ceasekit.functions.buckets import usage_bucket_label
    from ceasekit.plans.features import usage_days
    d = usage_days(usage_obs_month, cfg)
    j = obs.select(cfg.id_col, cfg.behav_col, cfg.label_col).join(d, cfg.id_col, "left")
    lab = usage_bucket_label(F.coalesce(F.col("usage_days"), F.lit(0)), cfg.behav_col)
    return j.groupBy(lab.alias("usage_bucket")).agg(F.avg(cfg.label_col).cast("double").alias("churn_rate"),
                                                     F.count(F.lit(1)).alias("customer_count"))


def qcut(df: DataFrame, c: str, q: int = 10, name: str = "bucket") -> DataFrame:
    """A10: equal-frequency buckets 0..k-1 with duplicate edges dropped.

    Edges are the exact quantiles 0, 1/q, ..., 1 (linear interpolation); a value
    goes to the number of distinct inner edges below it (right-closed bins, the
    lowest value in bucket 0). Null values get a null bucket.
    """
    probs = [i / q for i in range(q + 1)]
    e = F.array_distinct(quantile_edges(df, c, probs, exact=True))
    inner = F.slice(e, 2, F.greatest(F.size(e) - 2, F.lit(0)))
    x = F.col(c).cast("double")
    # a sum over the fixed number of positions; the edges are literals
    b = sum((F.coalesce((F.try_element_at(inner, F.lit(k)) < x).cast("int"), F.lit(0)) for k in range(2, q)),
            F.coalesce((F.try_element_at(inner, F.lit(1)) < x).cast("int"), F.lit(0)))
    return df.withColumn(name, F.when(x.isNull(), F.lit(None)).otherwise(b).cast("int"))


def rate_by_usage_decile(obs: DataFrame, usage_obs_month: DataFrame, measure: str,
                         cfg: ChurnConfig = DEFAULT, q: int = 10) -> DataFrame:
    """Total of ``measure`` per customer in the observation month (0 without
    usage), cut into ``q`` equal-frequency buckets: churn rate, customers, min, max."""
    tot = usage_obs_month.groupBy(cfg.id_col).agg(F.sum(measure).alias("total"))
    j = landed(obs.select(cfg.id_col, cfg.label_col).join(tot, cfg.id_col, "left")
               .withColumn("total", F.coalesce(F.col("total"), F.lit(0.0))), "usage-totals")      # read by each step of the quantiles
    b = qcut(j, "total", q, "usage_bucket")
    return b.groupBy("usage_bucket").agg(F.avg(cfg.label_col).cast("double").alias("churn_rate"),
                                         F.count(F.lit(1)).alias("customer_count"),
                                         F.min("total").alias("min_usage_mb"), F.max("total").alias("max_usage_mb"))


def tenure_summary(raw_info: DataFrame, c: str = "tenure_days", exact: bool = True) -> DataFrame:
    """Summary statistics and the number of distinct values."""
    from ceasekit.operators.stats import summary_stats
    s = summary_stats(raw_info, c, exact)
    return s.withColumn("distinct_values", raw_info.select(F.count_distinct(c)).scalar())
