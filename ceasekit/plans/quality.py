"""Data-quality and trend jobs over the raw tables (Q1-Q20).

Each returns a small DataFrame of results; nothing is collected. Joins of the
large usage table against cease requests are replaced by per-customer
pre-aggregates where the answer only needs per-customer extremes, so a customer
with many rows or many ceases is never multiplied out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ceasekit.functions.dates import iso_year_week, month_start
from ceasekit.operators.relational import key_set_overlap


def table_stats(df: DataFrame, key: str) -> DataFrame:
    """Q1: rows, distinct keys, rows per key (one aggregate pass)."""
    per = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.sum("n").cast("bigint").alias("total_rows"),
                   F.count_if(F.col(key).isNotNull()).alias("distinct_keys")) \
        .withColumn("rows_per_key", F.try_divide(F.col("total_rows").cast("double"), F.col("distinct_keys")))


def date_range(df: DataFrame, date_col: str) -> DataFrame:
    """Q2: first and last date and the number of distinct dates."""
    return df.agg(F.min(date_col).alias("min_date"), F.max(date_col).alias("max_date"),
                  F.count_distinct(date_col).alias("distinct_periods"))


def counts_by_period(df: DataFrame, period_col: str, name: str = "n", key: str | None = None) -> DataFrame:
    """Q3: rows (or non-null ``key`` values) per period, ascending."""
    c = F.count(key) if key else F.count(F.lit(1))
    return df.groupBy(period_col).agg(c.alias(name)).orderBy(period_col)


def period_change(df: DataFrame, period_col: str, key: str, name: str = "customer_count") -> DataFrame:
    """Q4: count per period, change and % change against the previous period.

    The lag window has no partition key but runs on the aggregated rows (one per
    period), never on the raw rows.
    """
    g = df.groupBy(period_col).agg(F.count(key).alias(name))
    w = Window.orderBy(period_col)
    prev = F.lag(name).over(w)
    return g.select(period_col, name, (F.col(name) - prev).cast("double").alias("change"),
                    F.try_divide((F.col(name) - prev) * F.lit(100.0), prev).alias("pct_change"))


def membership_movement(df: DataFrame, key: str, period_col: str) -> DataFrame:
    """Q5: keys only in the first period, only in the last, in both."""
    first = df.where(F.col(period_col) == df.select(F.min(period_col)).scalar())
    last = df.where(F.col(period_col) == df.select(F.max(period_col)).scalar())
    return key_set_overlap(first, last, key)


def grain_check(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Q6: rows, distinct key combinations (null keys included), duplicates, ok."""
    per = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.sum("n").cast("bigint").alias("total_rows"),
                   F.count(F.lit(1)).alias("distinct_keys"),
                   F.sum(F.col("n") - 1).cast("bigint").alias("duplicates")) \
        .withColumn("grain_ok", (F.col("duplicates") == 0).cast("int"))


def avg_periods_per_key(df: DataFrame, key: str) -> DataFrame:
    """Q7: mean number of rows (months) per key."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(F.avg("n").alias("avg_periods"))


def weekly_counts(df: DataFrame, date_col: str) -> DataFrame:
    """Q8: per ISO week: days with events and events (two-level aggregate)."""
    daily = df.groupBy(iso_year_week(date_col).alias("year_week"), F.col(date_col)).agg(
        F.count(F.lit(1)).alias("churns"))
    return daily.groupBy("year_week").agg(F.count(F.lit(1)).alias("days_in_week"),
                                          F.sum("churns").cast("bigint").alias("weekly_churns")).orderBy("year_week")


def active_balance(cease: DataFrame, info: DataFrame, date_col: str, month_col: str) -> DataFrame:
    """Q9: weekly churns, running total and first-month customers minus the running total."""
    wk = weekly_counts(cease, date_col)
    start = info.where(F.col(month_col) == info.select(F.min(month_col)).scalar()) \
        .select(F.count(F.lit(1))).scalar()
    run = Window.orderBy("year_week").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return wk.withColumn("cumulative_churns", F.sum("weekly_churns").over(run).cast("bigint")) \
        .withColumn("active_customers", (start - F.col("cumulative_churns")).cast("bigint"))


def usage_to_event_gap(usage: DataFrame, cease: DataFrame, key: str, usage_date: str, event_date: str) -> DataFrame:
    """Q10: per (customer, cease date): first and last usage and days from the last
    usage to the cease. Usage is reduced to per-customer extremes before the join."""
    u = usage.groupBy(key).agg(F.max(usage_date).alias("last_usage_date"),
                               F.min(usage_date).alias("first_usage_date"))
    c = cease.select(key, event_date).distinct()
    return u.join(c, key).select(key, "first_usage_date", "last_usage_date", event_date,
                                 F.datediff(event_date, "last_usage_date").alias("days_diff_usage_to_cease"))


def daily_usage(usage: DataFrame, key: str, date_col: str, measures: Sequence[str] = ()) -> DataFrame:
    """(key, day, usage_rows, measures): usage per customer and day. A customer has at most a row per day, whatever
    the raw rows, so the result can be bucketed by customer (``write_table(bucket_by=...)``): gaps, usage days, usage
    after a date and monthly totals then read it without a shuffle. Rows without a customer or day are left out."""
    return usage.where(F.col(key).isNotNull() & F.col(date_col).isNotNull()).groupBy(key, date_col).agg(
        F.count(F.lit(1)).alias("usage_rows"), *[F.sum(m).alias(m) for m in measures])


def usage_rows_after(usage: DataFrame, cease: DataFrame, key: str, usage_date: str, event_date: str) -> DataFrame:
    """Per (customer, event date): the event rows on that date (``events``) and the
    usage rows dated strictly after it (``after``, 0 included).

    Pair-free: usage is counted per (customer, day), event dates per (customer,
    day); both go into one day-ordered stream per customer, and the customer's
    total usage minus the running sum up to the event day gives the usage after it.
    Work is linear in the distinct days, with no (usage day x event) pairs; a
    customer's stream holds its distinct days, bounded by the calendar.
    """
    usage = usage.where(F.col(key).isNotNull())         # a null id matches no event
    u = usage.groupBy(key, F.col(usage_date).alias("_d")).agg(F.count(F.lit(1)).alias("_nu")) \
        .withColumn("_nc", F.lit(0).cast("bigint"))
    c = cease.where(F.col(key).isNotNull() & F.col(event_date).isNotNull()).groupBy(key, F.col(event_date).alias("_d")) \
        .agg(F.count(F.lit(1)).alias("_nc")).withColumn("_nu", F.lit(0).cast("bigint"))
    # after = all usage of the customer - usage up to and including the day (two linear frames;
    # a frame running to the partition end would be re-summed for every row)
    whole = Window.partitionBy(key)
    upto = Window.partitionBy(key).orderBy(F.unix_date("_d")).rangeBetween(Window.unboundedPreceding, 0)
    both = u.unionByName(c).withColumn("after", (F.sum("_nu").over(whole) - F.sum("_nu").over(upto)).cast("bigint"))
    return both.where(F.col("_nc") > 0).select(key, F.col("_d").alias(event_date), F.col("_nc").alias("events"),
                                                "after")


def usage_after(usage: DataFrame, cease: DataFrame, key: str, usage_date: str, event_date: str) -> DataFrame:
    """Q11/Q12: customers with usage after an event date and the number of
    (usage row, cease row) pairs with usage after the event, as
    sum(events * usage rows after) from :func:`usage_rows_after` (no pairs built)."""
    r = usage_rows_after(usage, cease, key, usage_date, event_date).where(F.col("after") > 0)
    return r.agg(F.count_distinct(key).alias("customers"),
                 F.sum(F.col("events") * F.col("after")).cast("bigint").alias("records"))


def null_rate(df: DataFrame, c: str) -> DataFrame:
    """Q13: nulls of one column, all rows, percent."""
    return df.agg(F.count_if(F.col(c).isNull()).alias("null_rows"), F.count(F.lit(1)).alias("total_rows")) \
        .withColumn("pct_null", F.try_divide(F.col("null_rows") * F.lit(100.0), F.col("total_rows")))


def missing_in_other(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Q14: distinct keys of ``a`` absent from ``b``."""
    return a.select(key).distinct().join(b.select(key).distinct(), key, "left_anti")


def missing_full_rows(a: DataFrame, b: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Q15: full rows of ``a`` whose key is absent from ``b``, left-joined to ``other``."""
    return a.join(b.select(key), key, "left_anti").join(other, key, "left")


def missing_values(df: DataFrame) -> DataFrame:
    """Q16: per column, null count (null or NaN for float/double); one pass, long form."""
    aggs = []
    for name, t in df.dtypes:
        cond = F.col(name).isNull()
        if t in ("double", "float"):
            cond = cond | F.isnan(name)
        aggs.append(F.count_if(cond).alias(name))
    cols = [F.struct(F.lit(n).alias("column_name"), F.col(f"`{n}`").alias("missing")) for n in df.columns]
    return df.agg(*aggs).select(F.inline(F.array(*cols)))


def categorical_cardinality(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Q17: distinct values per column, null counted as one value."""
    aggs = [(F.count_distinct(c) + F.max(F.col(c).isNull().cast("int"))).alias(c) for c in columns]
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("bigint").alias("distinct_values")) for c in columns]
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def value_distribution(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Q18: rows per value for several columns in one scan (values as text)."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
                      for c in columns])
    return df.select(F.inline(pairs)).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n")) \
        .orderBy("column_name", F.col("n").desc())


def null_rows(df: DataFrame, c: str) -> DataFrame:
    """Q19: the rows where ``c`` is null."""
    return df.where(F.col(c).isNull())


def label_balance(df: DataFrame, label: str) -> DataFrame:
    """Q20 (part): rows per label value."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


class StageAudit:
    """Q20: row counts (and any further aggregates) of named stages, taken while the last one is written.

    Each watched frame carries an ``Observation``, so the audit costs no pass of its own and no stage is
    computed again. The metrics are there once an action has run over the frames. They are accumulated per
    task: a stage that Spark runs again after losing its shuffle files can count rows twice, so a figure that
    must hold is counted on the written table."""

    def __init__(self, **metrics: Column):
        self.metrics = [F.count(F.lit(1)).alias("n"), *[m.alias(k) for k, m in metrics.items()]]
        self.names = ["n", *metrics]
        self.seen: dict[str, Observation] = {}

    def watch(self, name: str, df: DataFrame) -> DataFrame:
        self.seen[name] = Observation(name)
        return df.observe(self.seen[name], *self.metrics)

    def report(self, spark: SparkSession) -> DataFrame:
        """(stage, n, ...) after the write."""
        rows = [(name, *[o.get.get(m) for m in self.names]) for name, o in self.seen.items()]
        return spark.createDataFrame(rows, "stage string, n long" + "".join(f", `{m}` double" for m in self.names[1:]))


def period_sketches(df: DataFrame, key: str, period_col: str, lg_size: int = 14) -> DataFrame:
    """(period, keys): a theta sketch of the distinct keys of each period. One pass; sketches of a fixed size that
    are written once and combined for any two periods."""
    return df.where(F.col(key).isNotNull()).groupBy(period_col).agg(F.theta_sketch_agg(key, lg_size).alias("keys"))


def estimated_movement(sketches: DataFrame, period_col: str, lg_size: int = 14) -> DataFrame:
    """Q5/U2/Q14 at scale: estimates of the keys only in the first period, only in the last and in both, from the
    sketches of two periods. The rest of the data is not read."""
    first = F.min_by("keys", period_col).alias("_a")
    last = F.max_by("keys", period_col).alias("_b")
    size = F.theta_sketch_estimate
    return sketches.agg(first, last).select(
        size(F.theta_difference("_a", "_b")).alias("only_in_first"), size(F.theta_difference("_b", "_a")).alias("only_in_last"),
        size(F.theta_intersection("_a", "_b")).alias("in_both"), size(F.theta_union("_a", "_b", lg_size)).alias("in_either"))


def months_of(df: DataFrame, date_col: str, name: str = "month") -> DataFrame:
    return df.withColumn(name, month_start(date_col))
