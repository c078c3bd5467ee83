"""Gold features: one row per customer, one-hot and bucket columns.

The six attribute builders are column expressions over the observation set, so
gold is one projection plus two joins (usage days and calls), not eight
self-joins. One-hot columns need their names when the plan is built, so the wide
form collects at most ``WIDE_VALUES`` category values and refuses more; the sparse
form (``sparse_features``) codes any number of categories without collecting one.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ceasekit.config import GOLD_BASE, ONE_HOT_PREFIXES, REDUNDANT_SPEED_COLUMNS, ChurnConfig
from ceasekit.functions.buckets import ooc_bucket_columns, usage_day_columns
from ceasekit.functions.categories import clean_name_sql, crm_package_clean, one_hot, sales_channel_clean
from ceasekit.operators.dictionary import category_codes, one_hot_vectors, with_codes
from ceasekit.operators.prefix import landed
from ceasekit.operators.relational import existence_flag, same_month_join

DEFAULT = ChurnConfig()

# (output prefix, source column, name style, collapse rule) of the one-hot groups.
ONE_HOT_SPECS = {
    "contract_status": ("contract_status_", "contract_status", "status", None),
    "technology": ("technology_", "technology", "plain", None),
    "speed": ("package_speed_", "speed", "plain", None),
    "sales_channel": ("sales_channel_", "sales_channel", "channel", sales_channel_clean),
    "crm_package": ("crm_package_", "crm_package_name", "crm", crm_package_clean),
}


WIDE_VALUES = 5_000         # category values that may become columns


def _bounded(distinct: DataFrame) -> list:
    """The rows, refused (not cut) when there are more than columns can be made of."""
    rows = distinct.limit(WIDE_VALUES + 1).collect()
    if len(rows) > WIDE_VALUES:
        raise ValueError(f"more than {WIDE_VALUES} category values: use sparse_features, which needs no column per value")
    return rows


def distinct_values(df: DataFrame, expr: Column) -> list:
    """Distinct non-null values of ``expr``. They reach the driver because each becomes a column."""
    return sorted(r.v for r in _bounded(df.select(expr.alias("v")).where(F.col("v").isNotNull()).distinct()))


def _source(group: str) -> Column:
    _, src, _, rule = ONE_HOT_SPECS[group]
    return rule(src) if rule else F.col(src)


def categories(raw_info: DataFrame, cfg: ChurnConfig = DEFAULT, groups=None) -> dict[str, list]:
    """Distinct values of every one-hot group in one job: each row becomes one
    (group, value) row per group, each value in a column of its own type, and a
    partial-aggregate distinct keeps one row per value. Pass explicit lists to
    :func:`one_hot` to skip the job."""
    groups = list(groups or ONE_HOT_SPECS)
    if len(groups) == 1:
        return {groups[0]: distinct_values(raw_info, _source(groups[0]))}
    types = [raw_info.select(_source(g).alias("v")).schema[0].dataType for g in groups]
    tagged = [F.struct(F.lit(i).alias("g"), *[(_source(g) if j == i else F.lit(None).cast(t)).alias(f"v{j}")
                                              for j, t in enumerate(types)])
              for i, g in enumerate(groups)]
    pairs = raw_info.select(F.inline(F.array(*tagged)))
    present = F.coalesce(*[F.when(F.col("g") == i, F.col(f"v{i}").isNotNull()) for i in range(len(groups))])
    rows = _bounded(pairs.where(present).distinct())
    out = {}
    for i, g in enumerate(groups):
        out[g] = sorted(r[f"v{i}"] for r in rows if r.g == i)
    return out


def one_hot_group(group: str, values) -> list[Column]:
    prefix, _, style, _ = ONE_HOT_SPECS[group]
    return one_hot(_source(group), values, prefix, style)


def _single(raw_info, group, cfg, values=None) -> DataFrame:
    values = values if values is not None else categories(raw_info, cfg, [group])[group]
    return raw_info.select(cfg.id_col, *one_hot_group(group, values))


def contract_status_features(raw_info, cfg=DEFAULT, values=None):
    """F1."""
    return _single(raw_info, "contract_status", cfg, values)


def ooc_days_features(raw_info, cfg=DEFAULT):
    """F2."""
    return raw_info.select(cfg.id_col, *ooc_bucket_columns("ooc_days"))


def technology_features(raw_info, cfg=DEFAULT, values=None):
    """F3."""
    return _single(raw_info, "technology", cfg, values)


def speed_features(raw_info, cfg=DEFAULT, values=None):
    """F4."""
    return _single(raw_info, "speed", cfg, values)


def sales_channel_features(raw_info, cfg=DEFAULT, values=None):
    """collapsed from the original column, then one-hot (null -> all zero)."""
    return _single(raw_info, "sales_channel", cfg, values)


def crm_package_features(raw_info, cfg=DEFAULT, values=None):
    """F6."""
    return _single(raw_info, "crm_package", cfg, values)


def usage_days(usage_obs_month: DataFrame, cfg: ChurnConfig = DEFAULT) -> DataFrame:
    """Distinct usage dates per customer in the observation month."""
    return usage_obs_month.groupBy(cfg.id_col).agg(F.count_distinct(cfg.usage_date_col).alias("usage_days"))


def usage_days_features(raw_info, usage_obs_month, cfg=DEFAULT):
    """four usage-day buckets; customers without usage get 0 days."""
    d = usage_days(usage_obs_month, cfg)
    j = raw_info.select(cfg.id_col, cfg.behav_col).join(d, cfg.id_col, "left")
    u = F.coalesce(F.col("usage_days"), F.lit(0))
    return j.select(cfg.id_col, *usage_day_columns(u, cfg.behav_col))


def calls_in_obs_month(calls: DataFrame, raw_info: DataFrame, cfg: ChurnConfig = DEFAULT) -> DataFrame:
    return same_month_join(calls, raw_info.select(cfg.id_col, cfg.behav_col), cfg.id_col,
                           cfg.call_date_col, cfg.behav_col)


def has_calls_feature(raw_info, calls, cfg=DEFAULT):
    """F8: 1 when the customer has a call in the observation month."""
    c = calls_in_obs_month(calls, raw_info, cfg)
    return existence_flag(raw_info.select(cfg.id_col), c, [cfg.id_col], "has_calls")


def gold_dataset(raw_info: DataFrame, usage_obs_month: DataFrame, calls: DataFrame,
                 cfg: ChurnConfig = DEFAULT, cats: dict | None = None) -> DataFrame:
    """base columns + all feature groups, one row per customer."""
    cats = cats or categories(raw_info, cfg)
    one_hots = [c for g in ("contract_status",) for c in one_hot_group(g, cats[g])]
    tail = [c for g in ("technology", "speed", "sales_channel", "crm_package") for c in one_hot_group(g, cats[g])]
    base = raw_info.select(cfg.id_col, *GOLD_BASE, *one_hots, *ooc_bucket_columns("ooc_days"), *tail,
                           cfg.behav_col)
    d = usage_days(usage_obs_month, cfg)
    c = calls_in_obs_month(calls, raw_info, cfg).select(cfg.id_col).distinct().withColumn("_call", F.lit(1))
    j = base.join(d, cfg.id_col, "left").join(c, cfg.id_col, "left")
    u = F.coalesce(F.col("usage_days"), F.lit(0))
    keep = [x for x in base.columns if x != cfg.behav_col]
    return j.select(*keep, *usage_day_columns(u, cfg.behav_col),
                    F.coalesce(F.col("_call"), F.lit(0)).cast("int").alias("has_calls"))


def category_names(groups=None) -> dict[str, Column]:
    """Per one-hot group the column name of a row's category, as an expression (null category: null)."""
    out = {}
    for g in groups or ONE_HOT_SPECS:
        prefix, _, style, _ = ONE_HOT_SPECS[g]
        out[g] = clean_name_sql(prefix, _source(g), style)
    return out


def sparse_features(raw_info: DataFrame, cfg: ChurnConfig = DEFAULT, groups=None) -> tuple[DataFrame, DataFrame]:
    """F9/F11 for any number of categories: (rows, dictionary). The rows are ``raw_info`` with a code and a sparse
    vector per group; the dictionary names the place of each code, with the names of the wide columns."""
    names = category_names(groups)
    codes = landed(category_codes(raw_info, names), "dictionary")
    return one_hot_vectors(with_codes(raw_info, names, codes), list(names), codes), codes


def assembled(rows: DataFrame, numeric, groups=None, out: str = "features") -> DataFrame:
    """Numeric columns and the groups' sparse vectors as one sparse vector (for MLlib); rows with a null number get NaN there."""
    vectors = [f"{g}_vector" for g in groups or ONE_HOT_SPECS]
    return VectorAssembler(inputCols=[*numeric, *vectors], outputCol=out, handleInvalid="keep").transform(rows)


def drop_redundant(gold: DataFrame, columns=REDUNDANT_SPEED_COLUMNS) -> DataFrame:
    """drop the listed columns when present."""
    return gold.drop(*[c for c in columns if c in gold.columns])


def validate_one_hot(gold: DataFrame, prefixes=ONE_HOT_PREFIXES) -> DataFrame:
    """per one-hot group: columns, whether every row sums to 1, min and max row sum."""
    aggs, rows = [], []
    for i, p in enumerate(prefixes):
        cols = [c for c in gold.columns if c.startswith(p)]
        if not cols:
            continue
        s = sum((F.col(c) for c in cols[1:]), F.col(cols[0]))
        aggs += [F.min(s).alias(f"mn{i}"), F.max(s).alias(f"mx{i}"), F.bool_and(s == 1).alias(f"ok{i}")]
        rows.append(F.struct(F.lit(p.rstrip("_")).alias("group_name"), F.lit(len(cols)).alias("n_columns"),
                             F.col(f"ok{i}").cast("int").alias("all_rows_sum_to_one"),
                             F.col(f"mn{i}").cast("bigint").alias("min_row_sum"),
                             F.col(f"mx{i}").cast("bigint").alias("max_row_sum")))
    return gold.agg(*aggs).select(F.inline(F.array(*rows)))


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    num = ("int", "bigint", "double", "float", "smallint", "tinyint")
    return [n for n, t in df.dtypes if t in num and n not in exclude]


def correlation_matrix(df: DataFrame, columns=None) -> DataFrame:
    """Pearson r of every numeric column pair, long form (a, b, r)."""
    from ceasekit.operators.stats import pairwise_pearson
    return pairwise_pearson(df, columns or numeric_columns(df))


def target_correlation(df: DataFrame, target: str = "churned", columns=None) -> DataFrame:
    """r of every feature with the label, strongest positive first (the
    one-scan co-moment fold, keeping only the pairs with the target)."""
    from ceasekit.operators.stats import pairwise_pearson
    columns = [c for c in (columns or numeric_columns(df)) if c != target]
    return pairwise_pearson(df, [target, *columns], first_only=True) \
        .select(F.col("b").alias("feature"), "r").orderBy(F.col("r").desc_nulls_last())


def redundant_pairs(df: DataFrame, threshold: float = 0.99, columns=None) -> DataFrame:
    """F16: column pairs with |r| above the threshold."""
    return correlation_matrix(df, columns).where(F.abs("r") > threshold)
