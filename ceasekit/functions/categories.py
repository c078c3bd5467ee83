"""Category collapse, column-name cleaning and one-hot expressions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ceasekit.config import CRM_KEEP, CRM_OTHER, CRM_ULTRA, SALES_CHANNEL_MAP


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def collapse(c, mapping: Sequence[tuple[Iterable, object]], default="keep") -> Column:
    """Searched CASE: first matching group wins; ``default='keep'`` keeps the value.

    ``isin`` is null-safe here: a null value matches no group and takes the default.
    """
    col = _c(c)
    expr = None
    for sources, target in mapping:
        cond = col.isin(list(sources))
        tgt = target if isinstance(target, Column) else F.lit(target)
        expr = F.when(cond, tgt) if expr is None else expr.when(cond, tgt)
    dflt = col if default == "keep" else F.lit(default)
    return dflt if expr is None else expr.otherwise(dflt)


def sales_channel_clean(c="sales_channel") -> Column:
    """Collapse of the raw sales channel; must read the original column."""
    return collapse(c, SALES_CHANNEL_MAP, default="keep")


def crm_package_clean(c="crm_package_name") -> Column:
    """Ultra names merged, kept names as they are, anything else (null too) -> Other."""
    col = _c(c)
    return (F.when(col.isin(list(CRM_ULTRA)), F.lit(CRM_ULTRA[0]))
            .when(col.isin(list(CRM_KEEP)), col)
            .otherwise(F.lit(CRM_OTHER)))


# Name-cleaning styles per feature group (replacements applied in order, then lower case).
NAME_STYLES = {
    "plain": (),
    "status": ((" ", "_"), ("/", "_")),
    "crm": ((" ", "_"), ("(", ""), (")", ""), ("-", "_")),
    "channel": ((" ", "_"), ("-", "")),
}


def clean_name(prefix: str, value, style: str = "plain") -> str:
    """Column name for one category value, e.g. ``crm_package_fibre_65_fttc_or``."""
    text = str(value)
    for old, new in NAME_STYLES[style]:
        text = text.replace(old, new)
    return f"{prefix}{text.lower()}"


def clean_name_sql(prefix: str, c, style: str = "plain") -> Column:
    """The same rule as a column expression (for long-form outputs)."""
    col = _c(c).cast("string")
    for old, new in NAME_STYLES[style]:
        col = F.replace(col, F.lit(old), F.lit(new))
    return F.concat(F.lit(prefix), F.lower(col))


def one_hot(c, values: Iterable, prefix: str, style: str = "plain") -> list[Column]:
    """One 0/1 int column per non-null value; a null input row is all zeros.

    Values that clean to the same column name are merged into one column (their
    indicator is an OR), instead of one silently overwriting the other.
    """
    col = _c(c)
    groups: dict[str, list] = {}
    for v in values:
        if v is None:
            continue
        groups.setdefault(clean_name(prefix, v, style), []).append(v)
    out = []
    for name in sorted(groups):
        vs = groups[name]
        cond = col == F.lit(vs[0]) if len(vs) == 1 else col.isin(vs)
        out.append(F.when(cond, 1).otherwise(0).cast("int").alias(name))
    return out
