"""Deterministic sampling keys.

``rand()`` values depend on row order after a shuffle; these keys depend only on
the row's own values and the seed, so a sample is the same on every run, with any
partition count, and on another engine that has ``md5``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _text(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def md5_key(*cols, seed: int) -> Column:
    """Hex md5 of ``col1|col2|...|seed`` (dates as ISO text)."""
    return F.md5(F.concat_ws("|", *[_text(c) for c in cols], F.lit(str(seed))))


def order_key(*cols, seed: int) -> Column:
    """60-bit integer from the md5 (first 15 hex digits); fixed width, so the
    aggregates that order by it stay in hash aggregation."""
    return F.conv(F.substring(md5_key(*cols, seed=seed), 1, 15), 16, 10).cast("bigint")


def uniform(*cols, seed: int) -> Column:
    """A value in [0, 1) from the first 8 hex digits of the md5 divided by 2^32."""
    return F.conv(F.substring(md5_key(*cols, seed=seed), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
