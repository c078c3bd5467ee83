"""Date expressions: month start and shift, days in month, ISO week labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_start(c) -> Column:
    """First day of the month as DATE (also from TIMESTAMP_NTZ)."""
    return F.trunc(_c(c), "month")


def month_shift(c, n: int) -> Column:
    """``add_months``: clamps to month end (03-31 minus 1 -> 02-29)."""
    return F.add_months(_c(c), n)


def days_in_month(c) -> Column:
    return F.dayofmonth(F.last_day(_c(c)))


def same_month(a, b) -> Column:
    """True when both dates fall in one calendar month; an equi-join key pair."""
    return month_start(a) == month_start(b)


def iso_year_week(c) -> Column:
    """``YYYY-Www`` with the ISO week-based year and a zero-padded week.

    Sorting the label as text then equals sorting by date (unlike calendar year
    plus unpadded week, where 2023-01-01 would read 2023-W52 and W10 < W2).
    """
    d = _c(c)
    return F.concat(F.extract(F.lit("YEAROFWEEK"), d).cast("string"), F.lit("-W"),
                    F.lpad(F.weekofyear(d).cast("string"), 2, "0"))


def day_diff(end, start) -> Column:
    return F.datediff(_c(end), _c(start))


def to_date_safe(c, fmt: str | None = None) -> Column:
    """String to DATE; unparsable text gives null instead of failing the job (ANSI on)."""
    return F.try_to_date(_c(c), F.lit(fmt)) if fmt else F.try_to_date(_c(c))
