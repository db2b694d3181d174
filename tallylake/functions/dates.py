"""Date predicates in a form that reaches the file scan."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def day(value: date | str | None) -> Column:
    """``value`` as a DATE literal; today when it is None."""
    return F.current_date() if value is None else F.lit(str(value)).cast("date")


def in_date_range(column: Column, start: date | str, end: date | str) -> Column:
    """``start <= column < end``. A plain comparison, so parquet row groups are skipped."""
    return (column >= day(start)) & (column < day(end))


def months(year: int, first_month: int = 1, last_month: int = 12) -> tuple[date, date]:
    """First day of the first month, and first day after the last month."""
    after = date(year, last_month, 28) + timedelta(days=4)
    return date(year, first_month, 1), after.replace(day=1)


def in_months(column: Column, year: int, first_month: int = 1, last_month: int = 12) -> Column:
    """Same rows as ``year(c) = y and month(c) between a and b``, but pushed down."""
    return in_date_range(column, *months(year, first_month, last_month))


def changed_since(column: Column, as_of: date | str | None, days: int = 1, inclusive: bool = False) -> Column:
    """Change-date watermark: later than ``as_of`` minus ``days``, or from that day on."""
    mark = F.date_sub(day(as_of), days)
    return column >= mark if inclusive else column > mark
