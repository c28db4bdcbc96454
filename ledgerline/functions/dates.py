"""Calendar helpers (periods, month lengths, pro-rating factors)."""

from __future__ import annotations

import calendar
import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def period(c: Column) -> Column:
    """``'YYYY-MM'`` of a date or timestamp."""
    return F.date_format(c, "yyyy-MM")



def days_in_month(d: dt.date) -> int:
    return calendar.monthrange(d.year, d.month)[1]


def overhead_prorata(as_of: dt.date) -> tuple[int, int]:
    """Running month of overhead: ``(day(as_of) - 1) / days_in_month``; 0 on the 1st."""
    return as_of.day - 1, days_in_month(as_of)


def ratecard_prorata(as_of: dt.date) -> tuple[int, int]:
    """Running month of the rate card: ``day(as_of - 1) / days_in_month``.

    Differs from the overhead rule on day 1, where ``as_of - 1`` is the previous month's last day.
    """
    return (as_of - dt.timedelta(days=1)).day, days_in_month(as_of)
