"""Row filters of the reports as ``Column`` builders.

All of them keep SQL three-valued logic on purpose: a missing JSON key or a NULL status makes the
predicate NULL and the row is dropped, exactly like the source reports.  No ``coalesce`` is added.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from .rules import INVALID_STATUSES, contains_ci


def valid_status(status: Column | None = None) -> Column:
    """``status NOT IN (BARU, DIBATALKAN, GAGAL_KIRIM, DIKEMBALIKAN)``."""
    s = F.col("status") if status is None else status
    return ~s.isin(*INVALID_STATUSES)


def in_window(c: Column, start: dt.date, end: dt.date | None) -> Column:
    """Half-open ``[start, end)``; literals, so the range reaches the Parquet scan."""
    cond = c >= F.lit(start)
    return cond if end is None else cond & (c < F.lit(end))


def not_name_at(name: Column, keywords, at: Column | None = None) -> Column:
    """``NOT (name ILIKE '%kw%' AND at)`` for each keyword (``at`` omitted: name test only)."""
    cond = None
    for kw in keywords:
        hit = contains_ci(name, kw) if at is None else (contains_ci(name, kw) & at)
        cond = ~hit if cond is None else (cond & ~hit)
    return cond


def channel_valid(marketplace: Column, manual_channels, manual_extra: Column | None) -> Column:
    """``(manual AND valid AND extra) OR (NOT manual AND valid)``."""
    is_manual = marketplace.isin(*manual_channels)
    manual_ok = is_manual & valid_status()
    if manual_extra is not None:
        manual_ok = manual_ok & manual_extra
    return manual_ok | (~is_manual & valid_status())


def in_months(col: Column, months: list[tuple[int, int]] | None) -> Column:
    """``col`` lies in one of the ``(year, month)`` months; true for all rows without months.
    Plain comparisons with literals, so they reach the scan as pushed filters."""
    if months is None:
        return F.lit(True)
    out = F.lit(False)
    for year, month in sorted(set(months)):
        start = dt.date(year, month, 1)
        end = dt.date(year + month // 12, month % 12 + 1, 1)
        out = out | ((col >= F.lit(start)) & (col < F.lit(end)))
    return out
