"""Typed report parameters.

The source reports take a report window as text placeholders and hard-code shop ids,
shop names and user names.  Here they are literals of a frozen dataclass, so Catalyst folds
them into scan filters (and Parquet pushdown) instead of cross-joining a one-row relation.
"""

from __future__ import annotations

import calendar
import datetime as dt
from dataclasses import dataclass, field, replace


def add_months(d: dt.date, months: int) -> dt.date:
    """Calendar month arithmetic that clamps to the month end (2025-03-31 - 1 month = 2025-02-28)."""
    y, m = divmod(d.year * 12 + (d.month - 1) + months, 12)
    m += 1
    return dt.date(y, m, min(d.day, calendar.monthrange(y, m)[1]))


@dataclass(frozen=True)
class ShopCodes:
    """Special shops, shop names and users that the reports single out.

    Defaults are the production values of the source reports; ``for_fixture`` gives the
    stand-ins used with the synthetic test tables (shops there are nation keys 0-24).
    """

    # fixed values: ids and names used by the source reports
    funnel_shopee_shop: int = 232        # funnel Shopee orders; also the special surcharge shop
    funnel_manual_shop: int = 299        # funnel manual orders; Facebook-ads shop
    funnel_tiktok_shop: int = 311        # funnel TikTok orders
    warehouse_shop: int = 221            # consignment / warehouse shop
    sample_tiktok_shop: int = 363        # TikTok sample shop
    test_shops: tuple[int, ...] = (345, 151)
    warehouse_shop_name: str = "TOKO RIVA"
    denied_users: tuple[str, ...] = ("Admin Offline", "dig1line")
    facebook_importer: int = 7

    @staticmethod
    def for_fixture() -> "ShopCodes":
        return ShopCodes(
            funnel_shopee_shop=3,
            funnel_manual_shop=5,
            funnel_tiktok_shop=8,
            warehouse_shop=10,
            sample_tiktok_shop=12,
            test_shops=(20, 21),
            warehouse_shop_name="NATION_10",
            denied_users=("Supplier#000000003", "Supplier#000000007"),
            facebook_importer=7,
        )


@dataclass(frozen=True)
class ReportParams:
    """Inclusive report window ``[date_from, date_to]`` plus the clock used for pro-rating."""

    date_from: dt.date = dt.date(2025, 6, 1)
    date_to: dt.date = dt.date(2025, 12, 31)
    as_of: dt.date = field(default_factory=dt.date.today)
    # fixed value: start of the monthly profit-and-loss history
    history_start: dt.date = dt.date(2025, 5, 1)
    # fixed values: the product x month budget matrix window (inclusive)
    budget_from: dt.date = dt.date(2025, 6, 1)
    budget_to: dt.date = dt.date(2025, 12, 30)
    codes: ShopCodes = field(default_factory=ShopCodes)
    # a JSON number that cannot be read ends the report (the source's cast does); else it is NULL
    # and ``functions.json_fields.rejected_fields`` lists it
    strict_json: bool = False

    def bounds(self) -> tuple[dt.date, dt.date]:
        """Half-open ``[from, to + 1 day)``: keeps timestamps of the last day."""
        return self.date_from, self.date_to + dt.timedelta(days=1)

    def prior_month_bounds(self) -> tuple[dt.date, dt.date]:
        """Both ends one calendar month earlier (clamped), end made exclusive."""
        return add_months(self.date_from, -1), add_months(self.date_to, -1) + dt.timedelta(days=1)

    def previous_calendar_month(self) -> tuple[dt.date, dt.date]:
        """Whole calendar month before the window start: ``[trunc(from - 1 month), trunc(from))``."""
        start = add_months(self.date_from, -1).replace(day=1)
        return start, self.date_from.replace(day=1)

    def budget_bounds(self) -> tuple[dt.date, dt.date]:
        return self.budget_from, self.budget_to + dt.timedelta(days=1)

    def with_window(self, date_from: dt.date, date_to: dt.date) -> "ReportParams":
        return replace(self, date_from=date_from, date_to=date_to)

    @staticmethod
    def for_fixture() -> "ReportParams":
        """Parameters for the synthetic tables (dates there are shifted into 2025-2031)."""
        return ReportParams(as_of=dt.date(2026, 2, 15), codes=ShopCodes.for_fixture())
