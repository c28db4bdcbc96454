"""Refresh of materialised report facts.

The source reports contain no stream, watermark or stateful operator; what they describe is a
daily shop fact that is materialised and re-read (a materialised view).  That is re-aimed here
as an idempotent batch refresh of a month-partitioned Parquet table (``daily_fact``): re-running
a month replaces exactly that month's partitions, so a lost executor or a retried job never
duplicates rows.  ``refresh_changed`` finds the months to refresh by fingerprints of the inputs
(``changes``).
"""

from .daily_fact import (read_daily_fact, refresh_changed, refresh_shopee_daily_fact,
                         write_partitioned)

__all__ = ["refresh_shopee_daily_fact", "refresh_changed", "read_daily_fact", "write_partitioned"]
