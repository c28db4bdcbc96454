"""ledgerline: multi-channel commerce reports as Spark DataFrame jobs.

Layout: ``sources`` (tables, schemas, catalog), ``functions`` (money, JSON, calendar helpers),
``operators`` (filters, de-duplication, revenue, costs, marketing, presentation), ``plans`` (the
seven reports and the query registry), ``streaming`` (incremental refresh of the daily fact).
"""

from .params import ReportParams, ShopCodes

__all__ = ["ReportParams", "ShopCodes"]
