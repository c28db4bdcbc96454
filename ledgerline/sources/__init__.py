"""Source tables: schemas, the catalog, and the mapping from the synthetic driver tables."""

from .catalog import Catalog
from .schemas import AD_SOURCES, SCHEMAS

__all__ = ["Catalog", "SCHEMAS", "AD_SOURCES"]
