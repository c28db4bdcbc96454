import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from ledgerline.session import get_session
    s = get_session("local[4]", shuffle_partitions=4, extra={"spark.driver.memory": "8g"})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def frames(spark):
    """Build a Catalog from hand-made rows: ``frames({'pesanan': [...], ...})``."""
    from ledgerline.sources import SCHEMAS, Catalog

    def make(tables: dict) -> Catalog:
        dfs = {n: spark.createDataFrame(rows, SCHEMAS[n]) for n, rows in tables.items()}
        return Catalog.from_frames(spark, dfs)
    return make
