"""Run every registered Spark query once and print row counts and timings."""

import sys
import time

sys.path.insert(0, ".")
from ledgerline.plans.registry import QUERIES  # noqa: E402
from ledgerline.session import get_session  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
only = sys.argv[2:] or list(QUERIES)
spark = get_session("local[8]", 8, extra={"spark.driver.memory": "8g"})
for name in only:
    t = time.time()
    try:
        df = QUERIES[name](spark, sf)
        rows = df.collect()
        print(f"{name:30s} rows={len(rows):6d} {time.time() - t:6.2f}s cols={df.columns[:6]}")
    except Exception as e:  # noqa: BLE001
        print(f"{name:30s} ERROR {type(e).__name__}: {str(e)[:400]}")
