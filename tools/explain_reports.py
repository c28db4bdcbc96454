"""Write the formatted physical plan of every registered query to a scratch directory and
print a one-line summary per query (exchanges, joins, scans, reads of the SKU table, source
tables read more than once)."""

import os
import re
from collections import Counter
import sys
import tempfile

sys.path.insert(0, ".")
from ledgerline.plans.registry import QUERIES  # noqa: E402
from ledgerline.session import get_session  # noqa: E402


def main(sf_dir: str, names: list[str]) -> None:
    spark = get_session("local[8]", 16, extra={"spark.driver.memory": "8g"})
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")   # full scan locations
    out = tempfile.mkdtemp(prefix="plans-", dir="/tmp")
    for name in names or sorted(QUERIES):
        df = QUERIES[name](spark, sf_dir)
        plan = df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        with open(os.path.join(out, f"{name}.txt"), "w") as fh:
            fh.write(plan)
        phys = df._jdf.queryExecution().executedPlan().toString()
        tables = Counter(re.findall(r"ledgerline-sources/[0-9a-f]+/(\w+)\]", phys))
        repeated = {t: n for t, n in tables.items() if n > 1}
        print(f"{name:30s} exchanges={len(re.findall(r'Exchange (hash|range|Single)', phys)):3d} "
              f"smj={phys.count('SortMergeJoin'):2d} bhj={phys.count('BroadcastHashJoin'):2d} "
              f"scans={phys.count('FileScan'):3d} window_limit={'WindowGroupLimit' in phys} "
              f"sku_reads={tables.get('pesanan_detail_sku', 0)} repeated={repeated}")
    print("plans in", out)


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01", sys.argv[2:])
