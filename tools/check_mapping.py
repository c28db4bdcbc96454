"""Compare the Spark and the DuckDB definitions of every mapped source table (counts, sums)."""

import sys

import duckdb

sys.path.insert(0, ".")
from ledgerline.session import get_session  # noqa: E402
from ledgerline.sources import SCHEMAS, Catalog  # noqa: E402
from ledgerline.sources.driver_mapping import sql_with_views  # noqa: E402

DRIVER = "region nation customer supplier part orders lineitem events".split()


def main(sf_dir):
    spark = get_session("local[8]", 8)
    cat = Catalog.from_driver_tables(spark, sf_dir)
    con = duckdb.connect()
    for t in DRIVER:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    bad = 0
    for name in SCHEMAS:
        df = cat.table(name)
        cols = df.columns
        # checksum: count, and per column the count of non-nulls and a hash-sum of the text
        exprs = ", ".join([f"count(*)"] + [
            f"count(`{c}`), sum(hash(cast(`{c}` as string)) % 1000003)" for c in cols])
        srow = df.selectExpr(*exprs.split(", ")).collect()[0]
        dcols = ", ".join(["count(*)"] + [f'count("{c}")' for c in cols])
        drow = con.sql(sql_with_views(f"SELECT {dcols} FROM {name}")).fetchall()[0]
        s_counts = [srow[0]] + [srow[1 + 2 * i] for i in range(len(cols))]
        ok = list(s_counts) == list(drow)
        bad += not ok
        print(("OK  " if ok else "BAD ") + name, s_counts, "" if ok else drow)
        # value check on sums of numeric columns
        num = [c for c, t in df.dtypes if t.startswith(("decimal", "int", "bigint"))]
        if num:
            s = df.selectExpr(*[f"sum(`{c}`)" for c in num]).collect()[0]
            d = con.sql(sql_with_views(
                f"SELECT {', '.join(f'sum({chr(34)}{c}{chr(34)})' for c in num)} FROM {name}")).fetchall()[0]
            if [float(x or 0) for x in s] != [float(x or 0) for x in d]:
                bad += 1
                print("   SUM MISMATCH", num, s, d)
        txt = [c for c, t in df.dtypes if t in ("string", "date", "timestamp_ntz") and c not in ("customer", "data")]
        for c in txt:
            s = sorted(str(r[0]) for r in df.groupBy(c).count().select(c).collect())[:5]
            d = sorted(str(r[0]) for r in con.sql(sql_with_views(f'SELECT DISTINCT "{c}" FROM {name}')).fetchall())[:5]
            if s != d:
                print("   VALUES", c, s, d)
    print("mismatching tables:", bad)


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01")
