"""Command-line form of the comparison: ``run_compare.py [sf] [name prefix ...]``."""

import os
import sys
import time

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__)))]

import __spark_entry__ as entry  # noqa: E402
from tests.compare import connect, spark_rows, sql_rows  # noqa: E402
from tillcast.session import local_session  # noqa: E402


def main() -> None:
    sf, wanted = sys.argv[1], sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark, con = local_session(), connect(sf_dir)
    spark.sparkContext.setLogLevel("ERROR")
    oracles = entry.oracle_sql()
    bad = 0
    for name, fn in entry.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        try:
            t = time.time()
            cols, rows = spark_rows(fn(spark, sf_dir))
            t1 = time.time()
            if name not in oracles:
                print(f"----  {name} rows={len(rows)} {t1 - t:.1f}s (no sql)", flush=True)
                continue
            ocols, orows = sql_rows(con, oracles[name])
            t2 = time.time()
            ok = cols == ocols and rows == orows
            bad += not ok
            print(
                f"{'ok   ' if ok else 'DIFF '} {name} rows={len(rows)}/{len(orows)} "
                f"spark={t1 - t:.1f}s sql={t2 - t1:.1f}s",
                flush=True,
            )
            if cols != ocols:
                print("   columns", cols, ocols)
            elif not ok:
                a, b = set(rows), set(orows)
                print("   only spark", list(a - b)[:3], "\n   only sql", list(b - a)[:3])
        except Exception as exc:  # noqa: BLE001
            bad += 1
            print(f"FAIL  {name} {type(exc).__name__} {str(exc)[:700]}", flush=True)
    print("bad:", bad)


main()
