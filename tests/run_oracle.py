"""CLI: compare every registered query with its oracle SQL (default sf0.01)."""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle_harness import compare, duck  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from seisflow.session import build_session  # noqa: E402


def main():
    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    only = sys.argv[1:]
    spark = build_session(master="local[8]", shuffle_partitions=8, conf={"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t = time.time()
        if name not in sqls:
            n = fn(spark, sf_dir).count()
            print(f"ROWS  {name:28s} rows={n} ({time.time()-t:.1f}s)")
            continue
        try:
            problems, n = compare(spark, name, fn, sqls[name], sf_dir, con)
        except Exception as e:  # report and go on
            problems, n = [f"error: {type(e).__name__}: {str(e)[:400]}"], -1
        status = "OK   " if not problems else "FAIL "
        bad += bool(problems)
        print(f"{status} {name:28s} rows={n} ({time.time()-t:.1f}s) {'; '.join(problems)}")
    print(f"{bad} failing")
    spark.stop()


if __name__ == "__main__":
    main()
