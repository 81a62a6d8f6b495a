"""Run registered queries against their oracle SQL: python tests/run_oracle.py [sf_dir] [name ...]"""
import sys
import time

sys.path.insert(0, "/root/repo")
sys.path.insert(0, "/root/repo/tests")

from oracle import compare, duck  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from segmint.session import get_spark  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
names = sys.argv[2:]
spark = get_spark()
con = duck(sf)
qs, sqls = E.queries(), E.oracle_sql()
bad = 0
for name, fn in qs.items():
    if names and name not in names:
        continue
    t = time.time()
    try:
        df = fn(spark, sf)
        if name in sqls:
            ok, msg = compare(df, con, sqls[name])
        else:
            n = df.count()
            ok, msg = True, f"rows-only {n}"
    except Exception as e:  # noqa: BLE001
        ok, msg = False, f"ERROR {type(e).__name__}: {str(e)[:400]}"
    bad += not ok
    print(f"{'OK  ' if ok else 'FAIL'} {name:32s} {time.time()-t:6.2f}s {msg}", flush=True)
print("failures:", bad)
