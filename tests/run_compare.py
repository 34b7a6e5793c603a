"""Run named queries against their SQL: ``python tests/run_compare.py <sf_dir> [name ...]``."""

import sys
import time

sys.path.insert(0, __file__.rsplit("/", 2)[0])
sys.path.insert(0, __file__.rsplit("/", 1)[0])

from compare import compare, duck  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from binledger.session import local_session  # noqa: E402

folder, names = sys.argv[1], sys.argv[2:]
spark = local_session(8)
spark.sparkContext.setLogLevel("ERROR")
con = duck(folder)
queries, oracle = entry.queries(), entry.oracle_sql()
bad = 0
for name in names or queries:
    begin = time.time()
    try:
        df = queries[name](spark, folder)
        outcome = compare(df, con, oracle[name]) if name in oracle else f"rows only: {len(df.collect())}"
    except Exception as e:  # noqa: BLE001
        outcome = f"ERROR {type(e).__name__}: {str(e)[:1500]}"
    bad += bool(outcome)
    print(f"{name:28s} {time.time() - begin:6.2f}s {'ok' if outcome is None else outcome}", flush=True)
print("different:", bad)
