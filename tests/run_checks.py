"""``python tests/run_checks.py SF_DIR [name ...]``: compare queries with their SQL."""

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from compare import database, differences  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from tickloom.session import local_session  # noqa: E402

sf, names = sys.argv[1], sys.argv[2:]
spark = local_session("8")
con = database(sf)
sql = entry.oracle_sql()
bad = 0
for name, fn in entry.queries().items():
    if names and name not in names:
        continue
    began = time.time()
    try:
        df = fn(spark, sf)
        diff = differences(df, con, sql[name]) if name in sql else [] if df.count() else ["no rows"]
    except Exception as err:  # noqa: BLE001
        diff = [str(err)[:900]]
        if names:
            traceback.print_exc()
    bad += bool(diff)
    print(f"{'FAIL' if diff else 'ok  '} {name} {time.time() - began:.2f}s {'; '.join(diff)[:1200]}", flush=True)
print("failed:", bad)
