"""

    python tools/duckdb_yardstick.py [sf_dir]
"""

from __future__ import annotations

import json
import sys
import time

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

import duckdb  # noqa: E402

from ledgerline.plans.oracle import ORACLE_SQL  # noqa: E402
from ledgerline.sources.tables import DRIVER_TABLES  # noqa: E402

sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
con = duckdb.connect()
con.execute("SET threads = 8")
for t in DRIVER_TABLES:
    con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
times = {}
for name, sql in ORACLE_SQL.items():
    t0 = time.perf_counter()
    con.execute(sql).fetchall()
    times[name] = round(time.perf_counter() - t0, 3)
print(json.dumps({"engine": "duckdb", "total": round(sum(times.values()), 3), "queries": times}))
