"""Times the plain SQL form of the headline queries on DuckDB, over the tables bench.py uses, and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

import duckdb

from bench import HEADLINE
from lotline.registry import ORACLE_SQL


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), int(os.environ.get("BENCH_CPUS", "8"))
    con = duckdb.connect(config={"threads": cpus})
    for f in os.listdir(sf_dir):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{sf_dir}/{f}'")
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        began = time.time()
        con.execute(f"create or replace temp table out as {ORACLE_SQL[name].strip()}")
        seconds[name] = round(time.time() - began, 3)
    print(json.dumps({"metric": "seconds of the plain SQL form", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/"))}))


if __name__ == "__main__":
    main()
