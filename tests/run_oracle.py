"""Compare catalog queries with their SQL: run_oracle.py SF_DIR [query ...]"""

import sys
import time

import conftest
from compare import connect, differences, duck_rows, spark_rows

from termspace.plans import catalog, oracle

if __name__ == "__main__":
    sf_dir, names = sys.argv[1], sys.argv[2:] or list(catalog.QUERIES)
    spark, con = conftest.new_session(), connect(sf_dir)
    for name in names:
        start = time.time()
        try:
            ours = spark_rows(catalog.QUERIES[name](spark, sf_dir))
        except Exception as problem:
            print(f"{name}: FAILED {str(problem)[:1500]}", flush=True)
            continue
        spent = time.time() - start
        start = time.time()
        try:
            found = differences(ours, duck_rows(con, oracle.SQL[name])) if name in oracle.SQL else ["no SQL"]
        except Exception as problem:
            found = [f"SQL FAILED {str(problem)[:600]}"]
        print(f"{name}: {len(ours[1])} rows, {spent:.1f}s / {time.time() - start:.1f}s, {found or 'same'}", flush=True)
