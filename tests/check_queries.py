"""Compare registered queries with their SQL: check_queries.py [sf_dir] [name part ...]"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry
from tests.oracle import compare, connect
from tests.session import local_session


def main(sf_dir="/root/testdata/sf0.01", *parts):
    spark = local_session()
    con = connect(sf_dir)
    oracles = entry.oracle_sql()
    bad = 0
    for name, run in entry.queries().items():
        if parts and not any(p in name for p in parts):
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            if name in oracles:
                result = compare(df, con, oracles[name])
            else:
                result = f"rows only: {df.count()}"
        except Exception as error:
            result = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += result is not None and not result.startswith("rows only")
        print(f"{name:45s} {time.time() - start:6.2f}s  {result or 'ok'}", flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main(*sys.argv[1:])
