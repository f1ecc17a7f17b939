"""Run registered queries against their SQL: python tests/check.py [name-part ...]"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from loadkit.plans import registry  # noqa: E402
from loadkit.session import build_session  # noqa: E402

import oracle  # noqa: E402


def main(parts):
    sf = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")
    if os.environ.get("CHECK_MODULES"):
        registry.MODULES = tuple(os.environ["CHECK_MODULES"].split(","))
    spark = build_session("local[8]", driver_memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle.connect(sf)
    bad, oracles = 0, registry.all_oracles()
    for name, fn in registry.all_queries().items():
        if parts and not any(p in name for p in parts):
            continue
        start = time.time()
        try:
            df = fn(spark, sf)
            if name in oracles:
                problem = oracle.difference(df, con, oracles[name])
                note = f"{len(oracle.duck_side(con, oracles[name])[1])} rows" if not problem else problem
            else:
                problem, note = None, f"{len(df.collect())} rows, no sql"
        except Exception as error:  # report and go on
            problem = note = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(problem)
        print(f"{'BAD ' if problem else 'ok  '} {name:34s} {time.time() - start:6.2f}s  {note}", flush=True)
    print(f"{bad} bad")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
