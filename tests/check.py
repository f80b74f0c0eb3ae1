"""Command-line check: python tests/check.py <sf> [query ...]; all queries when none is named."""

import sys
import time
import traceback

sys.path[:0] = [__file__.rsplit("/", 2)[0], __file__.rsplit("/", 1)[0]]

from callsieve.session import local_session  # noqa: E402
from compare import TESTDATA, differences, duck  # noqa: E402
import __spark_entry__ as entry_module  # noqa: E402

if __name__ == "__main__":
    sf_dir = f"{TESTDATA}/sf{sys.argv[1]}"
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    names, oracles = sys.argv[2:] or list(entry_module.queries()), entry_module.oracle_sql()
    bad = 0
    for name in names:
        start = time.time()
        try:
            if name in oracles:
                said = differences(spark, con, name, sf_dir)
            else:
                n = len(entry_module.queries()[name](spark, sf_dir).collect())
                said = None if n else "no rows"
        except Exception as error:  # noqa: BLE001
            said = "".join(traceback.format_exception_only(error))[:900]
        bad += said is not None
        mark = "ok  " if said is None else "FAIL"
        print(f"{mark} {name} {time.time() - start:.1f}s {'' if name in oracles else '(rows)'} {said or ''}", flush=True)
    print("failed:", bad, "of", len(names))
