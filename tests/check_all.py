"""Runs every query against its SQL: python tests/check_all.py SF_DIR [name ...]"""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from compare import connect, difference  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from rollcall.session import build_session  # noqa: E402

if __name__ == "__main__":
    sf_dir, *names = sys.argv[1:]
    spark = build_session(
        "check", master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracles = entry.oracle_sql()
    bad = 0
    for name, fn in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in oracles:
                problem = difference(df, con, oracles[name])
            else:
                problem = f"(no SQL) {df.count()} rows"
        except Exception as e:  # report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad += problem is not None
        print(f"{name:32s} {time.time() - start:6.2f}s {problem or 'ok'}", flush=True)
    print("problems:", bad)
