"""Run the registered queries against their SQL equivalents: python tests/check_queries.py [folder] [name part ...]"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from riskframe.plans.catalog import ORACLES, QUERIES  # noqa: E402
from riskframe.plans.views import Views  # noqa: E402
from riskframe.session import build_session  # noqa: E402
from tests.oracle import connect, differences  # noqa: E402


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    parts = sys.argv[2:]
    spark = build_session(
        master="local[8]", conf={"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(folder), []
    for name, build in QUERIES.items():
        if parts and not any(p in name for p in parts):
            continue
        start = time.time()
        try:
            df = build(Views(spark, folder))
            if name in ORACLES:
                found = differences(df, con, ORACLES[name])
            else:
                found = [] if df.collect() else ["no rows"]
        except Exception as error:  # report and go on
            found = [f"{type(error).__name__}: {str(error)[:500]}"]
        kind = "sql " if name in ORACLES else "rows"
        print(f"{'FAIL' if found else 'ok  '} {kind} {time.time() - start:6.2f}s {name}", *found, sep="\n     ", flush=True)
        if found:
            failed.append(name)
    print(f"{len(failed)} failed: {failed}")
    return len(failed)


if __name__ == "__main__":
    sys.exit(main())
