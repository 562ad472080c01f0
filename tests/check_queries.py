"""Compare registered queries with their SQL: python -m tests.check_queries [sf] [name ...]"""

from __future__ import annotations

import sys
import time
import traceback

from __spark_entry__ import oracle_sql, queries
from loadkit.session import build_session
from tests.oracle import TABLES, compare, connect


def main() -> int:
    sf, *names = sys.argv[1:] or ["0.01"]
    sf_dir = f"{TABLES}/sf{sf}"
    spark = build_session(
        "check",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(sf_dir), 0
    sql = oracle_sql()
    for name, query in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            if name in sql:
                found = compare(spark, con, query, sql[name], sf_dir)
            else:
                found = [] if query(spark, sf_dir).count() else ["no rows"]
        except Exception:
            found = [traceback.format_exc()[-1500:]]
        failed += bool(found)
        print(f"{'FAIL' if found else 'ok':5}{name:28}{time.time() - start:6.2f}s")
        for line in found:
            print("      ", line)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main())
