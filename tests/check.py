"""Run registered queries against their SQL: python -m tests.check [sf_dir] [name ...]"""

from __future__ import annotations

import sys
import time
import traceback

from millrace.catalog import all_queries, all_sql
from millrace.session import build_session
from tests.oracle import compare, connect


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    wanted = argv[1:]
    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sql = connect(sf_dir), all_sql()
    bad = 0
    for name, run in all_queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            problem = compare(df, con, sql[name]) if name in sql else (None if df.count() else "no rows")
        except Exception as error:
            problem = "".join(traceback.format_exception_only(error))[:1500]
            if "--trace" in wanted:
                traceback.print_exc()
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {'' if name in sql else '(rows only) '}{problem or ''}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
