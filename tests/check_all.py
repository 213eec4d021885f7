"""python tests/check_all.py SF_DIR [name ...]: run queries against oracles."""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402
from marketloom.session import build_session  # noqa: E402
from tests import oracle  # noqa: E402

if __name__ == "__main__":
    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = build_session(
        "check", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="8g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle.connect(sf_dir)
    oracles = entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        try:
            if name in oracles:
                problem, timing = oracle.compare(spark, name, query, oracles[name], sf_dir, con)
            else:
                start = time.time()
                df = query(spark, sf_dir)
                n = len(df.collect())
                problem, timing = ("" if n else "no rows"), f"{n} rows (no oracle), spark {time.time() - start:.1f}s"
        except Exception as exc:
            problem, timing = f"{type(exc).__name__}: {str(exc)[:600]}", ""
        bad += bool(problem)
        print(f"{'BAD ' if problem else 'ok  '} {name}: {timing} {problem}", flush=True)
    print(f"{bad} bad")
    sys.exit(bool(bad))
