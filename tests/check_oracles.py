"""Compare every query with its SQL at a scale factor: python tests/check_oracles.py [sf_dir] [name ...]"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(
        tuple("NaN" if isinstance(r[i], float) and math.isnan(r[i]) else r[i] for i in order)
        for r in rows
    )


def compare(spark, con, make, sql: str, sf_dir: str) -> str:
    """'' if both agree, else what differs."""
    df = make(spark, sf_dir)
    table = df.toArrow()
    expected = con.sql(sql).to_arrow_table()
    if sorted(table.column_names) != sorted(expected.column_names):
        return f"columns {sorted(table.column_names)} / {sorted(expected.column_names)}"
    problems = []
    for name in table.column_names:
        a, b = table.schema.field(name).type, expected.schema.field(name).type
        if a != b:
            problems.append(f"type of {name}: {a} / {b}")
    ours = rows_of(table.column_names, zip(*[c.to_pylist() for c in table.columns]))
    theirs = rows_of(expected.column_names, zip(*[c.to_pylist() for c in expected.columns]))
    if ours != theirs:
        extra, lacking = ours - theirs, theirs - ours
        problems.append(
            f"rows {sum(ours.values())} / {sum(theirs.values())}, only here {sum(extra.values())}: "
            f"{list(extra)[:2]}, only there {sum(lacking.values())}: {list(lacking)[:2]}"
        )
    return "; ".join(problems)


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from daymetrics import session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = session.build("local[8]")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    made, oracles = queries(), oracle_sql()
    print("without SQL:", sorted(set(made) - set(oracles)), "without query:", sorted(set(oracles) - set(made)))
    failed = 0
    for name in sys.argv[2:] or oracles:
        start = time.time()
        try:
            problem = compare(spark, con, made[name], oracles[name], sf_dir)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error).splitlines()[0][:600]}"
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok':5}{name:28}{time.time() - start:6.2f}s  {problem}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
