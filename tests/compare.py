"""Run registered queries against their comparison SQL and report differences.

    python tests/compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402


def cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    return value


def canon(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(repr(cell(r[i])) for i in order) for r in rows))


def sql_rows(con, sql):
    cursor = con.execute(sql)
    return [d[0] for d in cursor.description], cursor.fetchall()


def database(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def difference(spark_df, con, sql):
    """None if both sides agree, else a short text."""
    rows = [tuple(r) for r in spark_df.collect()]
    names, expected = sql_rows(con, sql)
    if sorted(spark_df.columns) != sorted(names):
        return f"columns {sorted(spark_df.columns)} vs {sorted(names)}"
    got, want = canon(spark_df.columns, rows), canon(names, expected)
    if got == want:
        return None
    only_got = [g for g in got if g not in set(want)][:2]
    only_want = [w for w in want if w not in set(got)][:2]
    return f"rows {len(got)} vs {len(want)}\n   spark {only_got}\n   sql   {only_want}"


def main(argv):
    import __spark_entry__ as e
    from stallwise.session import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session(
        "compare",
        "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = database(sf_dir)
    oracle, bad = e.oracle_sql(), []
    todo = e.queries()
    unknown = set(oracle) - set(todo)
    if unknown:
        print("SQL without query:", sorted(unknown))
    for name, query in todo.items():
        if argv[1:] and not any(name.startswith(p) for p in argv[1:]):
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            if name in oracle:
                diff, shown = difference(df, con, oracle[name]), df.count
                note = "ok" if diff is None else f"DIFF {diff}"
            else:
                diff, note = None, f"no SQL, {df.count()} rows"
        except Exception as error:  # report and go on with the next query
            diff, note = "error", f"ERROR {str(error)[:700]}"
        if diff:
            bad.append(name)
        print(f"{time.time() - start:6.2f}s {name}: {note}", flush=True)
    print(f"{len(bad)} differ: {bad}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
