"""Run catalogue queries on Spark and their SQL twins on DuckDB, and compare.

    python tests/compare.py [sf_dir] [query ...]
"""

import decimal
import math
import os
import sys
import time

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def cell(v):
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, decimal.Decimal):
        return f"{v.normalize():f}"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(0.0 if v == 0 else v)
    return str(v)


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(cell(r[i]) for i in order) for r in rows)


def spark_result(df):
    return normal(df.columns, [tuple(r) for r in df.collect()])


def duck_result(con, sql):
    cursor = con.execute(sql)
    return normal([c[0] for c in cursor.description], cursor.fetchall())


def difference(left, right):
    """None if equal, else a short description."""
    if left[0] != right[0]:
        return f"columns {left[0]} != {right[0]}"
    a, b = left[1], right[1]
    if a == b:
        return None
    only_a, only_b = set(a) - set(b), set(b) - set(a)
    return (f"rows {len(a)} / {len(b)}, only spark {len(only_a)}: {sorted(only_a)[:2]}, "
            f"only sql {len(only_b)}: {sorted(only_b)[:2]}")


def main(argv):
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    sys.path.insert(0, here)
    import __spark_entry__ as entry
    from ledgerwatch.session import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session("compare", "local[8]", 8, **{
        "spark.ui.enabled": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = duck(sf_dir), entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if argv[1:] and not any(name.startswith(p) for p in argv[1:]):
            continue
        start = time.time()
        try:
            left = spark_result(fn(spark, sf_dir))
            took = time.time() - start
            problem = difference(left, duck_result(con, sql[name])) if name in sql else None
        except Exception as e:  # report and go on with the next query
            took, left, problem = time.time() - start, ([], []), f"{type(e).__name__}: {e}"[:900]
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} rows={len(left[1])} {took:.1f}s "
              f"{problem or ''}", flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
