"""Run registered queries and their SQL on the same tables and compare the rows. ``python -m tests.compare SF_DIR [NAME...]``"""

from __future__ import annotations

import datetime
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings departments topics professors papers authorships ingestion_runs author_profiles harvest_sources eval_items".split()


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def rows_of_sql(sql: str, sf_dir: str) -> tuple[list[str], Counter]:
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = Path(sf_dir, f"{t}.parquet")
        if p.exists():
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{p if p.is_file() else f'{p}/*.parquet'}'")
    r = c.execute(sql)
    names = [d[0] for d in r.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(plain(row[i]) for i in order) for row in r.fetchall())


def rows_of_spark(df) -> tuple[list[str], Counter]:
    cols = sorted(df.columns)
    return cols, Counter(tuple(plain(x) for x in row) for row in df.select(*(f"`{c}`" for c in cols)).collect())


def main(args: list[str]) -> int:
    import __spark_entry__ as entry
    from stemma.session import get_spark

    spark = get_spark(master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="8g", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    queries, sql = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in args[1:] or [n for n in queries if n in sql]:
        t = time.time()
        try:
            a = rows_of_spark(queries[name](spark, args[0]))
            b = rows_of_sql(sql[name], args[0]) if name in sql else a
            ok = a == b
            print("ok  " if ok else "DIFF", name, sum(a[1].values()), round(time.time() - t, 1), flush=True)
            if not ok:
                bad += 1
                print("   columns", a[0], b[0], "rows", sum(a[1].values()), sum(b[1].values()))
                print("   only Spark", list((a[1] - b[1]).items())[:4])
                print("   only SQL", list((b[1] - a[1]).items())[:4])
        except Exception as e:  # noqa: BLE001
            bad += 1
            print("FAIL", name, type(e).__name__, str(e)[:600], flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
