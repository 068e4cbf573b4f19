"""Compare registered queries with their SQL twins in DuckDB, as the driver does.

Usage: python -m tests.check [sf_dir] [query ...]
"""

from __future__ import annotations

import hashlib
import sys
import time

import duckdb


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def text(x):
        if isinstance(x, float):
            return repr(round(x, 9))
        return repr(x)

    return [columns[i] for i in order], sorted(
        "|".join(text(r[i]) for i in order) for r in rows)


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry
    from docloom.session import build_session

    sf = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    spark = build_session("check", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in ("region nation customer supplier part orders lineitem events documents embeddings "
              "pages benchmark labels conversations").split():
        con.sql(f"CREATE VIEW {t} AS FROM '{sf}/{t}.parquet'")
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf)
            got = rows_of(df.columns, [tuple(r) for r in df.collect()])
            kinds = {f.name: f.dataType.simpleString() for f in df.schema}
        except Exception as error:
            print(f"ERROR  {name}: {str(error)[:1500]}")
            bad += 1
            continue
        took = time.time() - start
        if name not in oracles:
            print(f"ROWS   {name}: {len(got[1])} rows {took:.1f}s")
            continue
        start = time.time()
        try:
            cur = con.execute(oracles[name])
            desc = [(d[0], str(d[1])) for d in cur.description]
            want = rows_of([d[0] for d in desc], cur.fetchall())
        except Exception as error:
            print(f"SQLERR {name}: {str(error)[:1500]}")
            bad += 1
            continue
        sql_took = time.time() - start
        same = got == want
        print(f"{'ok    ' if same else 'DIFF  '} {name}: {len(got[1])}/{len(want[1])} rows "
              f"{took:.1f}s sql {sql_took:.1f}s "
              f"{hashlib.md5(str(got).encode()).hexdigest()[:6]}")
        simple = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
                  "boolean": "BOOLEAN"}
        for column, kind in desc:
            if column in kinds and simple.get(kinds[column], kinds[column]) != kind:
                print(f"       type {column}: {kinds[column]} vs {kind}")
        if not same:
            bad += 1
            print("   columns", got[0], want[0])
            a, b = set(got[1]) - set(want[1]), set(want[1]) - set(got[1])
            for x in sorted(a)[:2]:
                print("   spark ", x[:600])
            for x in sorted(b)[:2]:
                print("   duckdb", x[:600])
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
