"""Run registered queries beside their SQL and compare whole results."""

from __future__ import annotations

import datetime as dt
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def sql_rows(sql: str, sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    con.execute("set timezone = 'UTC'")
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    return names, cur.fetchall()


def norm(value):
    if isinstance(value, float):
        return f"{value:.9g}"
    if isinstance(value, (list, tuple)):
        return tuple(norm(v) for v in value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return repr(value) if isinstance(value, bool) else value


def table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(
        (tuple(norm(r[i]) for i in order) for r in rows), key=lambda r: tuple((v is None, str(v)) for v in r)
    )


def differences(spark, name: str, sf_dir: str) -> list[str]:
    from courtside.queries import ORACLE, QUERIES

    df = QUERIES[name](spark, sf_dir)
    got = table(df.columns, [tuple(r) for r in df.collect()])
    want = table(*sql_rows(ORACLE[name], sf_dir))
    if got[0] != want[0]:
        return [f"columns {got[0]} != {want[0]}"]
    out = []
    if len(got[1]) != len(want[1]):
        out.append(f"rows {len(got[1])} != {len(want[1])}")
    a, b = set(got[1]), set(want[1])
    out += [f"only spark {r}" for r in list(a - b)[:3]] + [f"only sql {r}" for r in list(b - a)[:3]]
    if not out and got[1] != want[1]:
        out.append("multiplicity differs")
    return out


if __name__ == "__main__":
    sys.path.insert(0, "/root/repo")
    from courtside.queries import ORACLE, QUERIES
    from courtside.session import build

    spark = build("compare", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                  spark__driver__memory="8g", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    for name in sys.argv[1:] or QUERIES:
        start = time.time()
        try:
            diff = differences(spark, name, sf) if name in ORACLE else [f"(no sql) {QUERIES[name](spark, sf).count()} rows"]
        except Exception as e:  # noqa: BLE001
            diff = [f"{type(e).__name__}: {str(e)[:1500]}"]
        print(f"{'ok  ' if not diff else 'DIFF'} {name} {time.time() - start:.1f}s", *diff, sep="\n     " if diff else " ", flush=True)
