"""Compare registered queries with their SQL on the same parquet files."""

from __future__ import annotations

import os
import sys
import time

import duckdb

NAMES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
         "benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for n in NAMES:
        con.execute(f"CREATE VIEW {n} AS SELECT * FROM '{sf_dir}/{n}.parquet'")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and v != v):
        return None
    return repr(v) if isinstance(v, float) else str(v)


def table(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted(tuple(_cell(r[i]) or "" for i in order) for r in rows)


def compare(spark, con, fn, sql, sf_dir):
    df = fn(spark, sf_dir)
    got_cols, got = table(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    types = {d[0]: str(d[1]) for d in cur.description}
    want_cols, want = table(names, cur.fetchall())
    problems = []
    if got_cols != want_cols:
        problems.append(f"columns {got_cols} != {want_cols}")
    kinds = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    for name, t in df.dtypes:
        if name in types and kinds.get(t) != types[name]:
            problems.append(f"type of {name}: {t} against {types[name]}")
    if len(got) != len(want):
        problems.append(f"rows {len(got)} != {len(want)}")
    if got != want:
        only_got = [r for r in got if r not in set(want)][:3]
        only_want = [r for r in want if r not in set(got)][:3]
        problems.append(f"values differ: spark {only_got} sql {only_want}")
    if not got:
        problems.append("no rows")
    return problems, len(got)


def main() -> int:
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    sys.path.insert(0, here)
    import __spark_entry__ as entry
    from tidemark.session import build_session

    sf = os.environ.get("SF", "/root/testdata/sf0.01")
    pick = sys.argv[1:]
    spark = build_session("oracle", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
                                                   "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    qs, sqls, bad = entry.queries(), entry.oracle_sql(), 0
    for name in sorted(qs):
        if pick and not any(name.startswith(p) for p in pick):
            continue
        t = time.time()
        try:
            if name in sqls:
                problems, n = compare(spark, con, qs[name], sqls[name], sf)
            else:
                n, problems = qs[name](spark, sf).count(), []
                if n == 0:
                    problems = ["no rows"]
        except Exception as e:  # noqa: BLE001
            problems, n = [f"{type(e).__name__}: {str(e)[:600]}"], -1
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} rows={n} {time.time() - t:.1f}s {'' if name in sqls else '(no sql) '}{' | '.join(problems)[:900]}", flush=True)
    print("failed", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
