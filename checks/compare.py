"""Run queries against their SQL texts: python -m checks.compare [sf_dir] [name ...]"""

from __future__ import annotations

import sys
import time

import duckdb

from checks import all_queries
from marquee.session import local_session

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def _canon(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(repr(r[i]) for i in order) for r in rows))


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    queries, oracles = all_queries()
    spark = local_session("compare", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    bad = 0
    for name, fn in queries.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf)
            got = df.collect()
        except Exception as e:  # report and go on with the other queries
            print(f"ERROR {name}: {type(e).__name__} {str(e)[:600]}", flush=True)
            bad += 1
            continue
        t1 = time.time()
        if name not in oracles:
            print(f"rows  {name}: {len(got)} rows {t1 - t0:.1f}s", flush=True)
            continue
        try:
            rel = con.execute(oracles[name])
        except duckdb.Error as e:
            print(f"SQL   {name}: {str(e)[:500]}", flush=True)
            bad += 1
            continue
        cols = [d[0] for d in rel.description]
        types = [str(d[1]) for d in rel.description]
        want = rel.fetchall()
        a, b = _canon([tuple(r) for r in got], df.columns), _canon(want, cols)
        ok = sorted(df.columns) == sorted(cols) and a == b
        bad += not ok
        print(f"{'ok   ' if ok else 'DIFF '} {name}: {len(got)} vs {len(want)} rows, spark {t1 - t0:.1f}s duckdb {time.time() - t1:.1f}s", flush=True)
        spark_types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        same = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "smallint": "SMALLINT"}
        for c, t in zip(cols, types):
            if c in spark_types and same.get(spark_types[c], t) != t:
                print(f"      type {c}: {spark_types[c]} vs {t}")
        if not ok:
            print("     ", sorted(df.columns), sorted(cols))
            sa, sb = set(a), set(b)
            for r in sorted(sa - sb)[:3]:
                print("      spark ", r)
            for r in sorted(sb - sa)[:3]:
                print("      duckdb", r)
    print("failed:", bad)


if __name__ == "__main__":
    main()
