"""Compare registered queries with their SQL on one set of tables.

python tests/check_oracles.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from tallyloom.queries import ORACLES, QUERIES  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def oracle_rows(con, sql):
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], [tuple(r[i] for i in order) for r in rel.fetchall()]


def spark_rows(df):
    order = sorted(range(len(df.columns)), key=lambda i: df.columns[i])
    return [df.columns[i] for i in order], [tuple(r[i] for i in order) for r in df.collect()]


def key(row):
    return tuple("" if v is None else repr(float(v)) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v) for v in row)


def compare(spark, con, sf_dir, name):
    """Empty text when equal, else what differs."""
    cols, rows = spark_rows(QUERIES[name](spark, sf_dir))
    if name not in ORACLES:
        return "" if rows else "no rows"
    want_cols, want = oracle_rows(con, ORACLES[name])
    if cols != want_cols:
        return f"columns {cols} != {want_cols}"
    got_k, want_k = sorted(map(key, rows)), sorted(map(key, want))
    if got_k == want_k:
        return "" if rows else "no rows"
    extra, missing = sorted(set(got_k) - set(want_k))[:3], sorted(set(want_k) - set(got_k))[:3]
    return f"rows {len(rows)} != {len(want)}; only spark {extra}; only sql {missing}"


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def main(argv):
    from tallyloom.session import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            note = compare(spark, con, sf_dir, name)
        except Exception as e:
            note = "ERROR " + "".join(traceback.format_exception_only(e))[:1500]
        bad += bool(note)
        print(f"{'FAIL' if note else 'ok  '} {name} {time.time() - start:.1f}s {note}", flush=True)
    print(f"{len(names) - bad}/{len(names)} equal")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
