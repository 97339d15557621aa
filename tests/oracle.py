"""Side-by-side run of registered queries and their SQL.

``python tests/oracle.py SF_DIR [name ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def _plain(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v + 0.0) if v != 0 else "0.0"
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return repr(v)


def compare(df, con, sql: str) -> str | None:
    """NULL when rows, columns and values agree, else what differs."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    expected_rows = cur.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    order = sorted(names)
    rows = df.select(*[f"`{c}`" for c in order]).collect()
    got = sorted(tuple(_plain(v) for v in r) for r in rows)
    at = [names.index(c) for c in order]
    expected = sorted(tuple(_plain(r[i]) for i in at) for r in expected_rows)
    if len(got) != len(expected):
        return f"{len(got)} rows vs {len(expected)}"
    for g, e in zip(got, expected):
        if g != e:
            wrong = [c for c, a, b in zip(order, g, e) if a != b]
            return f"{wrong}: {str(g)[:300]} vs {str(e)[:300]}"
    return None


def main(argv):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    folder, names = argv[0], argv[1:]
    con = connect(folder)
    queries, sqls = entry.queries(), entry.oracle_sql()
    for name in names or queries:
        start = time.time()
        try:
            df = queries[name](spark, folder)
            built = time.time() - start
            if name in sqls:
                problem = compare(df, con, sqls[name])
                types = [(r[0], r[1]) for r in con.execute(f"DESCRIBE {sqls[name]}").fetchall()]
                types = " ".join(sorted(f"{c}:{t}" for c, t in types if t in ("HUGEINT",) or "DECIMAL" in t))
            else:
                problem, types = None, f"no sql, {df.count()} rows"
        except Exception as e:  # noqa: BLE001
            problem, built, types = f"{type(e).__name__} {str(e)[:700]}", 0, ""
        print("OK " if problem is None else "BAD", name, f"{built:.1f}+{time.time() - start - built:.1f}s", types, problem or "", flush=True)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
