"""Compare registered queries with their SQL in DuckDB, order-insensitively."""

from __future__ import annotations

import math
import sys
import time

import duckdb

from __spark_entry__ import oracle_sql, queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _key(row):
    return tuple((v is not None, str(type(v)), v) if not isinstance(v, bool) else (True, "b", int(v)) for v in row)


def _plain(rows):
    return [tuple(v.isoformat() if hasattr(v, "isoformat") else v for v in row) for row in rows]


def compare(spark, con, name: str, sf_dir: str) -> str | None:
    """None if both sides agree, else what differs."""
    mine = queries()[name](spark, sf_dir)
    columns = sorted(mine.columns)
    got = sorted(_plain(tuple(r) for r in mine.select(*columns).collect()), key=_key)
    sql = oracle_sql()[name]
    found = sorted(d[0] for d in con.execute(f"DESCRIBE {sql}").fetchall())
    if found != columns:
        return f"columns {columns} != {found}"
    names = ", ".join(f'"{c}"' for c in columns)
    want = sorted(_plain(con.execute(f"SELECT {names} FROM ({sql})").fetchall()), key=_key)
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    for a, b in zip(got, want):
        if [type(v) for v in a] != [type(v) for v in b]:
            return f"types {a} != {b}"
        if a != b and not all(x == y or (isinstance(x, float) and math.isnan(x) and math.isnan(y)) for x, y in zip(a, b)):
            return f"values {a} != {b}"
    return None


if __name__ == "__main__":
    from paytrail.session import get_spark

    directory = sys.argv[1]
    names = sys.argv[2:] or list(oracle_sql())
    session = get_spark("oracle", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.master": "local[8]"})
    session.sparkContext.setLogLevel("ERROR")
    db = connect(directory)
    bad = 0
    for n in names:
        began = time.time()
        try:
            problem = compare(session, db, n, directory)
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{n:36s} {time.time() - began:6.2f}s {'ok' if problem is None else problem}", flush=True)
    sys.exit(bad)
