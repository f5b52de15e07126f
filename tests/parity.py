"""Compare registered queries with their oracle SQL.

``python tests/parity.py sf_dir [name-prefix …] [spark.setting=value …]`` prints one
line per query.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        if not Path(f"{sf_dir}/{t}.parquet").exists():
            continue
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return "decimal", str(value)
    if isinstance(value, bool):
        return "bool", str(value)
    if isinstance(value, float):
        return "float", "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, dt.datetime):
        return "ts", value.isoformat()
    if value is None:
        return "null", ""
    return type(value).__name__, str(value)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def oracle_rows(con, sql: str):
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    return columns, rows_of(columns, cur.fetchall())


def spark_rows(frame):
    return frame.columns, rows_of(frame.columns, [tuple(r) for r in frame.collect()])


def difference(spark_side, duck_side) -> str:
    """Empty when equal."""
    (sc, sr), (dc, dr) = spark_side, duck_side
    if sorted(sc) != sorted(dc):
        return f"columns {sorted(sc)} != {sorted(dc)}"
    if len(sr) != len(dr):
        return f"rows {len(sr)} != {len(dr)}"
    bad = [(a, b) for a, b in zip(sr, dr) if a != b]
    return f"{len(bad)} of {len(sr)} rows differ, e.g.\n  spark {bad[0][0]}\n  duck  {bad[0][1]}" if bad else ""


def main() -> int:
    import __spark_entry__ as contract
    from lendscope.session import build_session

    sf_dir = sys.argv[1]
    extra = dict(a.split("=", 1) for a in sys.argv[2:] if "=" in a)
    prefixes = [a for a in sys.argv[2:] if "=" not in a]
    spark = build_session("parity", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", **extra})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    oracle = contract.oracle_sql()
    failed = 0
    for name, query in contract.queries().items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        started = time.time()
        try:
            got = spark_rows(query(spark, sf_dir))
            note = difference(got, oracle_rows(con, oracle[name])) if name in oracle else "(rows only)"
            size = len(got[1])
        except Exception as error:  # noqa: BLE001
            note, size = f"{type(error).__name__}: {str(error)[:1500]}", -1
        failed += bool(note) and note != "(rows only)"
        print(f"{name:28s} {size:7d} rows {time.time() - started:6.2f}s {'ok' if not note else note}", flush=True)
    print(f"{failed} failed")
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
