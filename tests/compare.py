"""Oracle comparison used by the tests and ``tools/oracle_check.py``: a
Spark result and a DuckDB result are equal when they have the same column
names and the same multiset of rows (columns sorted by name, floats
rounded to 6 places, timestamps as ISO text)."""

from __future__ import annotations

import datetime as dt
import decimal
import math

from relcheck.sources.tables import TABLES


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else ("f", round(v, 6))
    if isinstance(v, decimal.Decimal):
        return ("f", round(float(v), 6))
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, int):
        return ("i", v)
    if isinstance(v, dt.datetime):
        return ("t", v.replace(tzinfo=None).isoformat())
    if isinstance(v, dt.date):
        return ("d", v.isoformat())
    if isinstance(v, (list, tuple)):
        return ("l", tuple(norm(x) for x in v))
    return ("s", str(v))


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark_df, con, sql: str) -> list[str]:
    """Empty list when equal, else the reasons."""
    scols = spark_df.columns
    srows = [tuple(r) for r in spark_df.collect()]
    rel = con.sql(sql)
    ocols, orows = rel.columns, rel.fetchall()
    msg = []
    if sorted(scols) != sorted(ocols):
        msg.append(f"cols spark={sorted(scols)} oracle={sorted(ocols)}")
    if len(srows) != len(orows):
        msg.append(f"rows spark={len(srows)} oracle={len(orows)}")
    if not msg:
        a, b = rows_of(scols, srows), rows_of(ocols, orows)
        if a != b:
            diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
            msg.append(f"values differ e.g. {diff}")
    return msg
