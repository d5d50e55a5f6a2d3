"""Run a catalog query on Spark and its SQL on DuckDB, and compare the rows."""

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        if os.path.exists(f"{sf_dir}/{name}.parquet"):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = [tuple(row[i] for i in order) for row in rows]
    return [columns[i] for i in order], sorted(rows, key=lambda r: tuple((v is None, str(type(v)), v) for v in r))


def spark_rows(df):
    table = df.toArrow()
    columns = [c.to_pylist() for c in table.columns]
    return _sorted(table.column_names, list(zip(*columns)) if columns else [])


def duck_rows(con, sql):
    cursor = con.execute(sql)
    return _sorted([d[0] for d in cursor.description], cursor.fetchall())


def same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return a == b or (math.isnan(a) and math.isnan(b))
    return type(a) is type(b) and a == b


def differences(ours, theirs):
    """Messages about the first differences; empty if there are none."""
    if ours[0] != theirs[0]:
        return [f"columns {ours[0]} <> {theirs[0]}"]
    found = [f"{len(ours[1])} <> {len(theirs[1])} rows"] if len(ours[1]) != len(theirs[1]) else []
    for a, b in zip(ours[1], theirs[1]):
        if not all(same(x, y) for x, y in zip(a, b)):
            found.append(f"{str(a)[:300]} <> {str(b)[:300]}")
            if len(found) >= 3:
                break
    return found
