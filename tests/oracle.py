"""A query's rows and those of its SQL, in a form that can be compared."""

import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    c = duckdb.connect()
    for f in os.listdir(sf_dir):
        c.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{f}'")
    return c


def shown(rows) -> list[tuple]:
    text = lambda v: "null" if v is None or (isinstance(v, float) and math.isnan(v)) else repr(v) if isinstance(v, float) else str(v)
    return sorted(tuple(map(text, r)) for r in rows)


def both(df, sql: str, c: duckdb.DuckDBPyConnection) -> tuple[list[tuple], list[tuple]]:
    columns = sorted(df.columns)
    found = c.sql(sql)
    assert sorted(found.columns) == columns
    return shown(tuple(r[k] for k in columns) for r in df.collect()), shown(found.select(*[f'"{k}"' for k in columns]).fetchall())
