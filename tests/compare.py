"""Order-blind comparison of a Spark result with SQL run by DuckDB."""

import decimal
import math
from pathlib import Path

import duckdb

TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "decimal(38,10)": "DECIMAL(38,10)",
}


def connect(sf_dir):
    connection = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(round(value, 9))
    if isinstance(value, decimal.Decimal):
        return str(value.normalize())
    return None if value is None else str(value)


def ordered(names, rows):
    places = [names.index(n) for n in sorted(names)]
    return sorted((tuple(plain(r[i]) for i in places) for r in rows), key=str)


def assert_same(df, connection, sql):
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    assert sorted(names) == sorted(df.columns)
    assert {n: TYPES[t] for n, t in df.dtypes} == types
    assert ordered(df.columns, df.collect()) == ordered(names, result.fetchall())
