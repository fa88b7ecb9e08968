"""Compare a registered query with its SQL on the same files."""

import glob
import os

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def normal(value):
    if isinstance(value, float):
        return round(value, 9) + 0.0
    return value


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(normal(r[i]) for i in order) for r in rows), key=repr)


def compare(con, df, sql):
    """Differences as text, empty if equal."""
    result = con.execute(sql)
    want_columns = [d[0] for d in result.description]
    want = result.fetchall()
    got = [tuple(r) for r in df.collect()]
    if sorted(df.columns) != sorted(want_columns):
        return f"columns {sorted(df.columns)} != {sorted(want_columns)}"
    a, b = sorted_rows(df.columns, got), sorted_rows(want_columns, want)
    if len(a) != len(b):
        return f"{len(a)} rows != {len(b)}"
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    if wrong:
        return f"{len(wrong)} of {len(a)} rows differ, first {wrong[:3]}"
    kinds = {"INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "HUGEINT": "hugeint",
             "TIMESTAMP": "timestamp_ntz", "BOOLEAN": "boolean", "DATE": "date"}
    types = dict(df.dtypes)
    for d in result.description:
        kind = kinds.get(str(d[1]), str(d[1]))
        if types[d[0]] != kind:
            return f"type of {d[0]}: {types[d[0]]} != {kind}"
    return ""
