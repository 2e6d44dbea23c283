"""Value-by-value comparison of a Spark frame with a DuckDB query, blind to row order."""

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(value):
    return "nan" if isinstance(value, float) and math.isnan(value) else repr(value)


def canonical(columns, rows):
    """Columns by name, rows as text, sorted."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        tuple(_cell(row[i]) for i in order) for row in rows
    )


def spark_result(df):
    return canonical(df.columns, [tuple(r) for r in df.collect()])


def duck_result(con, sql):
    cursor = con.execute(sql)
    return canonical([d[0] for d in cursor.description], cursor.fetchall())
