"""Runs a query in Spark and its SQL in DuckDB and compares rows, names and types."""

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# Spark types and the DuckDB types that hold the same values.
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def connect(folder):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    return connection


def normal(rows):
    return sorted(rows, key=repr)


def compare(name, frame, connection, sql):
    """Differences as text, or None."""
    result = connection.execute(sql)
    expected_types = {column[0]: str(column[1]) for column in result.description}
    expected_columns = sorted(expected_types)
    if sorted(frame.columns) != expected_columns:
        return f"columns {sorted(frame.columns)} != {expected_columns}"
    for column, kind in frame.dtypes:
        want = TYPES.get(kind, kind.upper().replace(" ", ""))
        if want != expected_types[column].replace(" ", ""):
            return f"type of {column}: {kind} != {expected_types[column]}"
    order = [[column[0] for column in result.description].index(c) for c in expected_columns]
    expected = normal([tuple(row[i] for i in order) for row in result.fetchall()])
    got = normal([tuple(row) for row in frame.select(*expected_columns).collect()])
    if len(got) != len(expected):
        return f"{len(got)} rows, not {len(expected)}"
    for a, b in zip(got, expected):
        if a != b:
            return f"{a} != {b}"
    return None
