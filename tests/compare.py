"""Compare a Spark result with a SQL result: columns by name, rows as a multiset."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = """region nation customer supplier part orders lineitem events documents embeddings
pages benchmark labels conversations""".split()

SPARK_KINDS = {
    "int": "int32",
    "bigint": "int64",
    "double": "float64",
    "float": "float32",
    "string": "text",
    "boolean": "bool",
}
DUCK_KINDS = {
    "INTEGER": "int32",
    "BIGINT": "int64",
    "DOUBLE": "float64",
    "FLOAT": "float32",
    "VARCHAR": "text",
    "BOOLEAN": "bool",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
        )
    return connection


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return value + 0.0
    return value


def _rows(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(df, connection, sql: str) -> str | None:
    """What differs, or None."""
    relation = connection.sql(sql)
    duck_types = {
        name: DUCK_KINDS.get(str(kind), str(kind))
        for name, kind in zip(relation.columns, relation.types)
    }
    spark_types = {name: SPARK_KINDS.get(kind, kind) for name, kind in df.dtypes}
    if spark_types != duck_types:
        return f"schema: spark {spark_types} sql {duck_types}"
    ours = _rows(df.columns, df.collect())
    theirs = _rows(relation.columns, relation.fetchall())
    if ours == theirs:
        return None
    extra, absent = ours - theirs, theirs - ours
    return (
        f"rows: spark {sum(ours.values())} sql {sum(theirs.values())}; "
        f"only spark {sum(extra.values())}: {list(extra)[:3]}; "
        f"only sql {sum(absent.values())}: {list(absent)[:3]}"
    )
