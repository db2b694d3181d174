"""Runs a query in Spark and its SQL in DuckDB and compares names, types and values."""

from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir):
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return db


# Spark type name -> DuckDB type name.
TYPES = {
    "int": "INTEGER", "bigint": "BIGINT", "smallint": "SMALLINT", "string": "VARCHAR", "double": "DOUBLE",
    "date": "DATE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
}


def spark_type(name):
    return name.upper() if name.startswith("decimal") else TYPES[name]


def plain(value):
    if isinstance(value, Decimal):
        return str(value)
    if isinstance(value, float):
        return float(f"{value:.10g}")
    return value


def compare(frame, sf_dir, sql):
    """A list of differences between a frame and the SQL's result; empty when they agree."""
    order = sorted(range(len(frame.columns)), key=lambda i: frame.columns[i])
    ours_types = [(frame.columns[i], spark_type(frame.dtypes[i][1])) for i in order]
    with connect(sf_dir) as db:
        result = db.execute(sql)
        names = [c[0] for c in result.description]
        theirs_types = sorted((c[0], str(c[1])) for c in result.description)
        rows = result.fetchall()
    problems = []
    if ours_types != theirs_types:
        problems.append(f"schema: spark {ours_types} sql {theirs_types}")
    if sorted(names) != sorted(frame.columns):
        return problems
    back = sorted(range(len(names)), key=lambda i: names[i])
    ours = Counter(tuple(plain(row[i]) for i in order) for row in frame.collect())
    theirs = Counter(tuple(plain(row[i]) for i in back) for row in rows)
    if not theirs:
        problems.append("the comparison has no rows")
    if ours != theirs:
        only_ours, only_theirs = ours - theirs, theirs - ours
        problems.append(f"rows: spark {sum(ours.values())}, sql {sum(theirs.values())}")
        problems.append(f"only spark {list(only_ours)[:2]}, only sql {list(only_theirs)[:2]}")
    return problems
