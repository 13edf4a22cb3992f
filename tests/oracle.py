"""Runs a query and its SQL and compares the rows as unordered values."""

from __future__ import annotations

import duckdb
from pyspark.sql import SparkSession

from pagetables.plans import catalog  # noqa: F401
from pagetables.plans.registry import PLANS

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

# Names of one type in the two engines.
SAME_TYPE = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
}


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def difference(spark: SparkSession, con: duckdb.DuckDBPyConnection, folder: str, name: str) -> str | None:
    """What differs between the two engines, or None."""
    found = PLANS[name].build(spark, folder)
    wanted = con.execute(PLANS[name].oracle)
    kinds = {d[0]: str(d[1]) for d in wanted.description}
    if sorted(found.columns) != sorted(kinds):
        return f"columns {sorted(found.columns)} against {sorted(kinds)}"
    types = {f.name: SAME_TYPE.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in found.schema}
    wrong = {c: (types[c], kinds[c]) for c in types if types[c] != kinds[c]}
    if wrong:
        return f"types {wrong}"
    columns = sorted(types)
    place = [list(kinds).index(c) for c in columns]
    right = sorted((tuple(row[i] for i in place) for row in wanted.fetchall()), key=repr)
    left = sorted((tuple(r) for r in found.select(*columns).collect()), key=repr)
    if len(left) != len(right):
        return f"{len(left)} rows against {len(right)}; e.g. {left[:2]} | {right[:2]}"
    for a, b in zip(left, right, strict=True):
        if a != b:
            return f"{columns}: {a} against {b}"
    return None if left else "no rows"
