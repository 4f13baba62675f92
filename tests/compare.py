"""Run every query against its SQL oracle: python tests/compare.py [sf_dir] [query ...]"""

import math
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# Spark type -> DuckDB type a result column must have.
TYPES = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN",
}


def connect(sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _bag(rows):
    def value(v):
        return "nan" if isinstance(v, float) and math.isnan(v) else v

    return Counter(tuple(map(value, row)) for row in rows)


def differences(spark, con, sf_dir, query, sql):
    """Empty if both engines agree on columns, types and rows."""
    df = query(spark, sf_dir)
    columns = sorted(df.columns)
    ours = _bag(df.select(*columns).collect())
    relation = con.sql(sql)
    quoted = ", ".join(f'"{c}"' for c in sorted(relation.columns))
    relation = relation.project(quoted)
    found = []
    if columns != relation.columns:
        return [f"columns {columns} != {relation.columns}"]
    types = [TYPES.get(t, t) for _, t in sorted(df.dtypes)]
    if types != [str(t) for t in relation.types]:
        found.append(f"types {list(zip(columns, types, map(str, relation.types)))}")
    theirs = _bag(relation.fetchall())
    if ours != theirs:
        found.append(
            f"{sum(ours.values())} rows, {sum(theirs.values())} expected; "
            f"extra {list((ours - theirs).items())[:2]}, missing {list((theirs - ours).items())[:2]}"
        )
    elif not ours:
        found.append("no rows")
    return found


if __name__ == "__main__":
    import __spark_entry__ as entry
    from tests.session import session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark, con = session(), connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    print("without oracle:", sorted(set(queries) - set(oracles)), sorted(set(oracles) - set(queries)))
    for name, query in queries.items():
        if name not in oracles or wanted and name not in wanted:
            continue
        start = time.time()
        result = differences(spark, con, sf_dir, query, oracles[name])
        print(f"{name}: {'ok' if not result else result} ({time.time() - start:.1f} s)", flush=True)
