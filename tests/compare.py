"""Run queries beside their SQL and compare rows, names and types of columns.

    python tests/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


SPARK_TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
    "DATE": "date",
}


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=lambda r: tuple(map(repr, r)))


def differences(spark_df, con, sql: str) -> list[str]:
    found = [tuple(r) for r in spark_df.collect()]
    result = con.sql(sql)
    wanted = result.fetchall()
    names, wanted_names = spark_df.columns, result.columns
    types = sorted(spark_df.dtypes)
    wanted_types = sorted((n, SPARK_TYPES.get(str(t), str(t))) for n, t in zip(wanted_names, result.types))
    if types != wanted_types:
        return [f"columns {types} != {wanted_types}"]
    if len(found) != len(wanted):
        return [f"{len(found)} rows != {len(wanted)}"]
    a, b = _rows(names, found), _rows(wanted_names, wanted)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    return [f"{len(bad)} of {len(a)} rows differ, first: {bad[0]}"] if bad else []


def main() -> int:
    import __spark_entry__ as entry
    from salesight.session import session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = session(master="local[8]", shuffle_partitions=8, **{"spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, sql = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in sys.argv[2:] or queries:
        start = time.time()
        df = queries[name](spark, sf_dir)
        if name in sql:
            problems = differences(df, con, sql[name])
            state = "; ".join(problems) or "equal"
            failed += bool(problems)
        else:
            state = f"{df.count()} rows"
        print(f"{name:36s} {time.time() - start:6.2f}s  {state}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
