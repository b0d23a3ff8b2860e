"""Compare every query with its SQL: ``python tests/oracle_check.py [sf_dir] [names...]``."""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf_dir):
    import duckdb

    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(x):
        if isinstance(x, float):
            return "nan" if math.isnan(x) else repr(x)
        if isinstance(x, bool) or x is None or isinstance(x, str):
            return x
        return str(x)

    return sorted((tuple(value(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, sf_dir, query, sql):
    """None when both agree, else a short description of the difference."""
    df = query(spark, sf_dir)
    got = canonical(df.columns, df.collect())
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = canonical(names, cursor.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
             "boolean": "BOOLEAN"}
    types = {d[0]: str(d[1]) for d in cursor.description}
    other = {f.name: (f.dataType.simpleString(), types[f.name]) for f in df.schema
             if kinds.get(f.dataType.simpleString()) != types[f.name]}
    if other:
        return f"types {other}"
    if got != expected:
        only = [r for r in got if r not in set(expected)][:3], [r for r in expected if r not in set(got)][:3]
        return f"{len(got)} rows against {len(expected)}; only Spark {only[0]}; only SQL {only[1]}"
    return None


def main():
    import tempfile

    import __spark_entry__ as entry
    from coinwharf.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark = build_session(
        "oracle",
        "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
           "spark.checkpoint.dir": tempfile.mkdtemp(prefix="run-", dir="/tmp")},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for name in names:
        start = time.time()
        sql = entry.oracle_sql().get(name)
        try:
            problem = "no SQL" if sql is None else compare(spark, con, sf_dir, entry.queries()[name], sql)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{name:24s} {time.time() - start:6.1f}s  {problem or 'equal'}", flush=True)
    print(f"{len(names) - bad} of {len(names)} equal")
    spark.stop()


if __name__ == "__main__":
    main()
