"""Compare every query with its SQL on the same tables.

    python -m tests.compare SF_DIR [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def oracle_rows(sf_dir: str, sql: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    return names, result.fetchall()


def bag(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def difference(spark_df, sf_dir: str, sql: str) -> str | None:
    """None if the rows agree, else a short account of what differs."""
    names, expected = oracle_rows(sf_dir, sql)
    rows = [tuple(r) for r in spark_df.collect()]
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} instead of {sorted(names)}"
    got, want = bag(spark_df.columns, rows), bag(names, expected)
    if got == want:
        return None
    extra, missing = got - want, want - got
    return f"{len(rows)} rows instead of {len(expected)}; extra {list(extra)[:3]}; missing {list(missing)[:3]}"


def main(sf_dir: str, only) -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry
    from tidemark.session import remove_tables

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    oracle, failures = entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            if name in oracle:
                problem = difference(df, sf_dir, oracle[name])
            else:
                problem = f"no SQL, {df.count()} rows"
        except Exception as failure:
            problem = f"{type(failure).__name__}: {failure}"[:600]
        failures += problem is not None
        print(f"{name:32s} {time.time() - start:6.2f}s  {problem or 'ok'}", flush=True)
    remove_tables(spark)
    spark.stop()
    return failures


if __name__ == "__main__":
    sys.exit(min(main(sys.argv[1], sys.argv[2:]), 1))
