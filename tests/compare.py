"""Run the registered queries beside their DuckDB SQL and compare whole results."""

import datetime
import decimal
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def database(folder):
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return db


def _plain(value):
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, decimal.Decimal):
        return format(value, "f")
    if isinstance(value, datetime.datetime):
        return value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return str(value)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in data)


def differences(spark, db, query, sql, folder):
    """(only in Spark, only in SQL, rows); columns must have the same names."""
    df = query(spark, folder)
    ours = rows(df.columns, df.collect())
    cursor = db.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = rows(names, cursor.fetchall())
    assert sorted(df.columns) == sorted(names), (sorted(df.columns), sorted(names))
    return ours - theirs, theirs - ours, sum(ours.values())


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    from ratebook.oracle import ORACLE
    from ratebook.queries import QUERIES

    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    data = sys.argv[1]
    chosen = sys.argv[2:] or list(QUERIES)
    base = database(data)
    for name in chosen:
        began = time.time()
        try:
            more, less, count = differences(session, base, QUERIES[name], ORACLE[name], data)
            state = "ok" if not more and not less else f"DIFF +{sum(more.values())} -{sum(less.values())}"
            print(f"{name}: {state} rows={count} {time.time() - began:.1f}s", flush=True)
            if more or less:
                print("   spark:", *list(more)[:2], sep="\n     ")
                print("   sql:  ", *list(less)[:2], sep="\n     ")
        except Exception as error:  # report and go on
            print(f"{name}: ERROR {str(error)[:1500]}", flush=True)
