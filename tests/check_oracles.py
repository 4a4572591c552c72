"""Run registered queries against their SQL on one table folder: python tests/check_oracles.py [folder] [query ...]."""

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir):
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def comparable(frame):
    """Rows as sorted tuples of plain values, columns by name."""
    frame = frame[sorted(frame.columns)].astype(object)
    frame = frame.where(frame.notna(), None)
    rows = [tuple(_value(value) for value in row) for row in frame.itertuples(index=False)]
    return sorted(rows, key=lambda row: tuple((value is not None, str(value)) for value in row))


def _value(value):
    if value is None:
        return None
    if hasattr(value, "isoformat"):
        return pd.Timestamp(value).isoformat()
    if isinstance(value, float):
        return round(value, 9)
    return value.item() if hasattr(value, "item") else value


def difference(spark, sf_dir, name, query, sql, connection):
    """None when both sides agree, else a short description."""
    actual, expected = query(spark, sf_dir).toPandas(), connection.execute(sql).df()
    if sorted(actual.columns) != sorted(expected.columns):
        return f"columns {sorted(actual.columns)} instead of {sorted(expected.columns)}"
    left, right = comparable(actual), comparable(expected)
    if left == right:
        return None
    only_left = [row for row in left if row not in set(right)][:3]
    only_right = [row for row in right if row not in set(left)][:3]
    return f"{len(left)} rows instead of {len(right)}; only here {only_left}; only there {only_right}"


def main():
    from pyspark.sql import SparkSession

    import __spark_entry__ as driver
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    connection, oracle = connect(sf_dir), driver.oracle_sql()
    failed = 0
    for name, query in driver.queries().items():
        if wanted and name not in wanted:
            continue
        started = time.time()
        try:
            if name in oracle:
                problem = difference(spark, sf_dir, name, query, oracle[name], connection)
            else:
                problem = None if query(spark, sf_dir).count() >= 0 else "no rows"
        except Exception as error:  # report and go on with the other queries
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - started:.1f}s {'' if name in oracle else '(rows only)'}"
              f" {problem or ''}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main()
