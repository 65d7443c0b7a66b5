"""Run the registered queries next to their SQL and compare rows, columns and values.

    python -m checks.compare /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import glob
import os
import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb
from pyspark.sql import SparkSession

from checks.oracle import FINAL, oracle
from checks.registry import QUERIES


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _plain(v):
    if isinstance(v, (float, Decimal)):
        return round(float(v), 6) + 0.0
    return v


def _bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def spark_rows(df) -> tuple[list[str], list]:
    table = df.toArrow()
    return table.column_names, list(zip(*[c.to_pylist() for c in table.columns])) if table.num_columns else []


def compare(spark: SparkSession, con, sf_dir: str, name: str) -> str | None:
    """None when both agree, else what differs."""
    columns, rows = spark_rows(QUERIES[name](spark, sf_dir))
    cursor = con.execute(oracle(name))
    expected = [d[0] for d in cursor.description]
    theirs = cursor.fetchall()
    if sorted(columns) != sorted(expected):
        return f"columns {sorted(set(columns) ^ set(expected))}"
    ours, other = _bag(columns, rows), _bag(expected, theirs)
    if ours != other:
        some = list((ours - other).items())[:2], list((other - ours).items())[:2]
        return f"{len(rows)} rows against {len(theirs)}; only here {some[0]}; only there {some[1]}"
    return None if rows else "no rows"


def local_session() -> SparkSession:
    return (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def main(sf_dir: str, chosen: list[str]) -> int:
    spark, con, bad = local_session(), connect(sf_dir), 0
    spark.sparkContext.setLogLevel("ERROR")
    for name in chosen or list(FINAL):
        start = time.time()
        try:
            difference = compare(spark, con, sf_dir, name)
        except Exception as e:  # report and go on with the next query
            difference = f"{type(e).__name__}: {str(e)[:600]}"
        bad += difference is not None
        print(f"{'ok  ' if difference is None else 'BAD '} {name} {time.time() - start:.1f}s {difference or ''}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
