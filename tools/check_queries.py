"""Run the catalogue on one data folder and compare each query with its DuckDB twin.

    python tools/check_queries.py /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import datetime
import math
import sys
import time
from decimal import Decimal
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

from starmill.catalog import ORACLES, QUERIES  # noqa: E402
from starmill.session import build_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    """DuckDB with the tables as views and UTC dates."""
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def normalise(value):
    if isinstance(value, Decimal):
        raise TypeError("decimal result")
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def canonical(names, rows):
    """Rows with columns by name, in a stable order."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(normalise(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(out, key=repr)


def compare(con, df, sql):
    """None when Spark and DuckDB agree, else a description of the difference."""
    spark_names, spark_rows = canonical(df.columns, df.collect())
    relation = con.sql(sql)
    names, rows = canonical(relation.columns, relation.fetchall())
    if spark_names != names:
        return f"columns {spark_names} against {names}"
    if len(spark_rows) != len(rows):
        return f"{len(spark_rows)} rows against {len(rows)}"
    for ours, theirs in zip(spark_rows, rows, strict=True):
        if ours != theirs:
            return f"{ours} against {theirs}"[:600]
    kinds = [{type(v) for v in column if v is not None} for column in zip(*spark_rows)]
    other = [{type(v) for v in column if v is not None} for column in zip(*rows)]
    if kinds != other:
        return f"types {kinds} against {other}"
    return None


def main(sf_dir: str, names: list[str]) -> int:
    spark = build_session(
        "check", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(sf_dir), []
    for name in names or QUERIES:
        started = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            if name in ORACLES:
                problem = compare(con, df, ORACLES[name])
                result = problem or "same"
            else:
                problem, result = None, f"{len(df.collect())} rows, no SQL"
        except Exception as error:  # noqa: BLE001
            problem = result = str(error)[:600]
        if problem:
            failed.append(name)
        mark = "FAIL" if problem else "ok"
        print(f"{mark:5}{name:22}{time.time() - started:6.2f}s  {result}", flush=True)
    print(f"{len(names or QUERIES) - len(failed)} ok, failed: {failed}")
    return len(failed)


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
