"""Run registered queries against their SQL: python -m checks.compare [sf_dir] [name ...]"""

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

from replycast.session import build_session

from .oracle import oracle_sql
from .registry import QUERIES


def views(sf_dir):
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _value(v):
    """Cell as comparable text: missing values alike, whole and broken numbers alike."""
    if v is None or pd.isna(v):
        return "null"
    if isinstance(v, (int, float)) or hasattr(v, "dtype"):
        return repr(float(v))
    return str(v)


def _plain(frame):
    """Columns in name order and rows sorted, as lists of text."""
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted([_value(v) for v in row] for row in frame.itertuples(index=False, name=None))


def _kind(column):
    """Type of a column, None if missing values hide it."""
    return None if column.isna().any() else column.map(type).mode().iloc[0].__name__ if len(column) else None


def differences(spark, con, name, sf_dir):
    """Rows of the query and a short text on the first difference, or None."""
    sql = oracle_sql().get(name)
    mine = QUERIES[name](spark, sf_dir).toPandas()
    if sql is None:
        return len(mine), None
    other = con.execute(sql).fetchdf()
    if sorted(mine.columns) != sorted(other.columns):
        return len(mine), f"columns {sorted(set(mine.columns) ^ set(other.columns))}"
    kinds = {n: (_kind(mine[n]), _kind(other[n])) for n in mine.columns}
    if odd := {n: k for n, k in kinds.items() if None not in k and k[0] != k[1]}:
        return len(mine), f"types {odd}"
    if len(mine) != len(other):
        return len(mine), f"{len(mine)} rows against {len(other)}"
    names = sorted(mine.columns)
    rows = zip(_plain(mine), _plain(other))
    bad = [(a, b) for a, b in rows if a != b]
    if bad:
        cells = [(n, a, b) for n, a, b in zip(names, *bad[0]) if a != b]
        return len(mine), f"{len(bad)} rows, first {str(cells)[:400]}"
    return len(mine), None


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(
        master="local[8]",
        conf={
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = views(sf_dir)
    failed = 0
    for name in sys.argv[2:] or QUERIES:
        start = time.time()
        try:
            rows, bad = differences(spark, con, name, sf_dir)
        except Exception as error:  # report and go on with the next query
            rows, bad = 0, f"{type(error).__name__}: {str(error)[:1500]}"
        failed += bad is not None
        mark = "rows only" if name not in oracle_sql() else "equal"
        print(f"{name:20} {rows:8} rows {time.time() - start:6.1f} s  {bad or mark}", flush=True)
    print(f"{failed} differ")
    return failed


if __name__ == "__main__":
    sys.exit(main() > 0)
