"""Run registered queries next to their DuckDB twins and compare every value.

usage: python -m checks.compare FOLDER [name ...]
"""

from __future__ import annotations

import glob
import os
import sys
import tempfile
import time

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from checks.registry import ORACLES, QUERIES


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="claimweave-warehouse-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)]
    text = df.apply(lambda c: c.map(lambda v: "∅" if v is None or v != v else repr(v + 0.0) if isinstance(v, float) else str(v)))
    return text.sort_values(list(text.columns)).reset_index(drop=True)


def difference(ours: pd.DataFrame, theirs: pd.DataFrame) -> str | None:
    """What differs, or None."""
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} / {sorted(theirs.columns)}"
    kinds = [c for c in ours.columns if ours[c].dtype.kind != theirs[c].dtype.kind and len(ours)]
    if kinds:
        return "types " + ", ".join(f"{c}: {ours[c].dtype}/{theirs[c].dtype}" for c in kinds)
    if len(ours) != len(theirs):
        return f"rows {len(ours)} / {len(theirs)}"
    a, b = canonical(ours), canonical(theirs)
    wrong = [c for c in a.columns if not (a[c] == b[c]).all()]
    if wrong:
        rows = (a[wrong] != b[wrong]).any(axis=1)
        return f"{int(rows.sum())} rows differ in {wrong}\n{a[rows].head(3).to_string()}\n{b[rows].head(3).to_string()}"
    return None


def main(folder: str, names: list[str]) -> int:
    spark, con, bad = session(), connect(folder), 0
    for name in names or QUERIES:
        start = time.time()
        try:
            ours = QUERIES[name](spark, folder).toPandas()
            middle = time.time()
            if name not in ORACLES:
                print(f"ROWS {name}: {len(ours)} rows, {middle - start:.1f}s", flush=True)
                continue
            theirs = con.execute(ORACLES[name]).df()
            problem = difference(ours, theirs)
        except Exception as exc:  # report and go on with the next query
            problem, ours, middle = f"{type(exc).__name__}: {str(exc)[:600]}", [], time.time()
        bad += problem is not None
        print(f"{'FAIL' if problem else 'OK  '} {name}: {len(ours)} rows, {middle - start:.1f}s / {time.time() - middle:.1f}s {problem or ''}", flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
