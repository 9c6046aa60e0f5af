"""Run queries next to their SQL: ``python -m checks.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import sys
import time
from glob import glob
from os.path import basename

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from checks.registry import ORACLE, QUERIES

DEFAULT_DIR = "/root/testdata/sf0.01"


def reference_db(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for path in glob(f"{sf_dir}/*.parquet"):
        db.execute(f"create view {basename(path).removesuffix('.parquet')} as select * from '{path}'")
    return db


def canonical(rows: pd.DataFrame) -> list[tuple]:
    """Rows as a sorted multiset over columns in name order, nulls and NaN alike."""
    rows = rows[sorted(rows.columns)]
    return sorted(tuple("" if pd.isna(v) else str(v) for v in row) for row in rows.itertuples(index=False))


def difference(spark: SparkSession, db: duckdb.DuckDBPyConnection, name: str, sf_dir: str) -> str | None:
    """What differs between a query and its SQL, or None."""
    table = QUERIES[name](spark, sf_dir).toArrow()
    expected = db.sql(ORACLE[name]).to_arrow_table()
    if sorted(table.column_names) != sorted(expected.column_names):
        return f"columns {sorted(table.column_names)} and {sorted(expected.column_names)}"
    kinds = [
        f"{field.name}: {field.type} and {expected.schema.field(field.name).type}"
        for field in table.schema
        if str(field.type).removeprefix("large_") != str(expected.schema.field(field.name).type).removeprefix("large_")
    ]
    if kinds:
        return "types " + ", ".join(kinds)
    if table.num_rows != expected.num_rows:
        return f"{table.num_rows} and {expected.num_rows} rows"
    ours, theirs = canonical(_frame(table)), canonical(_frame(expected))
    odd = [pair for pair in zip(ours, theirs) if pair[0] != pair[1]]
    return f"{len(odd)} rows, first {odd[0]}" if odd else None


def _frame(table) -> pd.DataFrame:
    return table.to_pandas(types_mapper=pd.ArrowDtype)


def main(args: list[str]) -> int:
    from tramline.session import get_session

    sf_dir = args[0] if args else DEFAULT_DIR
    chosen = args[1:] or list(QUERIES)
    quiet = {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}
    spark = get_session("compare", {**quiet, "spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    db = reference_db(sf_dir)
    failed = 0
    for name in chosen:
        start = time.monotonic()
        try:
            found = difference(spark, db, name, sf_dir)
        except Exception as error:
            found = f"{type(error).__name__}: {str(error)[:600]}"
        failed += found is not None
        print(f"{name:36s} {time.monotonic() - start:6.1f}s  {found or 'same'}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
