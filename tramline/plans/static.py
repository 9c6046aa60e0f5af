"""Static schedule files to bronze, bronze to silver dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tramline.functions import new_load_number
from tramline.operators.dims import static_dim, vehicle_dim
from tramline.plans.audit import AuditedRun
from tramline.schemas import STATIC_DIMS, STATIC_FILES
from tramline.sources.static import read_schedule_file
from tramline.sources.tables import read_table, write_table


def load_static(
    spark: SparkSession,
    schedule_dir: str,
    bronze_dir: str,
    load_number: str | None = None,
    files: dict[str, str] | None = None,
    multi_line: bool = False,
    runs: list[AuditedRun] | None = None,
) -> list[AuditedRun]:
    """Replace the three bronze dimensions, all under one load number; returns one run per table.

    All inputs are resolved before the first write, so a missing file or column replaces nothing.
    A list passed as ``runs`` also holds the failed run if a write raises.
    """
    load_number = load_number or new_load_number()
    dims = {
        name: static_dim(
            read_schedule_file(spark, f"{schedule_dir}/{(files or STATIC_FILES)[name]}", multi_line),
            columns,
            load_number,
        )
        for name, columns in STATIC_DIMS.items()
    }
    runs = [] if runs is None else runs
    for name, dim in dims.items():
        run = AuditedRun(load_number, f"bronze.dim_{name}")
        runs.append(run)
        run.write(dim, lambda rows, name=name: write_table(rows, f"{bronze_dir}/dim_{name}"))
    return runs


def silver_dim(spark: SparkSession, bronze_dir: str, name: str, fmt: str = "parquet") -> DataFrame:
    """A static dimension as it is, or the vehicles of all usable positions."""
    if name == "vehicle":
        return vehicle_dim(read_table(spark, f"{bronze_dir}/vehicle_positions", fmt))
    return read_table(spark, f"{bronze_dir}/dim_{name}")


def write_silver_dim(spark: SparkSession, bronze_dir: str, silver_dir: str, name: str, fmt: str = "parquet") -> None:
    write_table(silver_dim(spark, bronze_dir, name, fmt), f"{silver_dir}/{name}")


def write_silver_dims(spark: SparkSession, bronze_dir: str, silver_dir: str, fmt: str = "parquet") -> None:
    for name in (*STATIC_DIMS, "vehicle"):
        write_silver_dim(spark, bronze_dir, silver_dir, name, fmt)
