"""Run-stamped tables, CSV and JSON exports, run metrics."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

_CSV = {"header": True, "quote": '"', "escape": '"', "emptyValue": ""}


def run_name(now: datetime) -> str:
    return now.strftime("ejecucion_%Y%m%d_%H%M%S")


def write_run(df: DataFrame, path: str, run: str) -> None:
    """Write one run of a table. Running it again replaces that run and no other.

    The run's folder is written directly, as a partition of `path`, so that a run without
    rows leaves its mark too and is not mistaken for the one before.
    """
    df.write.mode("overwrite").parquet(f"{path}/run_id={run}")


def write_csv(df: DataFrame, path: str, *, header: bool = True) -> None:
    """A folder of minimal-quoting CSV files, whose names follow the order of the rows.

    An empty table still leaves a file with the header. A top-k table comes as one file.
    """
    df.write.mode("overwrite").options(**{**_CSV, "header": header}).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """A folder of JSON lines; a null field is written as such."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> None:
    """Save as a table bucketed and sorted by `key`, so repeated key lookups do not shuffle it."""
    df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(table)


def counted(df: DataFrame, step: str) -> tuple[DataFrame, Observation]:
    """Count rows as they flow by; the number is there once an action on `df` has run."""
    seen = Observation(step)
    return df.observe(seen, F.count("*").alias("rows")), seen


def write_metrics(spark: SparkSession, observed: dict[str, Observation], path: str, run: str) -> None:
    """One row per counted step."""
    rows = [(step, int(seen.get["rows"])) for step, seen in observed.items()]
    write_run(spark.createDataFrame(rows, "step string, rows bigint"), path, run)
