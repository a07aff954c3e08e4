"""Typed tables: CSV with a declared schema, stored collections, run-stamped results."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from roadpulse.functions.text import is_run_name
from roadpulse.schemas import RUN_NAME

CSV_OPTIONS = {"mode": "PERMISSIVE", "quote": '"', "escape": '"', "enforceSchema": "true"}


def read_csv(
    spark: SparkSession, path: str | list[str], schema: T.StructType, *,
    header: bool = True, quoted: bool = True, line_breaks: bool = False, file_filter: str = "*.csv",
) -> DataFrame:
    """CSV with declared types; a value that does not parse is null, and so is an empty one.

    `header=False` keeps header lines as data rows, `quoted=False` splits on every comma:
    both only to reproduce files written that way. `line_breaks=True` allows them inside
    quotes, at the price of one task per file.
    """
    reader = spark.read.schema(schema).options(**CSV_OPTIONS).option("header", header)
    reader = reader.option("pathGlobFilter", file_filter).option("multiLine", line_breaks)
    return (reader if quoted else reader.option("quote", "")).csv(path)


def parse_csv(lines: DataFrame, line: str, schema: T.StructType, quoted: bool = True) -> DataFrame:
    """CSV lines held in a text column."""
    options = {k: v for k, v in CSV_OPTIONS.items() if k != "enforceSchema"}
    if not quoted:
        options["quote"] = ""
    parsed = F.from_csv(F.col(line), F.lit(_ddl(schema)), options)
    return lines.select(parsed.alias("r")).select("r.*")


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """Ad-hoc look at a header CSV; reads it twice. Jobs should declare a schema."""
    return spark.read.options(header=True, inferSchema=True, **{"escape": '"'}).csv(path)


def read_collection(spark: SparkSession, path: str, *, keep_id: bool = False) -> DataFrame:
    """A stored collection; the storage id only on request."""
    stored = spark.read.parquet(path)
    return stored if keep_id else stored.drop("_id")


def read_result_files(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """All CSV files under a folder, header stubs (`encabezado*`) left out, with `archivo`."""
    rows = (
        spark.read.schema(schema).options(**CSV_OPTIONS).option("header", True)
        .option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").csv(folder)
        .withColumn("archivo", F.col("_metadata.file_name"))
    )
    return rows.filter(~F.col("archivo").startswith("encabezado"))


def latest_run(rows: DataFrame, run: str = "run_id") -> DataFrame:
    """Rows of the newest run; folders that are not named like a run are ignored.

    On a table partitioned by `run` only that run's files are read.
    """
    return rows.filter(F.col(run) == latest_run_name(rows, run))


def latest_run_name(rows: DataFrame, run: str = "run_id") -> Column:
    named = rows.filter(is_run_name(F.col(run)))
    return named.agg(F.max(run)).scalar()


def run_names(spark: SparkSession, path: str) -> list[str]:
    """Run names under a result table, from its folder names: no data file is opened."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    names = [status.getPath().getName() for status in files.listStatus(folder) if status.isDirectory()]
    runs = [name.split("=", 1)[1] for name in names if name.startswith("run_id=")]
    return sorted(run for run in runs if re.match(RUN_NAME, run))


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    """The newest run of a run-stamped table; only that run's folder is listed and read."""
    runs = run_names(spark, path)
    if not runs:
        raise FileNotFoundError(f"no run under {path}")
    return spark.read.parquet(f"{path}/run_id={runs[-1]}")
