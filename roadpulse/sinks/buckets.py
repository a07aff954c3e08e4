"""Tables cut into folders by a hash of the key, of which each operation opens only those it touches.

A key always falls into the same bucket, so what belongs to the keys of a batch lies in the buckets
of the batch. Their numbers are at most the number of buckets, which bounds what the driver
holds; the folders are named to the reader, so that neither files nor listings of other buckets
are touched. The number of buckets is fixed when a table is made: about its final size / 128 MB.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from roadpulse.session import drop_table, materialise

BUCKET = "bucket"
BUCKETS = 32
#: Files that a task writes side by side; of more buckets it sorts the rest of its rows.
MOST_OPEN = 32
_LAYOUT, _WRITERS = "_buckets", "spark.sql.maxConcurrentOutputFileWriters"


def folder(spark: SparkSession, path: str):
    """The file system of a path, and the path as it takes it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def names_in(spark: SparkSession, path: str) -> list[str]:
    files, place = folder(spark, path)
    return [status.getPath().getName() for status in files.listStatus(place)] if files.exists(place) else []


def bucket_count(spark: SparkSession, path: str, wanted: int = BUCKETS) -> int:
    """How many buckets the table has; a new one gets as many as are wanted."""
    found = [int(name) for name in names_in(spark, f"{path}/{_LAYOUT}")]
    if not found:
        files, place = folder(spark, f"{path}/{_LAYOUT}/{wanted}")
        files.mkdirs(place)
        found = [wanted]
    return found[0]


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def touched(rows: DataFrame) -> list[int]:
    """The buckets of rows that have been given theirs."""
    return sorted(r[0] for r in rows.select(BUCKET).distinct().collect())


def read_buckets(spark: SparkSession, path: str, schema: T.StructType, numbers: list[int] | None = None) -> DataFrame:
    """The rows of some buckets (None: of all) with their bucket; a bucket nobody wrote is empty."""
    whole = T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])
    there = {name for name in names_in(spark, path) if name.startswith(BUCKET + "=")}
    wanted = there if numbers is None else there & {f"{BUCKET}={n}" for n in numbers}
    if not wanted:
        return spark.createDataFrame([], whole)
    return spark.read.schema(whole).option("basePath", path).parquet(*(f"{path}/{name}" for name in sorted(wanted)))


def append(rows: DataFrame, path: str) -> None:
    """Add rows to their buckets, one file for each."""
    rows.repartition(BUCKET).write.mode("append").partitionBy(BUCKET).parquet(path)


def update(
    rows: DataFrame, path: str, keys: list[str], merge: Callable[[DataFrame, DataFrame], DataFrame],
    buckets: int = BUCKETS, written: bool = False,
) -> None:
    """Replace the buckets that `rows` touch by `merge(stored rows, new rows)`.

    `rows` are written first, unless they are said to come from `written` tables by steps without a shuffle.

    All other buckets stay as they are and are not read. Merged rows go from the tasks that make them to their
    buckets, without another shuffle or copy: Spark writes the new files beside the old ones and puts them in their
    place when all are complete. A job that fails on the way leaves the old state, and running it again mends one that
    was interrupted between two buckets, as long as `merge` gives the same for rows merged before.
    """
    spark = rows.sparkSession
    schema = rows.schema
    count = bucket_count(spark, path, buckets)
    new = rows.withColumn(BUCKET, bucket_of(keys, count))
    if not written:
        new = materialise(new)
    stored = read_buckets(spark, path, schema, touched(new))
    columns = [*rows.columns, BUCKET]
    merged = merge(stored.select(columns), new.select(columns)).select(columns)
    open_buckets(spark, count)
    (merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
     .partitionBy(BUCKET).parquet(path))
    if not written:
        drop_table(new)


def open_buckets(spark: SparkSession, count: int) -> None:
    """Let tasks, for the session, keep the files of this many buckets open instead of sorting their rows by bucket."""
    if int(spark.conf.get(_WRITERS)) < min(count, MOST_OPEN):
        spark.conf.set(_WRITERS, str(min(count, MOST_OPEN)))
