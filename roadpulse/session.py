"""Session helpers: a local session for tests and benchmarks, and written intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, name: str = "roadpulse", **conf: str) -> SparkSession:
    """A `local[cores]` session. On a cluster use the session the cluster hands out."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The shared folder named in `spark.checkpoint.dir`; one is invented only in local mode."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not re.fullmatch(r"local(\[.*\])?", context.master):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="roadpulse-checkpoint-")
        context.setCheckpointDir(folder)
    return f"{context.getCheckpointDir()}/roadpulse-{context.applicationId}"


def materialise(df: DataFrame, compression: str = "snappy") -> DataFrame:
    """Write the rows to the shared folder and read them back: runs a job and cuts lineage.

    A Parquet table rather than `checkpoint()`: it is computed once, later readers take only
    the columns they need, and its size is known to the planner. Executors may be lost.
    """
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def side_by_side(actions: list[Callable[[], None]]) -> None:
    """Run independent writes at the same time, so small ones do not wait for large ones."""
    with ThreadPoolExecutor(max_workers=4) as pool:
        for done in [pool.submit(action) for action in actions]:
            done.result()


def drop_table(df: DataFrame) -> None:
    """Delete a table that `materialise` wrote, once nothing reads it any more."""
    spark = df.sparkSession
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def drop_materialised(spark: SparkSession) -> None:
    """Delete what `materialise` wrote in this application; call it when the results are out."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
