"""Continuous ingest of feed files: each sweep adds only keys that were not seen before."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from roadpulse.session import drop_table, materialise
from roadpulse.sinks.keyed import insert_if_absent, write_batch
from roadpulse.sources.feeds import (
    good_documents, parse_feed, quarantined_documents, unnest_alerts, unnest_jams,
)


def stream_feed(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Feed files as they arrive, read as `feeds.read_feed` does: unusable ones are marked, not lost."""
    reader = spark.readStream.format("text").option("wholetext", True).option("pathGlobFilter", "*.json")
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return parse_feed(reader.load(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("value").alias("text")))


def _trigger(seconds: int | None) -> dict:
    return {"availableNow": True} if seconds is None else {"processingTime": f"{seconds} seconds"}


def ingest_feed(
    spark: SparkSession, path: str, alerts_path: str, jams_path: str, bad_path: str, checkpoint: str,
    every_seconds: int | None = None, files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Add unseen alerts and jams to their collections, exactly and over the whole history.

    Files that cannot be used go to `bad_path` with the reason. `every_seconds=None` takes what
    is there and stops. A batch that is retried replaces its own rows, see `insert_if_absent`.
    """
    order = ["file", "cell", "pos"]

    def store(batch: DataFrame, number: int) -> None:
        documents = materialise(batch)      # read and parsed once for both collections
        good = good_documents(documents)
        insert_if_absent(unnest_alerts(good), alerts_path, ["uuid"], order, number)
        insert_if_absent(unnest_jams(good), jams_path, ["uuid"], order, number)
        write_batch(quarantined_documents(documents), bad_path, number)
        drop_table(documents)

    return (
        stream_feed(spark, path, files_per_trigger).writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint).trigger(**_trigger(every_seconds)).start()
    )


def unseen_within(alerts: DataFrame, delay: str, key: str = "uuid", time: str = "fecha_ts") -> DataFrame:
    """First row per key with bounded state: a key may come again once `delay` has passed."""
    return alerts.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])
