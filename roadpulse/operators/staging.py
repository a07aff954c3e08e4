"""Stored documents to the flat staged tables, with defaults and fallbacks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from roadpulse.functions.text import normalize_city
from roadpulse.functions.values import first_present
from roadpulse.schemas import ALERTS, NOT_AVAILABLE

FIRST_WRITE = ("file", "cell", "pos")       # order in which objects came in


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def surrogate_key(uuid: Column, position: Column) -> Column:
    """The key itself, or `item_<position>` where it is missing."""
    return F.coalesce(uuid, F.concat(F.lit("item_"), position.cast("string")))


def with_position(documents: DataFrame) -> DataFrame:
    """Add `position`, the place in the ingest order, to the one document that lacks its key.

    The store holds at most one such document, as a missing key is a key like others; nothing
    else needs its position. Counting the rows before it reads three columns and sorts none.
    """
    place = F.struct(*FIRST_WRITE)
    lone = documents.filter(F.col("uuid").isNull()).select(place.alias("place")).first()
    if lone is None:
        return documents.withColumn("position", F.lit(None).cast("long"))
    at = F.struct(*[F.lit(lone.place[c]).cast(documents.schema[c].dataType).alias(c) for c in FIRST_WRITE])
    return documents.withColumn("position", F.lit(documents.filter(place < at).count()))


def stage_alerts(documents: DataFrame, position: str | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Alert documents to the nine staged columns (plus the columns named in `keep`).

    `position` names the 0-based ingest position used for missing keys; without it a missing
    key stays null. Missing numbers default to 0 here, so they count as complete.
    """
    uuid = F.col("uuid")
    return documents.select(
        (surrogate_key(uuid, F.col(position)) if position else uuid).alias("uuid"),
        normalize_city(text_or_empty("city")).alias("city"),
        text_or_empty("reportByMunicipalityUser").alias("municipalityUser"),
        text_or_empty("type").alias("type"),
        text_or_empty("street").alias("street"),
        first_present(F.col("confidence"), F.lit(0.0)).alias("confidence"),
        first_present(F.col("location.x"), F.col("x"), F.lit(0.0)).alias("location_x"),
        first_present(F.col("location.y"), F.col("y"), F.lit(0.0)).alias("location_y"),
        text_or_empty("fecha").alias("fecha"),
        *keep,
    )


def stage_jams(documents: DataFrame, position: str | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Jam documents to the eleven staged columns. Missing numbers stay null: not complete."""
    uuid = F.col("uuid").cast("string")
    return documents.select(
        (surrogate_key(uuid, F.col(position)) if position else uuid).alias("uuid"),
        "severity",
        text_or_empty("country").alias("country"),
        "length",
        text_or_empty("endNode").alias("endnode"),
        F.col("roadType").alias("roadtype"),
        first_present(F.col("speedKMH"), F.col("speed")).alias("speed"),
        text_or_empty("street").alias("street"),
        text_or_empty("fecha").alias("fecha"),
        text_or_empty("region").alias("region"),
        normalize_city(text_or_empty("city")).alias("city"),
        *keep,
    )


def cast_leniently(texts: DataFrame, schema=ALERTS) -> DataFrame:
    """Text columns to the types of `schema`; a value that does not parse becomes null."""
    return texts.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def annotate(rows: DataFrame, fecha: Column | str, region: str) -> DataFrame:
    """Stamp rows with the time they were fetched and the region they belong to."""
    stamp = F.lit(fecha) if isinstance(fecha, str) else F.date_format(fecha, "yyyy-MM-dd HH:mm:ss")
    return rows.withColumns({"fecha": stamp, "region": F.lit(region)})


def report_fields(alerts: DataFrame, file: str = "file") -> DataFrame:
    """The fields the duplicate report shows, with `N/A` where one is missing."""
    shown = [F.coalesce(F.col(c), F.lit(NOT_AVAILABLE)).alias(name) for c, name in
             (("subtype", "subtype"), ("type", "type"), ("reportBy", "reportby"), ("city", "city"))]
    return alerts.select("uuid", *shown, F.col(file).alias("file"), "pos")
