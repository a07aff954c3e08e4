"""JSON feed files: nested cell documents or flat lists, with quarantine of unreadable ones.

A file is known by its path (`file`); `file_name` is for display, since two folders may hold
files of one name. Objects stay JSON text until they are opened, and their fields are cast one by
one: a value of the wrong type becomes null and costs neither its object nor its file. Only a
file that is not JSON, or holds no objects where they belong, goes to quarantine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from roadpulse.functions.text import base_name
from roadpulse.operators.duplicates import guess_kind
from roadpulse.schemas import (
    ALERT_DOCUMENT, FEED, FLAT_OBJECT, JAM_DOCUMENT, KIND_ALERT, KIND_JAM,
)

CORRUPT = "_corrupt_record"
_FEED_OR_TEXT = T.StructType([*FEED.fields, T.StructField(CORRUPT, T.StringType(), True)])
_MARK = "\ufeff"                # byte order mark
_FLAT_START = r"\A\x{FEFF}?\s*\["


def _texts(spark: SparkSession, path: str | list[str], file_filter: str) -> DataFrame:
    """Whole files as (`file`, `text`); a file is one JSON value, so one task reads it."""
    return (
        spark.read.option("pathGlobFilter", file_filter).text(path, wholetext=True)
        .select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("text"))
    )


def parse_documents(texts: DataFrame, text: str = "text", file: str = "file") -> DataFrame:
    """One row per file of either shape: `celdas` of a nested one, `objetos` of a flat one.

    `malformed` says that the text is not JSON. The first sign that is not blank decides the
    shape, so each file is parsed once. Columns: file, file_name, celdas, objetos, malformed.
    """
    body = F.when(F.startswith(text, F.lit(_MARK)), F.substr(text, F.lit(2))).otherwise(F.col(text))
    flat = F.coalesce(F.col(text).rlike(_FLAT_START), F.lit(False))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    blank = F.coalesce(F.trim(body) == "", F.lit(True))
    return texts.select(
        F.col(file).alias("file"), base_name(F.col(file)).alias("file_name"), blank.alias("blank"),
        F.from_json(F.when(~flat, body), _FEED_OR_TEXT, options).alias("d"), flat.alias("flat"),
        F.from_json(F.when(flat, body), T.ArrayType(T.StringType())).alias("objetos"),
    ).select(
        "file", "file_name", F.col("d.celdas").alias("celdas"), "objetos",
        F.when(F.col("flat"), F.col("objetos").isNull())
        .otherwise(F.col("blank") | (F.col(f"d.{CORRUPT}").isNotNull() & F.col("d.celdas").isNull()))
        .alias("malformed"))


def read_documents(spark: SparkSession, path: str | list[str], file_filter: str = "*.json") -> DataFrame:
    """`parse_documents` over the files of a folder, which may mix both shapes."""
    return parse_documents(_texts(spark, path, file_filter))


def read_feed(spark: SparkSession, path: str | list[str], file_filter: str = "*.json") -> DataFrame:
    """One row per nested file: `file`, `file_name`, `celdas`, `malformed`. Flat ones have no cells."""
    return read_documents(spark, path, file_filter).drop("objetos")


def parse_feed(texts: DataFrame, text: str = "text", file: str = "file") -> DataFrame:
    """The same rows from feed documents held in a text column."""
    return parse_documents(texts, text, file).drop("objetos")


def good_documents(documents: DataFrame) -> DataFrame:
    """Documents with cells."""
    return documents.filter(F.col("celdas").isNotNull()).drop("malformed")


def quarantined_documents(documents: DataFrame) -> DataFrame:
    """Files that cannot be used, with the reason; a flat file counts as usable if it was read as such."""
    used = [F.col(c).isNotNull() for c in ("celdas", "objetos") if c in documents.columns]
    unused = ~(used[0] | used[1]) if len(used) > 1 else ~used[0]
    reason = F.when(F.col("malformed"), "malformed").otherwise("missing_celdas")
    return documents.filter(unused).select("file", "file_name", reason.alias("reason"))


def opened_cells(documents: DataFrame) -> DataFrame:
    """(file, cell, celda) with each cell as a VARIANT; null if it is none."""
    return documents.select("file", F.posexplode("celdas").alias("cell", "text")).select(
        "file", "cell", F.try_parse_json("text").alias("celda"))


def objects_of(part: str) -> Column:
    """The objects of one kind in `celda`; null without them."""
    return F.try_variant_get("celda", f"$.data.{part}", "array<variant>")


def _typed(item: Column, path: str, kind: T.DataType) -> Column:
    """A field in its type, or null if it does not fit."""
    if isinstance(kind, T.StructType):
        inner = F.try_variant_get(item, path, "variant")
        return F.when(inner.isNotNull() & ~F.is_variant_null(inner), F.struct(*[
            _typed(item, f"{path}.{f.name}", f.dataType).alias(f.name) for f in kind.fields]))
    text = F.try_variant_get(item, path, "string")
    if isinstance(kind, (T.IntegerType, T.LongType)):
        number = text.try_cast("double")        # 5.0 and 5e0 are whole numbers too
        whole = F.when(number == F.rint(number), number.try_cast(kind))
        return F.coalesce(text.try_cast(kind), whole)
    return text if isinstance(kind, T.StringType) else text.try_cast(kind)


def _unnest(documents: DataFrame, part: str, schema: T.StructType) -> DataFrame:
    # explode drops cells without data, and data without the list, by itself
    opened = opened_cells(documents).select("file", "cell", F.posexplode(objects_of(part)).alias("pos", "o"))
    return opened.select("file", "cell", "pos", *[
        _typed(F.col("o"), f"$.{f.name}", f.dataType).alias(f.name) for f in schema.fields])


def unnest_alerts(documents: DataFrame) -> DataFrame:
    """Alert documents with the file, cell and place they came from."""
    return _unnest(documents, "alerts", ALERT_DOCUMENT)


def unnest_jams(documents: DataFrame) -> DataFrame:
    return _unnest(documents, "jams", JAM_DOCUMENT)


def feed_items(documents: DataFrame) -> DataFrame:
    """All objects of both kinds as (file, pos, kind, uuid) for the duplicate reports.

    `pos` puts cells in order, and the jams of a cell before its alerts. Both lists of a cell
    are opened in one step, so the documents are parsed once.
    """
    def part(objects: Column, kind: str, second: int) -> Column:
        def item(o: Column, i: Column) -> Column:
            place = (F.col("cell").cast("long") * 2 + second) * (1 << 31) + i
            return F.struct(place.alias("pos"), F.lit(kind).alias("kind"),
                            F.try_variant_get(o, "$.uuid", "string").alias("uuid"))

        return F.coalesce(F.transform(objects, item), F.array())

    both = F.concat(part(objects_of("jams"), KIND_JAM, 0), part(objects_of("alerts"), KIND_ALERT, 1))
    return opened_cells(documents).select("file", F.inline(both))


def _flat_objects(documents: DataFrame) -> DataFrame:
    opened = documents.select("file", F.posexplode("objetos").alias("pos", "o"))
    return opened.select(
        "file", F.col("pos").cast("long").alias("pos"), F.from_json("o", FLAT_OBJECT).alias("o"),
    ).select("file", "pos", "o.*")


def parse_flat_feed(texts: DataFrame, text: str = "text", file: str = "file") -> DataFrame:
    """Flat documents (a JSON list each) to one row per object with its place in the list.

    Fields are text, for what tells the kinds apart is whether a field is there at all.
    """
    return _flat_objects(parse_documents(texts, text, file))


def read_flat_feed(spark: SparkSession, path: str | list[str], file_filter: str = "*.json") -> DataFrame:
    """The objects of flat feed files. A file is one JSON list, so it is read whole by one task."""
    return parse_flat_feed(_texts(spark, path, file_filter))


def mixed_items(documents: DataFrame) -> DataFrame:
    """(file, pos, kind, uuid) of all objects in files of both shapes.

    `duplicates.flat_keys_by_file` reports on them: nested objects always have a known kind, for
    which its rule of the first known kind comes to the same as that of `keys_by_file`.
    """
    columns = ["file", "pos", "kind", "uuid"]
    flat = guess_kind(_flat_objects(documents))
    return feed_items(documents).select(*columns).unionByName(flat.select(*columns))
