"""The generic test tables read as this library's inputs.

`events` plays the alert reports, the requests and the feed; `lineitem` with its supplier,
nation and region plays the jams. Gaps, empty texts, repeated keys and a hot request key are
derived from the columns, because the tables themselves have none. All rows are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from roadpulse.functions.values import seconds_of
from roadpulse.operators.lookup import tagged_keys
from roadpulse.operators.quality import clean_alerts, clean_jams
from roadpulse.operators.staging import stage_alerts, stage_jams
from roadpulse.schemas import HIT, KIND_ALERT, KIND_JAM, MISS, NOT_FOUND

ITEMS_PER_FILE, ITEMS_PER_CELL = 64, 8
ALERT_EVENTS = ["error", "view", "signup"]
# event type -> report type
REPORT_TYPES = {"error": "ACCIDENT", "click": "JAM", "view": "HAZARD", "signup": "ROAD_CLOSED",
                "purchase": "POLICE"}


# Declared, so that opening a table starts no job to look the schema up.
TABLES = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _second_text(ts: Column) -> Column:
    return F.substring(ts.cast("string"), 1, 19)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events plus `k` (from the JSON text), `fecha` and `segundo` (whole seconds)."""
    return table(spark, sf_dir, "events").withColumns({
        "k": F.get_json_object("props", "$.k").cast("int"),
        "fecha": _second_text(F.col("ts")),
        "segundo": seconds_of(F.col("ts")),
    })


def alert_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, k, user = F.col("event_id"), F.col("k"), F.col("user_id")
    kind = F.element_at(F.create_map(*[F.lit(x) for pair in REPORT_TYPES.items() for x in pair]),
                        F.col("event_type"))
    x = F.lit(-71.0) + (e % 534).cast("double") / F.lit(1000.0)
    y = F.lit(-33.2) - (e % 507).cast("double") / F.lit(1000.0)
    no_location = user % 10 == 3
    place = F.concat(F.lit("comuna "), (user % 25).cast("string"), F.lit(", sector "),
                     (user % 3).cast("string"))
    return events(spark, sf_dir).select(
        e.alias("seq"),
        F.when(k != 13, F.concat(F.lit("a"), F.expr("event_id * 4 div 5").cast("string"))).alias("uuid"),
        F.when(user % 25 == 11, "").when(user % 25 != 7, place).alias("city"),
        F.when(e % 11 == 0, "true").otherwise("false").alias("reportByMunicipalityUser"),
        F.when(k == 99, "false").otherwise(kind).alias("type"),
        F.when(F.col("value") >= 5, F.concat_ws("_", kind, (k % 3).cast("string"))).alias("subtype"),
        F.when(k % 4 != 0, F.concat(F.lit("user"), user.cast("string"))).alias("reportBy"),
        (k % 6).alias("reportRating"),
        F.when(k != 50, F.concat(F.lit("Calle "), k.cast("string"))).alias("street"),
        F.when(F.col("value") >= 1, F.col("value")).alias("confidence"),
        F.when(~no_location, F.struct(x.alias("x"), y.alias("y"))).alias("location"),
        F.when(user % 20 == 3, x).alias("x"),
        F.when(user % 20 == 3, y).alias("y"),
        "fecha",
    )


def jam_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.col("l_linenumber")
    rows = (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return rows.select(
        (F.col("l_orderkey") * 8 + number).alias("uuid"),
        number.alias("severity"),
        F.col("n_name").alias("country"),
        F.when(~((number == 6) & (F.col("l_returnflag") == "A")), F.col("l_quantity").cast("int")).alias("length"),
        F.when((number == 5) & (F.col("l_linestatus") == "O"), "").otherwise(F.col("l_returnflag")).alias("endNode"),
        F.rint(F.col("l_tax") * 100).cast("int").alias("roadType"),
        F.when(number > 2, F.col("l_extendedprice")).alias("speedKMH"),
        F.when(number != 7, F.col("l_discount")).alias("speed"),
        F.col("s_name").alias("street"),
        _second_text(F.col("l_shipdate")).alias("fecha"),
        F.col("r_name").alias("region"),
        F.lower("n_name").alias("city"),
    )


def staged_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_alerts(alert_documents(spark, sf_dir), "seq", keep=("seq",))


def staged_jams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_jams(jam_documents(spark, sf_dir))


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_alerts(staged_alerts(spark, sf_dir), ("seq",))


def jams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_jams(staged_jams(spark, sf_dir))


def keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distinct keys of both collections, tagged."""
    return tagged_keys(alert_documents(spark, sf_dir), jam_documents(spark, sf_dir)).distinct()


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per event. Two fifths of them ask for the same alert; some keys are unknown."""
    k, user, kind = F.col("k"), F.col("user_id"), F.col("event_type")
    alert = kind.isin(ALERT_EVENTS)
    asked_alert = (F.when(kind != "signup", F.lit("a80")).when(k % 10 == 0, F.concat(F.lit("zz"), k.cast("string")))
                   .otherwise(F.concat(F.lit("a"), (user * 7).cast("string"))))
    asked_jam = (F.when(k % 10 == 1, F.concat(F.lit("jam-"), k.cast("string")))
                 .otherwise((user * 8 + k % 7).cast("string")))
    return events(spark, sf_dir).select(
        F.col("event_id").alias("seq"), "segundo",
        F.when(alert, KIND_ALERT).otherwise(KIND_JAM).alias("tipo"),
        F.when(alert, asked_alert).otherwise(asked_jam).alias("uuid"),
    )


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log with outcomes and latencies given, one line per event."""
    k = F.col("k")
    outcome = F.when(k % 10 == 0, NOT_FOUND).when(k % 3 == 0, HIT).otherwise(MISS)
    return events(spark, sf_dir).select(
        F.col("event_id").alias("seq"), "segundo",
        F.when(F.col("event_type").isin(ALERT_EVENTS), KIND_ALERT).otherwise(KIND_JAM).alias("tipo"),
        F.col("user_id").cast("string").alias("uuid"), outcome.alias("resultado"),
        F.when(k % 10 != 0, F.col("value")).alias("tiempo_ms"),
    )


def _file_number() -> Column:
    return F.floor(F.col("event_id") / ITEMS_PER_FILE)


def feed_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested feed documents as JSON text, 64 events each, 8 per cell. (`file`, `text`, `n`)."""
    e, kind = F.col("event_id"), F.col("event_type")
    item = F.struct(
        e.alias("id"), F.floor((e % ITEMS_PER_FILE) / ITEMS_PER_CELL).alias("cell"),
        kind.isin(ALERT_EVENTS).alias("alert"),
        F.struct(F.col("user_id").cast("string").alias("uuid"), kind.alias("type"),
                 F.col("value").alias("confidence"), "fecha").alias("as_alert"),
        F.struct(F.col("user_id").alias("uuid"), F.col("k").alias("length"), "fecha").alias("as_jam"),
    )
    # at most ITEMS_PER_FILE items per group, as event_id is unique
    files = events(spark, sf_dir).groupBy(_file_number().alias("n")).agg(
        F.sort_array(F.collect_list(item)).alias("items"))

    def cell(c: Column) -> Column:
        here = F.filter("items", lambda i: i["cell"] == c)
        return F.struct(F.struct(
            F.transform(F.filter(here, lambda i: i["alert"]), lambda i: i["as_alert"]).alias("alerts"),
            F.transform(F.filter(here, lambda i: ~i["alert"]), lambda i: i["as_jam"]).alias("jams"),
        ).alias("data"))

    cells = F.transform(F.sequence(F.lit(0), F.lit(ITEMS_PER_FILE // ITEMS_PER_CELL - 1)), cell)
    return files.select(
        F.format_string("feed_%09d.json", F.col("n")).alias("file"),
        F.to_json(F.struct(cells.alias("celdas"))).alias("text"), "n")


def flat_texts(spark: SparkSession, sf_dir: str, items: int = ITEMS_PER_FILE) -> DataFrame:
    """Flat feed documents: a JSON list of 64 (or `items`) objects with the fields of their kind."""
    e, kind = F.col("event_id"), F.col("event_type")
    report, jam = kind.isin("error", "view"), kind == "click"
    item = F.struct(
        e.alias("id"), (F.col("user_id") % 40).cast("string").alias("uuid"),
        F.when(report, F.lit("sub")).alias("subtype"),
        F.when(report, F.col("k")).alias("reportRating"),
        F.when(jam, F.col("k")).alias("roadType"),
        F.when(jam | (kind == "signup"), F.lit("Calle")).alias("street"),
    )
    files = events(spark, sf_dir).groupBy(F.floor(F.col("event_id") / items).alias("n")).agg(
        F.sort_array(F.collect_list(item)).alias("items"))
    return files.select(F.format_string("flat_%09d.json", F.col("n")).alias("file"),
                        F.to_json("items").alias("text"))
