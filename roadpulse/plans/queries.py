"""Registered queries: one per operator, each over the whole test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from roadpulse.functions.text import is_digits, normalize_city
from roadpulse.functions.values import document_json, first_present
from roadpulse.operators import (
    clustering, documents as docs, duplicates as dup, grid, lookup, numbering, quality, rollups, sampling,
    sketches, staging, suppression, topk,
)
from roadpulse.plans import bindings as b
from roadpulse.schemas import (
    ALERT_COLUMNS, ALERTS, JAM_COLUMNS, KIND_ALERT, KIND_JAM, RESULT_ORDER, struct,
)
from roadpulse.session import materialise, shared_folder, side_by_side
from roadpulse.sinks import keyed
from roadpulse.sources import feeds, ranges, tables
from roadpulse.streaming.refresh import refresh_results
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
PROCESSED_AT = "2024-01-31T00:00:00"


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# -- sources --------------------------------------------------------------------------------

@query
def unnest_feed(spark, sf):
    documents = feeds.good_documents(feeds.parse_feed(b.feed_texts(spark, sf)))
    alerts = feeds.unnest_alerts(documents).select(
        "file", "cell", "pos", F.lit(KIND_ALERT).alias("kind"), "uuid", "type",
        F.lit(None).cast("int").alias("length"), "fecha")
    jams = feeds.unnest_jams(documents).select(
        "file", "cell", "pos", F.lit(KIND_JAM).alias("kind"), F.col("uuid").cast("string").alias("uuid"),
        F.lit(None).cast("string").alias("type"), "length", "fecha")
    return alerts.unionByName(jams)


@query
def feed_quarantine(spark, sf):
    """Every 5th file is cut short and every 7th has no cells; all files are reported on."""
    text = (F.when(F.col("n") % 5 == 0, F.substring("text", 1, 40))
            .when(F.col("n") % 7 == 0, F.lit('{"otros": []}')).otherwise(F.col("text")))
    parsed = feeds.parse_feed(b.feed_texts(spark, sf).withColumn("text", text))
    good = feeds.good_documents(parsed).select("file", F.lit("ok").alias("reason"))
    return good.unionByName(feeds.quarantined_documents(parsed).select("file", "reason"))


@query
def feed_lenient(spark, sf):
    """Alerts whose last digit is 0 or 5 get a word for a number, odd jams a fraction: all objects stay."""
    text = F.regexp_replace("text", r'"confidence":(\d+\.\d*)([05])(?=,)', '"confidence":"$1$2 high"')
    text = F.regexp_replace(text, r'"length":(\d*[13579])(?=,)', '"length":$1.5')
    documents = feeds.good_documents(feeds.parse_feed(b.feed_texts(spark, sf).withColumn("text", text)))
    alerts = feeds.unnest_alerts(documents).select("file", "cell", F.lit(KIND_ALERT).alias("kind"), "fecha", "uuid",
                                                   F.col("confidence").alias("number"))
    jams = feeds.unnest_jams(documents).select("file", "cell", F.lit(KIND_JAM).alias("kind"), "fecha",
                                               F.col("uuid").cast("string").alias("uuid"),
                                               F.col("length").cast("double").alias("number"))
    return alerts.unionByName(jams)


@query
def flat_feed_in_ranges(spark, sf):
    """Long flat lists, written as files and opened by ranges of 64 KB."""
    path = f"{shared_folder(spark)}/flat-{uuid.uuid4().hex}"
    b.flat_texts(spark, sf, 4096).select("text", F.col("file").alias("list")).write.partitionBy("list").text(path)
    rows = ranges.read_large_flat_feed(spark, f"{path}/*", "*.txt", 1 << 16)
    return dup.guess_kind(rows).select(
        F.regexp_extract("file", "list=([^/]+)", 1).alias("file"), "pos", "uuid", "kind")


@query
def flat_kind_guess(spark, sf):
    return dup.guess_kind(feeds.parse_flat_feed(b.flat_texts(spark, sf))).select("file", "pos", "uuid", "kind")


@query
def collection_scan(spark, sf):
    stored = b.alert_documents(spark, sf).withColumnRenamed("seq", "_id")
    return stored.drop("_id").select(
        "uuid", "city", "type", "street", "confidence", F.col("location.x").alias("lx"), "x", "fecha")


@query
def typed_csv_load(spark, sf):
    """CSV lines with a quoted comma and some bad numbers, parsed with the declared schema."""
    k = F.col("k")
    line = F.concat_ws(
        ",", F.concat(F.lit("a"), F.col("event_id").cast("string")),
        F.concat(F.lit('"Av. '), k.cast("string"), F.lit(', poniente"')),
        F.lit("false"), "event_type", F.concat(F.lit("Calle "), k.cast("string")),
        F.when(k % 10 == 0, F.lit("abc")).when(k % 10 == 1, F.lit("")).otherwise(F.col("value").cast("string")),
        (k.cast("double") / 4).cast("string"), (k.cast("double") / -2).cast("string"), "fecha")
    return tables.parse_csv(b.events(spark, sf).select(line.alias("line")), "line", ALERTS)


@query
def latest_run(spark, sf):
    """Events stamped with a run per day and hour; the ones at noon have a malformed name."""
    day, hour = F.translate(F.substring("fecha", 1, 10), "-", ""), F.substring("fecha", 12, 2)
    name = F.when(hour == "12", F.concat(F.lit("zz_"), day)).otherwise(
        F.concat(F.lit("ejecucion_"), day, F.lit("_"), hour, F.lit("0000")))
    runs = b.events(spark, sf).select(name.alias("run_id"), "event_id", "event_type", "fecha")
    return tables.latest_run(runs)


@query
def uuid_list(spark, sf):
    """The key lists of both collections, each by its own rule."""
    return lookup.tagged_keys(b.alert_documents(spark, sf), b.jam_documents(spark, sf))


# -- projections and filters ----------------------------------------------------------------

@query
def stage_alerts(spark, sf):
    return b.staged_alerts(spark, sf)


@query
def stage_jams(spark, sf):
    return b.staged_jams(spark, sf)


@query
def annotate_rows(spark, sf):
    rows = b.events(spark, sf).select("event_id", "fecha")
    return staging.annotate(rows, "2024-02-01 00:00:00", "Santiago")


@query
def fallback_chain(spark, sf):
    return b.alert_documents(spark, sf).select(
        "seq", first_present(F.col("location.x"), F.col("x"), F.lit(0.0)).alias("location_x"),
        first_present(F.col("location.y"), F.col("y"), F.lit(0.0)).alias("location_y"))


@query
def hour_extract(spark, sf):
    short = b.events(spark, sf).withColumn(
        "fecha", F.when(F.col("k") % 9 == 0, F.substring("fecha", 1, 10)).otherwise(F.col("fecha")))
    return rollups.with_hour(short).select("event_id", "fecha", "hora")


@query
def lenient_cast(spark, sf):
    k = F.col("k")
    texts = b.events(spark, sf).select(
        F.col("event_id").cast("string").alias("uuid"),
        F.when(k % 5 == 0, "abc").when(k % 5 == 1, "").otherwise(F.col("value").cast("string")).alias("confidence"),
        F.when(k % 7 == 0, "n/d").otherwise(k.cast("string")).alias("length"))
    return staging.cast_leniently(
        texts, struct(uuid=T.LongType(), confidence=T.DoubleType(), length=T.IntegerType()))


@query
def normalize_cities(spark, sf):
    raw = F.concat(F.col("p_name"), F.lit(" , o'"), F.col("p_brand"), F.lit("-"), F.lower("p_type"),
                   F.col("p_size").cast("string"), F.lit("x ;Ñuñoa "))
    return b.table(spark, sf, "part").select("p_partkey", normalize_city(raw).alias("city"))


@query
def surrogate_key(spark, sf):
    rows = b.alert_documents(spark, sf).select("uuid", "fecha", "seq")
    numbered = numbering.number_rows(rows, ["fecha", "seq"], "n")
    return numbered.select(staging.surrogate_key(F.col("uuid"), F.col("n")).alias("uuid"), "n", "seq")


@query
def header_filter(spark, sf):
    """Rows of one kind turn into repeated header lines and are dropped again."""
    rows = b.alert_documents(spark, sf).select(
        F.when(F.col("type") == "POLICE", "uuid").otherwise(F.col("uuid")).alias("uuid"), "type", "seq")
    return quality.drop_header_rows(rows)


@query
def complete_alerts(spark, sf):
    return quality.complete(b.staged_alerts(spark, sf), ALERT_COLUMNS)


@query
def complete_jams(spark, sf):
    return quality.complete(b.staged_jams(spark, sf), JAM_COLUMNS)


@query
def filter_kind(spark, sf):
    return quality.of_kind(b.alerts(spark, sf), "ACCIDENT")


@query
def quarantine_false(spark, sf):
    return quality.shifted_rows(b.staged_alerts(spark, sf))


@query
def bbox_clustered(spark, sf):
    """The same area from a table stored along the curve."""
    path = f"{shared_folder(spark)}/curve-{uuid.uuid4().hex}"
    clustering.write_clustered(b.alerts(spark, sf).select("uuid", "location_x", "location_y"), path)
    return grid.within_bounds(spark.read.parquet(path), -33.3, -33.5, -70.8, -70.5)


@query
def bbox_filter(spark, sf):
    return grid.within_bounds(b.alerts(spark, sf), -33.3, -33.5, -70.8, -70.5).select(
        "uuid", "location_x", "location_y")


@query
def digit_guard(spark, sf):
    asked = b.requests(spark, sf).filter(is_digits(F.col("uuid")))
    return asked.select("seq", F.col("uuid").try_cast("bigint").alias("clave"))


@query
def doc_json(spark, sf):
    rows = b.staged_alerts(spark, sf)
    return rows.select("seq", document_json(*ALERT_COLUMNS).alias("doc"))


# -- first per key, funnel, duplicate reports -----------------------------------------------

@query
def dedup_alerts(spark, sf):
    return b.alerts(spark, sf)


@query
def dedup_jams(spark, sf):
    return b.jams(spark, sf)


@query
def clean_funnel(spark, sf):
    return quality.funnel(b.staged_alerts(spark, sf), ALERT_COLUMNS, KIND_ALERT).unionByName(
        quality.funnel(b.staged_jams(spark, sf), JAM_COLUMNS, KIND_JAM))


def _items(spark, sf):
    return feeds.feed_items(feeds.good_documents(feeds.parse_feed(b.feed_texts(spark, sf))))


def _flat_items(spark, sf):
    return dup.guess_kind(feeds.parse_flat_feed(b.flat_texts(spark, sf)))


@query
def ingest_accounting(spark, sf):
    return docs.ingest_accounting(_items(spark, sf))


@query
def ingest_totals(spark, sf):
    return docs.ingest_totals(docs.ingest_accounting(_items(spark, sf)))


@query
def dup_by_file(spark, sf):
    return dup.repeated(dup.keys_by_file(_items(spark, sf)))


@query
def dup_file_summary(spark, sf):
    return dup.file_summary(dup.keys_by_file(_items(spark, sf)))


@query
def dup_global_summary(spark, sf):
    return dup.global_summary(dup.file_summary(dup.keys_by_file(_items(spark, sf))))


@query
def flat_kind_merge(spark, sf):
    return dup.flat_keys_by_file(_flat_items(spark, sf))


@query
def dup_mixed_shapes(spark, sf):
    """The duplicate report over nested and flat files read together, in one pass."""
    texts = b.feed_texts(spark, sf).select("file", "text").unionByName(b.flat_texts(spark, sf))
    return dup.flat_keys_by_file(feeds.mixed_items(feeds.parse_documents(texts)))


@query
def repeated_keys(spark, sf):
    return dup.repeated_keys(_items(spark, sf))


def _reports(spark, sf):
    """Alert reports with their file (one per day) and place in it."""
    rows = b.alert_documents(spark, sf).withColumns({
        "file": F.concat(F.translate(F.substring("fecha", 1, 10), "-", ""), F.lit(".json")),
        "pos": F.col("seq")})
    return staging.report_fields(rows)


@query
def repeated_alerts(spark, sf):
    return dup.repeated_keys(_reports(spark, sf))


@query
def repeated_instances(spark, sf):
    return dup.repeated_instances(_reports(spark, sf))


@query
def key_counts(spark, sf):
    return dup.key_counts(_reports(spark, sf))


@query
def mixed_keys(spark, sf):
    return dup.mixed_keys(_items(spark, sf))


# -- counts, totals, rankings, top-k --------------------------------------------------------

@query
def count_alerts(spark, sf):
    return rollups.count_rows(b.alerts(spark, sf))


@query
def count_jams(spark, sf):
    return rollups.count_rows(b.jams(spark, sf))


@query
def count_accidents(spark, sf):
    return rollups.count_kind(b.alerts(spark, sf))


@query
def alert_cube(spark, sf):
    return rollups.alert_cube(b.alerts(spark, sf))


@query
def peak_hours(spark, sf):
    return rollups.peak_hours(b.alerts(spark, sf))


@query
def alerts_by_city(spark, sf):
    return rollups.alerts_by_city(b.alerts(spark, sf))


@query
def alerts_by_type(spark, sf):
    return rollups.alerts_by_type(b.alerts(spark, sf))


@query
def alerts_by_street(spark, sf):
    return rollups.alerts_by_street(b.alerts(spark, sf))


@query
def accidents_by_city(spark, sf):
    return rollups.accidents_by_city(b.alerts(spark, sf))


@query
def accidents_by_street_city(spark, sf):
    return rollups.accidents_by_street_city(b.alerts(spark, sf))


@query
def jams_by_city(spark, sf):
    return rollups.jams_by_city(b.jams(spark, sf))


@query
def longest_jams(spark, sf):
    return rollups.longest_jams(b.jams(spark, sf))


@query
def sample_alerts(spark, sf):
    return topk.sample_rows(b.alerts(spark, sf))


@query
def sample_jams(spark, sf):
    return topk.sample_rows(b.jams(spark, sf))


def _chart(name: str, chart: str, ranking: Callable[[DataFrame], DataFrame], rows: Query) -> None:
    cut = topk.CHARTS[chart][1]
    QUERIES[name] = lambda spark, sf: cut(ranking(rows(spark, sf)))


_chart("top10_accident_streets", "calles_con_mas_accidentes", rollups.accidents_by_street_city, b.alerts)
_chart("top10_alert_streets", "calles_con_mas_alertas", rollups.alerts_by_street, b.alerts)
_chart("top5_accident_cities", "comunas_con_mas_accidentes", rollups.accidents_by_city, b.alerts)
_chart("top10_alert_cities", "comunas_con_mas_alertas", rollups.alerts_by_city, b.alerts)
_chart("hour_distribution", "horas_pico", rollups.peak_hours, b.alerts)
_chart("type_frequency", "tipos_alerta_frecuencia", rollups.alerts_by_type, b.alerts)
_chart("top10_jam_length", "atascos_por_ciudad_largo", rollups.jams_by_city, b.jams)
_chart("top10_jam_count", "atascos_por_ciudad_numero", rollups.jams_by_city, b.jams)


# -- keyed sinks and documents --------------------------------------------------------------

STORED_TYPES = ["JAM", "HAZARD", "ACCIDENT"]


def _halves(spark, sf):
    """Alert documents in two loads: reports of some types are stored, the others arrive."""
    rows = b.alert_documents(spark, sf).select("uuid", "type", "street", "fecha", "seq")
    stored = F.col("type").isin(STORED_TYPES)
    return rows.filter(stored), rows.filter(~stored)


@query
def insert_if_absent(spark, sf):
    """What the collection holds after the stored load and the arriving one."""
    first, second = _halves(spark, sf)
    stored = quality.first_per_key(first, ["uuid"], ["seq"])
    return stored.unionByName(keyed.absent_rows(second, stored, ["uuid"], ["seq"]))


@query
def keyed_upsert(spark, sf):
    first, second = _halves(spark, sf)
    stored = quality.first_per_key(first, ["uuid"], [F.desc("seq")])
    return keyed.latest_rows(stored, second, ["uuid"], [F.desc("seq")])


@query
def collection_documents(spark, sf):
    """The whole stored jams under their own keys."""
    return docs.collection_documents(b.staged_jams(spark, sf), "atascos", "uuid")


def _results(spark, sf):
    """All result tables over written clean tables, as the daily job computes them."""
    alerts, jams = materialise(b.alerts(spark, sf)), materialise(b.jams(spark, sf))
    cube = materialise(rollups.alert_cube(alerts))
    return rollups.result_tables(alerts, jams, b.staged_alerts(spark, sf), cube, ordered=False)


@query
def result_documents(spark, sf):
    """All nine result tables as documents in the common form."""
    return docs.numbered_documents(_results(spark, sf), RESULT_ORDER, PROCESSED_AT)


@query
def refreshed_results(spark, sf):
    """The nine result indexes after three loads into the collections, each followed by a refresh."""
    base = f"{shared_folder(spark)}/refreshed-{uuid.uuid4().hex}"
    load = F.when(F.col("type").isin(STORED_TYPES), 2).when(F.col("type") == "POLICE", 0).otherwise(1)
    place = {"file": F.format_string("load_%d", "load"), "cell": F.lit(0)}
    alerts = b.alert_documents(spark, sf).withColumn("load", load).withColumns(place).withColumnRenamed("seq", "pos")
    jams = b.jam_documents(spark, sf).withColumn("load", (F.col("severity") % 3).cast("int")).withColumns(place).withColumn(
        "pos", F.lit(0))
    kinds = {"alertas": (alerts, ["pos"]), "atascos": (
        jams, ["fecha", "severity", "country", "length", "endNode", "roadType", "street"])}
    for n in range(3):
        side_by_side([partial(keyed.insert_if_absent, rows.filter(F.col("load") == n), f"{base}/store/{kind}", ["uuid"],
                              order, n, buckets=8) for kind, (rows, order) in kinds.items()])
        new = (spark.read.parquet(f"{base}/store/{kind}/{keyed.BATCH}={n}") for kind in kinds)
        refresh_results(*new, f"{base}/store", f"{base}/state", f"{base}/index", PROCESSED_AT, n, buckets=8)
    return keyed.current_documents(spark, f"{base}/index")


@query
def inserted_in_batches(spark, sf):
    """The two loads of `insert_if_absent` through the store, whose key table is cut into buckets."""
    path = f"{shared_folder(spark)}/inserted-{uuid.uuid4().hex}"
    for rows in _halves(spark, sf):
        keyed.insert_if_absent(rows, path, ["uuid"], ["seq"])
    return keyed.read_inserted(spark, path)


@query
def indexed_in_batches(spark, sf):
    """The two loads as documents, the second overwriting the first by id."""
    path = f"{shared_folder(spark)}/indexed-{uuid.uuid4().hex}"
    for rows in _halves(spark, sf):
        newest = quality.first_per_key(rows.filter(F.col("uuid").isNotNull()), ["uuid"], [F.desc("seq")])
        keyed.write_documents(docs.collection_documents(newest.select("uuid", "type", "seq"), "alertas", "uuid"), path)
    return keyed.current_documents(spark, path)


@query
def index_counts(spark, sf):
    return docs.result_counts(_results(spark, sf))


# -- lookups --------------------------------------------------------------------------------

@query
def tagged_ids(spark, sf):
    return b.keys(spark, sf)


@query
def lookup_alerts(spark, sf):
    asked = b.requests(spark, sf).filter(F.col("tipo") == KIND_ALERT)
    return lookup.lookup_alerts(asked, b.alerts(spark, sf).select("uuid", "city", "type", "fecha"))


@query
def lookup_jams(spark, sf):
    asked = b.requests(spark, sf).filter(F.col("tipo") == KIND_JAM)
    return lookup.lookup_jams(asked, b.jams(spark, sf).select("uuid", "city", "length"))


@query
def tagged_lookup(spark, sf):
    return lookup.lookup_tagged(b.requests(spark, sf), b.keys(spark, sf))


@query
def request_outcomes(spark, sf):
    return suppression.request_outcomes(b.requests(spark, sf), b.keys(spark, sf))


@query
def request_summary(spark, sf):
    log = b.request_log(spark, sf)
    whole = lookup.request_summary(log.withColumn("tipo", F.lit("todos")), ("tipo",))
    return whole.unionByName(lookup.request_summary(log, ("tipo",)))


@query
def latency_percentiles(spark, sf):
    return lookup.latency_percentiles(b.request_log(spark, sf))


@query
def latency_sketches(spark, sf):
    """Whether quantiles merged from a sketch a day are within the rank error, by all latencies."""
    log = b.request_log(spark, sf).withColumn("run", F.floor(F.col("segundo") / 86400))
    merged = sketches.merged_percentiles(sketches.latency_sketches(log))
    ranked = log.filter(F.col("tiempo_ms").isNotNull()).join(F.broadcast(merged), "resultado")      # a row an outcome
    error, ms = sketches.KLL_RANK_ERROR, F.col("tiempo_ms")

    def near(q: int):
        below, upto = (F.count_if(test) / F.count("*") for test in (ms < F.col(f"p{q}"), ms <= F.col(f"p{q}")))
        return ((below <= q / 100 + error) & (upto >= q / 100 - error)).alias(f"p{q}_near")

    return ranked.groupBy("resultado").agg(F.max("n").alias("n"), *(near(q) for q in (50, 90, 99)))


@query
def run_key_sketches(spark, sf):
    """Ten files are a run; its sets of keys are below the sketch's size, and so exact."""
    items = _items(spark, sf).withColumn("run", F.substring("file", 6, 8))
    return sketches.key_summary(sketches.key_sketches(items))


@query
def ttl_first_seen(spark, sf):
    return suppression.fill_moments(b.events(spark, sf), ["user_id"], "segundo")


@query
def ttl_first_seen_by_type(spark, sf):
    """Few, busy keys: each holds a fifth of all events."""
    return suppression.fill_moments(b.events(spark, sf), ["event_type"], "segundo")


# -- grid -----------------------------------------------------------------------------------

@query
def grid_cells(spark, sf):
    return grid.cells_with_counts(b.alerts(spark, sf))


@query
def assign_cell(spark, sf):
    return grid.assign_cell(b.alerts(spark, sf)).select("uuid", "location_x", "location_y", "indice_celda")


@query
def counts_by_cell(spark, sf):
    return grid.counts_by_cell(b.alerts(spark, sf))


@query
def feed_cell_counts(spark, sf):
    return grid.feed_cell_counts(feeds.good_documents(feeds.parse_feed(b.feed_texts(spark, sf))))


# -- sampling -------------------------------------------------------------------------------

def _draws(spark, sf):
    return b.table(spark, sf, "events").select(F.col("event_id").alias("draw"))


@query
def shuffled_ids(spark, sf):
    return sampling.shuffled_keys(b.keys(spark, sf))


@query
def sample_normal(spark, sf):
    return sampling.sample_normal(sampling.shuffled_keys(b.keys(spark, sf)), _draws(spark, sf))


@query
def sample_zipf(spark, sf):
    return sampling.sample_zipf(sampling.listed_keys(b.keys(spark, sf)), _draws(spark, sf))


@query
def arrival_times(spark, sf):
    return sampling.arrival_times(_draws(spark, sf))
