"""Batch lookups by key, and the summary of a request log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from roadpulse.functions.text import filled, is_digits
from roadpulse.functions.values import mean_or_zero, share_percent
from roadpulse.operators.numbering import total_within
from roadpulse.operators.skew import join_unique
from roadpulse.schemas import HIT, KIND_ALERT, KIND_JAM, MISS, NOT_FOUND

FOUND = "encontrado"


def key_list(documents: DataFrame) -> DataFrame:
    """The keys of a collection, without the ones that are null, empty or the number 0."""
    uuid = F.col("uuid")
    keep = filled(uuid) if dict(documents.dtypes)["uuid"] == "string" else (uuid.isNotNull() & (uuid != 0))
    return documents.select(uuid.cast("string").alias("uuid")).filter(keep)


def tagged_keys(alerts: DataFrame, jams: DataFrame) -> DataFrame:
    """All keys of both collections with the kind each belongs to."""
    return (
        key_list(alerts).select(F.lit(KIND_ALERT).alias("tipo"), "uuid")
        .unionByName(key_list(jams).select(F.lit(KIND_JAM).alias("tipo"), "uuid"))
    )


def _status(found: Column) -> Column:
    return F.when(found, FOUND).otherwise(NOT_FOUND)


def lookup_alerts(requests: DataFrame, alerts: DataFrame) -> DataFrame:
    """Requests by alert uuid with the alert's columns and a status. `alerts.uuid` is unique."""
    known = alerts.withColumn("__found", F.lit(True))
    return join_unique(requests, known, ["uuid"]).withColumn(
        "estado", _status(F.col("__found").isNotNull())).drop("__found")


def lookup_jams(requests: DataFrame, jams: DataFrame) -> DataFrame:
    """Requests by jam key. Jam keys are whole numbers; any other text is simply not found."""
    number = F.when(is_digits(F.col("uuid")), F.col("uuid").try_cast("bigint"))
    numbered = requests.withColumn("__key", number)
    known = jams.withColumn("__key", F.col("uuid").try_cast("bigint")).withColumn(
        "__found", F.lit(True)).drop("uuid")
    return join_unique(numbered, known, ["__key"]).withColumn(
        "estado", _status(F.col("__found").isNotNull())).drop("__found", "__key")


def lookup_tagged(requests: DataFrame, keys: DataFrame) -> DataFrame:
    """Requests (`tipo`, `uuid`, ...) checked against the collection their tag names."""
    known = keys.select("tipo", "uuid", F.lit(True).alias("__found"))
    return join_unique(requests, known, ["tipo", "uuid"]).withColumn(
        "estado", _status(F.col("__found").isNotNull())).drop("__found")


def request_summary(log: DataFrame, groups: tuple[str, ...] = ()) -> DataFrame:
    """Totals, hit rate and latencies of a request log (`resultado`, `tiempo_ms`, `segundo`).

    Latencies are summed as decimals, so the sum does not depend on the order of the rows. With
    18 decimals a latency of 0.1 ms or more keeps all digits that it has as a double.
    """
    outcome, ms = F.col("resultado"), F.col("tiempo_ms").cast("decimal(38,18)")

    def spent(kind: str) -> Column:
        return F.coalesce(F.sum(F.when(outcome == kind, ms)), F.lit(0)).cast("double")

    totals = log.groupBy(*groups).agg(
        F.count("*").alias("total_requests"),
        F.count_if(outcome == HIT).alias("cache_hits"),
        F.count_if(outcome == MISS).alias("cache_misses"),
        F.count_if(outcome == NOT_FOUND).alias("not_found"),
        spent(HIT).alias("hit_ms"), spent(MISS).alias("miss_ms"),
        F.coalesce(F.max("segundo") - F.min("segundo"), F.lit(0)).alias("elapsed_seconds"),
    )
    return totals.withColumns({
        "hit_rate": share_percent(F.col("cache_hits"), F.col("total_requests")),
        "hit_ms_mean": mean_or_zero(F.col("hit_ms"), F.col("cache_hits")),
        "miss_ms_mean": mean_or_zero(F.col("miss_ms"), F.col("cache_misses")),
        "requests_per_second": mean_or_zero(F.col("total_requests"), F.col("elapsed_seconds")),
    })


def latency_percentiles(log: DataFrame, at: tuple[int, ...] = (50, 90, 99)) -> DataFrame:
    """Exact latency percentiles by outcome, in place of the full lists of latencies.

    Percentile q is the smallest latency that at least q % of the requests stay within. Rows
    are counted per distinct latency first, and the counts run up over ranges of latencies, so
    an outcome that holds all requests, each with its own latency, covers many tasks.
    """
    counts = log.filter(F.col("tiempo_ms").isNotNull()).groupBy("resultado", "tiempo_ms").agg(
        F.count("*").alias("__n"))
    ranked = total_within(counts, ["resultado"], ["tiempo_ms"], F.col("__n"), "__upto")
    totals = ranked.groupBy(F.col("resultado").alias("__outcome")).agg(F.max("__upto").alias("__all"))
    within = [F.min(F.when(F.col("__upto") * 100 >= F.col("__all") * q, F.col("tiempo_ms"))).alias(f"p{q}")
              for q in at]
    return (
        ranked.join(totals, F.col("resultado").eqNullSafe(F.col("__outcome")))
        .groupBy("resultado").agg(F.max("__all").alias("n"), *within)
    )
