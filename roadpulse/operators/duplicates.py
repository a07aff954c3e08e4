"""Reports on repeated keys, per file and across files.

Input rows ("items") carry `file`, `pos` (place in the file), `uuid` and `kind`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from roadpulse.functions.values import share_percent
from roadpulse.operators.numbering import number_within
from roadpulse.operators.skew import join_unique
from roadpulse.schemas import KIND_ALERT, KIND_JAM, KIND_MIXED, KIND_UNKNOWN


def guess_kind(objects: DataFrame) -> DataFrame:
    """Add `kind` to flat feed objects from the fields they have."""
    jam = F.col("roadType").isNotNull() & F.col("street").isNotNull()
    alert = F.col("subtype").isNotNull() & F.col("reportRating").isNotNull()
    return objects.withColumn(
        "kind", F.when(jam, KIND_JAM).when(alert, KIND_ALERT).otherwise(KIND_UNKNOWN))


def _per_key(items: DataFrame, keys: list[str], *more: Column) -> DataFrame:
    return items.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.count_if(F.col("kind") == KIND_ALERT).alias("alerts"),
        F.count_if(F.col("kind") == KIND_JAM).alias("jams"),
        *more,
    )


def keys_by_file(items: DataFrame) -> DataFrame:
    """One row per (file, uuid): how often, and of which kind (`mixto` = both)."""
    seen = _per_key(items.filter(F.col("uuid").isNotNull()), ["file", "uuid"])
    both = (F.col("alerts") > 0) & (F.col("jams") > 0)
    return seen.withColumn(
        "kind", F.when(both, KIND_MIXED).when(F.col("alerts") > 0, KIND_ALERT)
        .when(F.col("jams") > 0, KIND_JAM).otherwise(KIND_UNKNOWN))


def flat_keys_by_file(items: DataFrame) -> DataFrame:
    """As `keys_by_file` for flat feeds, where the order in the file matters.

    The kind is that of the first object with the key; any later *known* kind that differs
    makes it mixed, a later unknown one changes nothing. The first kind is found as the
    lowest (position, code) pair packed into one number, which aggregates in a hash table.
    """
    code = F.when(F.col("kind") == KIND_ALERT, 1).when(F.col("kind") == KIND_JAM, 2).otherwise(0)
    first = F.min(F.col("pos") * 4 + code).alias("__first")
    seen = _per_key(items.filter(F.col("uuid").isNotNull()), ["file", "uuid"], first)
    first_code = F.col("__first") % 4
    other_alert = (F.col("alerts") > 0) & (first_code != 1)
    other_jam = (F.col("jams") > 0) & (first_code != 2)
    kind = (F.when(other_alert | other_jam, KIND_MIXED).when(first_code == 1, KIND_ALERT)
            .when(first_code == 2, KIND_JAM).otherwise(KIND_UNKNOWN))
    return seen.withColumn("kind", kind).drop("__first")


def repeated(per_file: DataFrame) -> DataFrame:
    return per_file.filter(F.col("n") > 1).select("file", "uuid", "n", "kind")


def file_summary(per_file: DataFrame) -> DataFrame:
    """Per file: objects, alerts, jams, distinct and repeated keys, also by kind."""
    dup = F.col("n") > 1

    def of(kind: str) -> Column:
        return F.count_if(dup & (F.col("kind") == kind))

    return per_file.groupBy("file").agg(
        F.sum("n").alias("objects"), F.sum("alerts").alias("alerts"), F.sum("jams").alias("jams"),
        F.count("*").alias("unique_keys"), F.count_if(dup).alias("duplicated"),
        of(KIND_ALERT).alias("dup_alerta"), of(KIND_JAM).alias("dup_atasco"),
        of(KIND_MIXED).alias("dup_mixto"), of(KIND_UNKNOWN).alias("dup_desconocido"),
    ).withColumn("dup_percent", share_percent(F.col("duplicated"), F.col("unique_keys")))


def global_summary(summary: DataFrame) -> DataFrame:
    return summary.agg(
        F.count("*").alias("files"),
        F.count_if(F.col("duplicated") > 0).alias("files_with_duplicates"),
        F.coalesce(F.sum("duplicated"), F.lit(0)).alias("duplicated"),
    )


def repeated_keys(items: DataFrame, key: str = "uuid") -> DataFrame:
    """Keys that occur more than once anywhere, most frequent first."""
    return (
        items.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
        .filter(F.col("n") > 1).orderBy(F.desc("n"), key)
    )


def repeated_instances(reports: DataFrame) -> DataFrame:
    """Every occurrence of every repeated key, numbered 1.. by (file, pos).

    Row form instead of one list per key, so a key with billions of occurrences stays spread:
    hot keys are salted in the join and range-split in the numbering. Materialises once.
    """
    keyed = reports.filter(F.col("uuid").isNotNull())
    counts = keyed.groupBy("uuid").agg(F.count("*").alias("n"))
    instances = join_unique(keyed, counts.filter(F.col("n") > 1), ["uuid"], "inner",
                            spread=["file", "pos"], counts=counts, n="n")
    return number_within(instances, ["uuid"], ["file", "pos"], "instance")


def key_counts(items: DataFrame, key: str = "uuid") -> DataFrame:
    """Total, distinct and repeated keys in one row."""
    return items.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
        F.count("*").alias("distinct_keys"),
        F.count_if(F.col("n") > 1).alias("repeated_keys"),
    )


def approximate_key_counts(items: DataFrame, key: str = "uuid", error: float = 0.01) -> DataFrame:
    """Total and roughly how many distinct keys, without a shuffle of the keys."""
    return items.agg(F.count(key).alias("total"),
                     F.approx_count_distinct(key, error).alias("distinct_keys"))


def mixed_keys(items: DataFrame) -> DataFrame:
    """Keys that occur as an alert and as a jam.

    One aggregation instead of an intersection, which would join the rows of a hot key.
    """
    kinds = {kind: F.bool_or(F.col("kind") == kind) for kind in (KIND_ALERT, KIND_JAM)}
    seen = items.filter(F.col("uuid").isNotNull()).groupBy("uuid").agg(
        *[test.alias(kind) for kind, test in kinds.items()])
    return seen.filter(F.col(KIND_ALERT) & F.col(KIND_JAM)).select("uuid")
