"""Row filters, quarantine, and the first record per key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from roadpulse.functions.text import filled
from roadpulse.schemas import ALERT_COLUMNS, JAM_COLUMNS, SHIFTED_TYPE


def drop_header_rows(df: DataFrame, key: str = "uuid") -> DataFrame:
    """Drop header lines that ended up in the data; a null key goes too (`<>` is not true)."""
    return df.filter(F.col(key) != key)


def is_complete(df: DataFrame, columns: list[str]) -> Column:
    """Every column non-null and, for texts, not empty."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    tests = [filled(F.col(c)) if isinstance(kinds[c], T.StringType) else F.col(c).isNotNull()
             for c in columns]
    return reduce(lambda a, b: a & b, tests)


def complete(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.filter(is_complete(df, columns))


def first_per_key(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """The first row of each key. `order` should be total, or ties are arbitrary.

    `row_number() = 1` lets Spark cut each key to one row per task before the shuffle
    (WindowGroupLimit), so a hot key never travels whole.
    """
    place = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(place)).filter(F.col("__rn") == 1).drop("__rn")


def clean_alerts(staged: DataFrame, tie_break: tuple[str, ...] = ()) -> DataFrame:
    """Header rows out, complete rows only, earliest report per uuid.

    Ties in `fecha` go to the lowest `tie_break` (an ingest sequence, say). Without one they
    go to the lowest remaining columns, so the result never depends on partitioning; but then
    all columns are sorted and shuffled even if few are used afterwards.
    """
    return _clean(staged, ALERT_COLUMNS, tie_break)


def clean_jams(staged: DataFrame, tie_break: tuple[str, ...] = ()) -> DataFrame:
    return _clean(staged, JAM_COLUMNS, tie_break)


def _clean(staged: DataFrame, columns: list[str], tie_break: tuple[str, ...]) -> DataFrame:
    kept = complete(drop_header_rows(staged), columns)
    rest = [c for c in columns if c not in ("uuid", "fecha")]
    return first_per_key(kept, ["uuid"], ["fecha", *(tie_break or rest)]).select(*columns)


def of_kind(alerts: DataFrame, kind: str) -> DataFrame:
    return alerts.filter(F.col("type") == kind)


def shifted_rows(raw_alerts: DataFrame, vocabulary: list[str] | None = None) -> DataFrame:
    """Rows whose `type` shows that their columns slipped; run this before `complete`.

    By default only the text that a slipped municipality flag leaves there. With a
    `vocabulary`, any type outside it.
    """
    slipped = F.col("type") == SHIFTED_TYPE
    if vocabulary is not None:
        slipped = slipped | ~F.col("type").isin(vocabulary)
    return raw_alerts.filter(slipped)


def funnel(staged: DataFrame, columns: list[str], kind: str) -> DataFrame:
    """One row: how many rows remain after each cleaning step, in one pass."""
    rows = drop_header_rows(staged)
    whole = is_complete(rows, columns)
    return rows.agg(
        F.count("*").alias("total"),
        F.count_if(whole).alias("complete"),
        F.count_distinct(F.when(whole, F.col("uuid"))).alias("distinct_keys"),
    ).select(F.lit(kind).alias("kind"), "total", "complete", "distinct_keys")
