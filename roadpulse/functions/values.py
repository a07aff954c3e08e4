"""Numbers, times and defaults."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from roadpulse.schemas import NO_HOUR


def first_present(*cols: Column) -> Column:
    """First non-null value. A missing field and a present null count alike."""
    return F.coalesce(*cols)


def slice_text(col: Column, start: int, end: int) -> Column:
    """Characters `start` to `end` (0-based, end exclusive); null when the text ends before."""
    return F.when(F.length(col) >= start, F.substring(col, start + 1, end - start))


def hour_of_day(fecha: Column) -> Column:
    """Two-character hour of a `YYYY-MM-DD HH:MM:SS` text."""
    return slice_text(fecha, 11, 13)


def hour_number(hora: Column) -> Column:
    """Hour as a number for sorting; -1 where there is none."""
    return F.coalesce(hora.try_cast("int"), F.lit(-1))


def hour_label(hora: Column) -> Column:
    return F.coalesce(hora, F.lit(NO_HOUR))


def seconds_of(stamp: Column) -> Column:
    """Whole seconds since 1970 of a `timestamp_ntz`, from its calendar fields.

    Subtracting timestamps would take them through the session's time zone and its gaps.
    """
    days = F.datediff(stamp.cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    return days * 86400 + F.hour(stamp) * 3600 + F.minute(stamp) * 60 + F.second(stamp)


def epoch_seconds(fecha: Column) -> Column:
    """Whole seconds since 1970 of a `YYYY-MM-DD HH:MM:SS` text; null if it is none."""
    return seconds_of(F.substring(fecha, 1, 19).try_cast("timestamp_ntz"))


def share_percent(part: Column, whole: Column) -> Column:
    """100 * part / whole, and 0 where the whole is 0."""
    return F.when(whole > 0, F.lit(100.0) * part / whole).otherwise(F.lit(0.0))


def mean_or_zero(total: Column, n: Column) -> Column:
    return F.when(n > 0, total / n).otherwise(F.lit(0.0))


def seconds_to_ms(seconds: Column) -> Column:
    return F.round(seconds * 1000, 2)


def nearest_index(position: Column, n: Column) -> Column:
    """Round half to even, then clip into 0 .. n-1."""
    return F.least(F.greatest(F.rint(position), F.lit(0.0)), n - 1).cast("long")


def document_json(*cols: str) -> Column:
    """The named columns as one JSON text, nulls included."""
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})
