"""Counts, totals and rankings. Every ranking ends in its name columns, so ties are settled."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from roadpulse.functions.values import hour_of_day
from roadpulse.operators.quality import of_kind, shifted_rows
from roadpulse.schemas import ACCIDENT, JAM_COLUMNS, RESULT_COLUMNS

CUBE_KEYS = ["hora", "city", "type", "street"]


def with_hour(alerts: DataFrame) -> DataFrame:
    return alerts.withColumn("hora", hour_of_day(F.col("fecha")))


def count_rows(df: DataFrame, key: str = "uuid") -> DataFrame:
    """One row with the number of rows that have a key (0 for an empty table)."""
    return df.agg(F.count(key).alias("count"))


def ranking(df: DataFrame, groups: dict[str, str], count_name: str, weight: str | None = None) -> DataFrame:
    """Rows (or the sum of `weight`) per group, largest first.

    `groups` maps input columns to output names.
    """
    measure = F.count("*") if weight is None else F.sum(weight)
    names = list(groups.values())
    return (
        df.groupBy(*[F.col(c).alias(name) for c, name in groups.items()])
        .agg(measure.alias(count_name))
        .orderBy(F.desc(count_name), *names)
    )


def alert_cube(alerts: DataFrame) -> DataFrame:
    """Clean alerts counted by hour, city, type and street.

    All alert rankings are sums over this one small table, so the row-level table is read and
    shuffled once instead of once per ranking.
    """
    return with_hour(alerts).groupBy(*CUBE_KEYS).agg(F.count("*").alias("n"))


# Each ranking takes clean alerts, or an `alert_cube` together with weight="n".

def peak_hours(alerts: DataFrame, weight: str | None = None) -> DataFrame:
    rows = alerts if "hora" in alerts.columns else with_hour(alerts)
    return ranking(rows, {"hora": "hora"}, "cantidad_alertas", weight)


def alerts_by_city(alerts: DataFrame, weight: str | None = None) -> DataFrame:
    return ranking(alerts, {"city": "comuna"}, "cantidad_alertas", weight)


def alerts_by_type(alerts: DataFrame, weight: str | None = None) -> DataFrame:
    return ranking(alerts, {"type": "tipo_alerta"}, "cantidad", weight)


def alerts_by_street(alerts: DataFrame, weight: str | None = None) -> DataFrame:
    return ranking(alerts, {"street": "calle"}, "cantidad_alertas", weight)


def accidents_by_city(alerts: DataFrame, weight: str | None = None, kind: str = ACCIDENT) -> DataFrame:
    return ranking(of_kind(alerts, kind), {"city": "comuna"}, "cantidad_accidentes", weight)


def accidents_by_street_city(alerts: DataFrame, weight: str | None = None, kind: str = ACCIDENT) -> DataFrame:
    groups = {"street": "calle", "city": "ciudad"}
    return ranking(of_kind(alerts, kind), groups, "cantidad_accidentes", weight)


def count_kind(alerts: DataFrame, kind: str = ACCIDENT) -> DataFrame:
    return count_rows(of_kind(alerts, kind))


def jams_by_city(jams: DataFrame) -> DataFrame:
    return (
        jams.groupBy(F.col("city").alias("ciudad"))
        .agg(F.sum("length").alias("largo_total"), F.count("*").alias("num_atascos"))
        .orderBy(F.desc("largo_total"), "ciudad")
    )


def longest_jams(jams: DataFrame) -> DataFrame:
    """All jams, longest first; the uuid splits long runs of equal lengths over partitions."""
    return jams.select(*JAM_COLUMNS).orderBy(F.desc("length"), "uuid")


def result_tables(
    alerts: DataFrame, jams: DataFrame, raw_alerts: DataFrame, cube: DataFrame | None = None, ordered: bool = True,
) -> dict[str, DataFrame]:
    """The nine named result tables from clean alerts, clean jams and the raw alert load.

    Pass a written `alert_cube` as `cube` when several tables are to be computed. Whoever numbers the rows sorts them
    anyway, so the list of all jams can be had without its order.
    """
    cube = alert_cube(alerts) if cube is None else cube
    tables = {
        "horas_pico": peak_hours(cube, "n"),
        "comunas_con_mas_alertas": alerts_by_city(cube, "n"),
        "tipos_alerta_frecuencia": alerts_by_type(cube, "n"),
        "alertas_tipo_false": shifted_rows(raw_alerts),
        "comunas_con_mas_accidentes": accidents_by_city(cube, "n"),
        "calles_con_mas_alertas": alerts_by_street(cube, "n"),
        "calles_con_mas_accidentes": accidents_by_street_city(cube, "n"),
        "atascos_largos": longest_jams(jams) if ordered else jams,
        "atascos_por_ciudad": jams_by_city(jams),
    }
    return {name: df.select(*RESULT_COLUMNS[name]) for name, df in tables.items()}
