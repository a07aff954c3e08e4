"""Top-k cuts of the result tables. Each plans as TakeOrderedAndProject: k rows per task."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from roadpulse.functions.values import hour_label, hour_number


def top(df: DataFrame, measure: str, names: list[str], k: int | None) -> DataFrame:
    """Largest `measure` first, ties by name; `k=None` keeps all rows."""
    ordered = df.orderBy(F.desc(measure), *names)
    return ordered if k is None else ordered.limit(k)


def sample_rows(df: DataFrame, k: int = 10, key: str = "uuid") -> DataFrame:
    """A small fixed look at a table: the first `k` rows by key."""
    return df.orderBy(key).limit(k)


def hour_distribution(hours: DataFrame) -> DataFrame:
    """Peak hours in the order of the day, rows without an hour first."""
    return hours.select(
        "hora", "cantidad_alertas",
        hour_label(F.col("hora")).alias("hora_etiqueta"),
        hour_number(F.col("hora")).alias("hora_num"),
    ).orderBy("hora_num", "hora_etiqueta")


def _cut(measure: str, names: list[str], k: int | None) -> Callable[[DataFrame], DataFrame]:
    return lambda df: top(df, measure, names, k)


# Chart name -> (result table it reads, cut).
CHARTS: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "calles_con_mas_accidentes": (
        "calles_con_mas_accidentes", _cut("cantidad_accidentes", ["calle", "ciudad"], 10)),
    "calles_con_mas_alertas": ("calles_con_mas_alertas", _cut("cantidad_alertas", ["calle"], 10)),
    "comunas_con_mas_accidentes": (
        "comunas_con_mas_accidentes", _cut("cantidad_accidentes", ["comuna"], 5)),
    "comunas_con_mas_alertas": ("comunas_con_mas_alertas", _cut("cantidad_alertas", ["comuna"], 10)),
    "horas_pico": ("horas_pico", hour_distribution),
    "tipos_alerta_frecuencia": ("tipos_alerta_frecuencia", _cut("cantidad", ["tipo_alerta"], None)),
    "atascos_por_ciudad_largo": ("atascos_por_ciudad", _cut("largo_total", ["ciudad"], 10)),
    "atascos_por_ciudad_numero": ("atascos_por_ciudad", _cut("num_atascos", ["ciudad"], 10)),
}


def charts_for(result_name: str) -> list[str]:
    """Charts drawn from a result whose (file) name contains a known table name."""
    found = [c for c, (table, _) in CHARTS.items() if table in result_name.lower()]
    if not found:
        raise KeyError(f"no chart is made from result {result_name!r}")
    return found


def chart_data(chart: str, results: dict[str, DataFrame]) -> DataFrame:
    table, cut = CHARTS[chart]
    return cut(results[table])
