"""Schemas of the feed, the staged tables, the request log and the result tables."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _D, _I, _L = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType()


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


# -- stored documents and the feed they come from -------------------------------------------

ALERT_DOCUMENT = struct(
    uuid=_S, city=_S, reportByMunicipalityUser=_S, type=_S, subtype=_S, reportBy=_S,
    reportRating=_I, street=_S, confidence=_D, location=struct(x=_D, y=_D), x=_D, y=_D,
    fecha=_S, region=_S,
)
JAM_DOCUMENT = struct(
    uuid=_L, severity=_I, country=_S, length=_I, endNode=_S, roadType=_I, speedKMH=_D,
    speed=_D, street=_S, fecha=_S, region=_S, city=_S,
)
# Cells are taken as JSON text first, so that a misshapen one spoils no other.
FEED = struct(celdas=T.ArrayType(_S))
# One element of a flat feed: only the fields that tell the kinds apart, as text.
FLAT_OBJECT = struct(
    uuid=_S, type=_S, subtype=_S, reportRating=_S, roadType=_S, street=_S, city=_S, fecha=_S,
)

# -- staged tables --------------------------------------------------------------------------

ALERTS = struct(
    uuid=_S, city=_S, municipalityUser=_S, type=_S, street=_S, confidence=_D,
    location_x=_D, location_y=_D, fecha=_S,
)
JAMS = struct(
    uuid=_S, severity=_I, country=_S, length=_I, endnode=_S, roadtype=_I, speed=_D,
    street=_S, fecha=_S, region=_S, city=_S,
)
ALERT_COLUMNS = ALERTS.fieldNames()
JAM_COLUMNS = JAMS.fieldNames()

# -- lookups --------------------------------------------------------------------------------

REQUESTS = struct(ts=T.TimestampNTZType(), tipo=_S, uuid=_S, resultado=_S, tiempo_ms=_D)

# -- fixed values: names that must equal the published result layouts -----------------------

KIND_ALERT, KIND_JAM, KIND_MIXED, KIND_UNKNOWN = "alerta", "atasco", "mixto", "desconocido"
HIT, MISS, NOT_FOUND = "hit", "miss", "no_encontrado"
ACCIDENT = "ACCIDENT"
SHIFTED_TYPE = "false"          # what lands in `type` when an unquoted comma shifts a row
RUN_NAME = r"^ejecucion_\d{8}_\d{6}$"
NOT_AVAILABLE = "N/A"
NO_HOUR = "Sin hora"

RESULT_COLUMNS = {
    "horas_pico": ["hora", "cantidad_alertas"],
    "comunas_con_mas_alertas": ["comuna", "cantidad_alertas"],
    "tipos_alerta_frecuencia": ["tipo_alerta", "cantidad"],
    "alertas_tipo_false": ALERT_COLUMNS,
    "comunas_con_mas_accidentes": ["comuna", "cantidad_accidentes"],
    "calles_con_mas_alertas": ["calle", "cantidad_alertas"],
    "calles_con_mas_accidentes": ["calle", "ciudad", "cantidad_accidentes"],
    "atascos_largos": JAM_COLUMNS,
    "atascos_por_ciudad": ["ciudad", "largo_total", "num_atascos"],
}
# The order each result table is ranked and numbered in: column, ascending or not.
RESULT_ORDER = {
    "horas_pico": [("cantidad_alertas", False), ("hora", True)],
    "comunas_con_mas_alertas": [("cantidad_alertas", False), ("comuna", True)],
    "tipos_alerta_frecuencia": [("cantidad", False), ("tipo_alerta", True)],
    "alertas_tipo_false": [("uuid", True), ("fecha", True)],
    "comunas_con_mas_accidentes": [("cantidad_accidentes", False), ("comuna", True)],
    "calles_con_mas_alertas": [("cantidad_alertas", False), ("calle", True)],
    "calles_con_mas_accidentes": [("cantidad_accidentes", False), ("calle", True), ("ciudad", True)],
    "atascos_largos": [("length", False), ("uuid", True)],
    "atascos_por_ciudad": [("largo_total", False), ("ciudad", True)],
}
