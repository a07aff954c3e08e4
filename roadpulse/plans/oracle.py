"""The registered queries again as plain SQL, written against the tables independently.

Each query names the common table expressions it needs; `sql` puts them in front.
"""

from __future__ import annotations

CTES: dict[str, tuple[list[str], str]] = {}      # name -> (needs, body)
ORACLE: dict[str, str] = {}


def cte(name: str, body: str, needs: str = "") -> None:
    CTES[name] = (needs.split(), body)


def sql(name: str, body: str, needs: str = "", recursive: str = "") -> None:
    ordered: list[str] = []

    def add(part: str) -> None:
        for inner in CTES[part][0]:
            add(inner)
        if part not in ordered:
            ordered.append(part)

    for part in needs.split():
        add(part)
    parts = [f"{p} AS ({CTES[p][1]})" for p in ordered] + ([recursive] if recursive else [])
    word = "WITH RECURSIVE " if recursive else "WITH "
    ORACLE[name] = (word + ",\n".join(parts) + "\n" if parts else "") + body


TITLE = r"array_to_string(list_transform(regexp_extract_all(lower({0}), '(\p{{L}}+|[^\p{{L}}]+)'), lambda t: upper(t[1]) || t[2:]), '')"


def city(text: str) -> str:
    """SQL for a normalised place name."""
    parts = f"string_split(replace({text}, ',', ';'), ';')"
    return f"array_to_string(list_transform({parts}, lambda p: {TITLE.format('trim(p)')}), ';')"


# -- inputs ---------------------------------------------------------------------------------

cte("ev", """
  SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS fecha,
         CAST(floor(epoch(ts)) AS BIGINT) AS segundo,
         event_type IN ('error', 'view', 'signup') AS is_alert
  FROM events""")

cte("alert_docs", """
  SELECT event_id AS seq,
         CASE WHEN k <> 13 THEN 'a' || CAST((event_id * 4) // 5 AS VARCHAR) END AS uuid,
         CASE WHEN user_id % 25 = 11 THEN ''
              WHEN user_id % 25 <> 7 THEN 'comuna ' || CAST(user_id % 25 AS VARCHAR)
                                          || ', sector ' || CAST(user_id % 3 AS VARCHAR) END AS city,
         CASE WHEN event_id % 11 = 0 THEN 'true' ELSE 'false' END AS reportByMunicipalityUser,
         CASE WHEN k = 99 THEN 'false' ELSE kind END AS type,
         CASE WHEN value >= 5 THEN kind || '_' || CAST(k % 3 AS VARCHAR) END AS subtype,
         CASE WHEN k % 4 <> 0 THEN 'user' || CAST(user_id AS VARCHAR) END AS reportBy,
         CASE WHEN k <> 50 THEN 'Calle ' || CAST(k AS VARCHAR) END AS street,
         CASE WHEN value >= 1 THEN value END AS confidence,
         CASE WHEN user_id % 10 <> 3 THEN px END AS loc_x,
         CASE WHEN user_id % 10 <> 3 THEN py END AS loc_y,
         CASE WHEN user_id % 20 = 3 THEN px END AS x,
         CASE WHEN user_id % 20 = 3 THEN py END AS y,
         fecha
  FROM (SELECT *, CASE event_type WHEN 'error' THEN 'ACCIDENT' WHEN 'click' THEN 'JAM'
                    WHEN 'view' THEN 'HAZARD' WHEN 'signup' THEN 'ROAD_CLOSED'
                    WHEN 'purchase' THEN 'POLICE' END AS kind,
               CAST(-71.0 AS DOUBLE) + CAST(event_id % 534 AS DOUBLE) / CAST(1000 AS DOUBLE) AS px,
               CAST(-33.2 AS DOUBLE) - CAST(event_id % 507 AS DOUBLE) / CAST(1000 AS DOUBLE) AS py
        FROM ev)""", "ev")

cte("staged_alerts", f"""
  SELECT coalesce(uuid, 'item_' || CAST(seq AS VARCHAR)) AS uuid,
         {city("coalesce(city, '')")} AS city,
         reportByMunicipalityUser AS "municipalityUser", type, coalesce(street, '') AS street,
         coalesce(confidence, CAST(0 AS DOUBLE)) AS confidence,
         coalesce(loc_x, x, CAST(0 AS DOUBLE)) AS location_x,
         coalesce(loc_y, y, CAST(0 AS DOUBLE)) AS location_y, fecha, seq
  FROM alert_docs""", "alert_docs")

cte("whole_alerts", """
  SELECT * FROM staged_alerts
  WHERE uuid <> 'uuid' AND uuid <> '' AND city <> '' AND "municipalityUser" <> '' AND type <> ''
    AND street <> '' AND confidence IS NOT NULL AND location_x IS NOT NULL
    AND location_y IS NOT NULL AND fecha <> ''""", "staged_alerts")

cte("alerts", """
  SELECT * EXCLUDE (seq, rn)
  FROM (SELECT *, row_number() OVER (PARTITION BY uuid ORDER BY fecha, seq) AS rn FROM whole_alerts)
  WHERE rn = 1""", "whole_alerts")

cte("staged_jams", f"""
  SELECT CAST(l_orderkey * 8 + l_linenumber AS VARCHAR) AS uuid, l_linenumber AS severity,
         n_name AS country,
         CASE WHEN NOT (l_linenumber = 6 AND l_returnflag = 'A') THEN CAST(l_quantity AS INTEGER) END AS length,
         CASE WHEN l_linenumber = 5 AND l_linestatus = 'O' THEN '' ELSE l_returnflag END AS endnode,
         CAST(round(l_tax * 100) AS INTEGER) AS roadtype,
         CASE WHEN l_linenumber > 2 THEN l_extendedprice
              WHEN l_linenumber <> 7 THEN l_discount END AS speed,
         s_name AS street, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS fecha, r_name AS region,
         {city("lower(n_name)")} AS city
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey""")

cte("whole_jams", """
  SELECT * FROM staged_jams
  WHERE uuid <> 'uuid' AND uuid <> '' AND severity IS NOT NULL AND country <> ''
    AND length IS NOT NULL AND endnode <> '' AND roadtype IS NOT NULL AND speed IS NOT NULL
    AND street <> '' AND fecha <> '' AND region <> '' AND city <> ''""", "staged_jams")

cte("jams", """
  SELECT * EXCLUDE (rn)
  FROM (SELECT *, row_number() OVER (PARTITION BY uuid ORDER BY fecha, severity, country, length,
               endnode, roadtype, speed, street, region, city) AS rn FROM whole_jams)
  WHERE rn = 1""", "whole_jams")

cte("ids", """
  SELECT DISTINCT 'alerta' AS tipo, uuid FROM alert_docs WHERE uuid IS NOT NULL AND uuid <> ''
  UNION ALL
  SELECT DISTINCT 'atasco' AS tipo, uuid FROM staged_jams WHERE uuid <> '0'""", "alert_docs staged_jams")

cte("requests", """
  SELECT event_id AS seq, segundo, CASE WHEN is_alert THEN 'alerta' ELSE 'atasco' END AS tipo,
         CASE WHEN event_type IN ('error', 'view') THEN 'a80'
              WHEN is_alert AND k % 10 = 0 THEN 'zz' || CAST(k AS VARCHAR)
              WHEN is_alert THEN 'a' || CAST(user_id * 7 AS VARCHAR)
              WHEN k % 10 = 1 THEN 'jam-' || CAST(k AS VARCHAR)
              ELSE CAST(user_id * 8 + k % 7 AS VARCHAR) END AS uuid
  FROM ev""", "ev")

cte("feed_rows", """
  SELECT printf('feed_%09d.json', event_id // 64) AS file, event_id // 64 AS n,
         CAST((event_id % 64) // 8 AS INTEGER) AS cell, event_id, is_alert, event_type, k, value, fecha,
         CASE WHEN is_alert THEN 'alerta' ELSE 'atasco' END AS kind,
         CAST(user_id AS VARCHAR) AS uuid
  FROM ev""", "ev")

cte("keys_by_file", """
  SELECT file, uuid, count(*) AS n, count(*) FILTER (kind = 'alerta') AS alerts,
         count(*) FILTER (kind = 'atasco') AS jams,
         CASE WHEN count(DISTINCT kind) = 2 THEN 'mixto' ELSE min(kind) END AS kind
  FROM feed_rows GROUP BY file, uuid""", "feed_rows")

cte("flat_rows", """
  SELECT printf('flat_%09d.json', event_id // 64) AS file, event_id % 64 AS pos,
         CAST(user_id % 40 AS VARCHAR) AS uuid,
         CASE WHEN event_type = 'click' THEN 'atasco' WHEN event_type IN ('error', 'view') THEN 'alerta'
              ELSE 'desconocido' END AS kind
  FROM ev""", "ev")

cte("reports", """
  SELECT uuid, coalesce(subtype, 'N/A') AS subtype, coalesce(type, 'N/A') AS type,
         coalesce(reportBy, 'N/A') AS reportby, coalesce(city, 'N/A') AS city,
         replace(substr(fecha, 1, 10), '-', '') || '.json' AS file, seq AS pos
  FROM alert_docs""", "alert_docs")

# -- sources --------------------------------------------------------------------------------

sql("unnest_feed", """
SELECT file, cell, CAST(row_number() OVER (PARTITION BY file, cell, kind ORDER BY event_id) - 1 AS INTEGER) AS pos,
       kind, uuid, CASE WHEN is_alert THEN event_type END AS type,
       CASE WHEN NOT is_alert THEN k END AS length, fecha
FROM feed_rows""", "feed_rows")

sql("feed_quarantine", """
SELECT file, CASE WHEN n % 5 = 0 THEN 'malformed' WHEN n % 7 = 0 THEN 'missing_celdas' ELSE 'ok' END AS reason
FROM feed_rows GROUP BY file, n""", "feed_rows")

sql("flat_kind_guess", "SELECT file, pos, uuid, kind FROM flat_rows", "flat_rows")

sql("collection_scan",
    "SELECT uuid, city, type, street, confidence, loc_x AS lx, x, fecha FROM alert_docs", "alert_docs")

sql("typed_csv_load", """
SELECT 'a' || CAST(event_id AS VARCHAR) AS uuid, 'Av. ' || CAST(k AS VARCHAR) || ', poniente' AS city,
       'false' AS "municipalityUser", event_type AS type, 'Calle ' || CAST(k AS VARCHAR) AS street,
       CASE WHEN k % 10 > 1 THEN value END AS confidence, CAST(k AS DOUBLE) / 4 AS location_x,
       CAST(k AS DOUBLE) / -2 AS location_y, fecha
FROM ev""", "ev")

cte("runs", """
  SELECT CASE WHEN substr(fecha, 12, 2) = '12' THEN 'zz_' || replace(substr(fecha, 1, 10), '-', '')
              ELSE 'ejecucion_' || replace(substr(fecha, 1, 10), '-', '') || '_'
                   || substr(fecha, 12, 2) || '0000' END AS run_id, event_id, event_type, fecha
  FROM ev""", "ev")

sql("latest_run", r"""
SELECT run_id, event_id, event_type, fecha FROM runs
WHERE run_id = (SELECT max(run_id) FROM runs WHERE regexp_full_match(run_id, 'ejecucion_\d{8}_\d{6}'))""", "runs")

sql("feed_lenient", r"""
SELECT file, cell, kind, fecha, uuid,
       CASE WHEN is_alert AND NOT regexp_matches(CAST(value AS VARCHAR), '[05]$') THEN value
            WHEN NOT is_alert AND k % 2 = 0 THEN CAST(k AS DOUBLE) END AS number
FROM feed_rows""", "feed_rows")

sql("uuid_list", """
SELECT 'alerta' AS tipo, uuid FROM alert_docs WHERE uuid IS NOT NULL AND uuid <> ''
UNION ALL SELECT 'atasco', uuid FROM staged_jams WHERE uuid <> '0'""", "alert_docs staged_jams")

# -- projections and filters ----------------------------------------------------------------

sql("stage_alerts", "SELECT * FROM staged_alerts", "staged_alerts")
sql("stage_jams", "SELECT * FROM staged_jams", "staged_jams")
sql("annotate_rows", "SELECT event_id, '2024-02-01 00:00:00' AS fecha, 'Santiago' AS region FROM events")
sql("fallback_chain", """
SELECT seq, coalesce(loc_x, x, CAST(0 AS DOUBLE)) AS location_x,
       coalesce(loc_y, y, CAST(0 AS DOUBLE)) AS location_y FROM alert_docs""", "alert_docs")
sql("hour_extract", """
SELECT event_id, CASE WHEN k % 9 = 0 THEN substr(fecha, 1, 10) ELSE fecha END AS fecha,
       CASE WHEN k % 9 <> 0 THEN substr(fecha, 12, 2) END AS hora FROM ev""", "ev")
sql("lenient_cast", """
SELECT event_id AS uuid, CASE WHEN k % 5 > 1 THEN value END AS confidence,
       CASE WHEN k % 7 <> 0 THEN k END AS length FROM ev""", "ev")
sql("normalize_cities", f"""
SELECT p_partkey, {city("p_name || ' , o''' || p_brand || '-' || lower(p_type) || CAST(p_size AS VARCHAR) || 'x ;Ñuñoa '")} AS city
FROM part""")
sql("surrogate_key", """
SELECT coalesce(uuid, 'item_' || CAST(n AS VARCHAR)) AS uuid, n, seq
FROM (SELECT *, row_number() OVER (ORDER BY fecha, seq) - 1 AS n FROM alert_docs)""", "alert_docs")
sql("header_filter", "SELECT uuid, type, seq FROM alert_docs WHERE type <> 'POLICE' AND uuid IS NOT NULL", "alert_docs")
sql("complete_alerts", "SELECT * FROM whole_alerts", "whole_alerts")
sql("complete_jams", "SELECT * FROM whole_jams", "whole_jams")
sql("filter_kind", "SELECT * FROM alerts WHERE type = 'ACCIDENT'", "alerts")
sql("quarantine_false", "SELECT * FROM staged_alerts WHERE type = 'false'", "staged_alerts")
sql("bbox_filter", """
SELECT uuid, location_x, location_y FROM alerts
WHERE location_x >= -70.8::DOUBLE AND location_x <= -70.5::DOUBLE
  AND location_y >= -33.5::DOUBLE AND location_y <= -33.3::DOUBLE""", "alerts")
ORACLE["bbox_clustered"] = ORACLE["bbox_filter"]
sql("digit_guard", r"""
SELECT seq, CAST(uuid AS BIGINT) AS clave FROM requests WHERE regexp_full_match(uuid, '[0-9]+')""", "requests")

# -- first per key, funnel, duplicate reports -----------------------------------------------

sql("dedup_alerts", "SELECT * FROM alerts", "alerts")
sql("dedup_jams", "SELECT * FROM jams", "jams")
sql("clean_funnel", """
SELECT 'alerta' AS kind, (SELECT count(*) FROM staged_alerts) AS total,
       (SELECT count(*) FROM whole_alerts) AS complete, (SELECT count(*) FROM alerts) AS distinct_keys
UNION ALL
SELECT 'atasco', (SELECT count(*) FROM staged_jams), (SELECT count(*) FROM whole_jams), (SELECT count(*) FROM jams)""",
    "alerts jams")

cte("accounting", """
  SELECT file, kind, count(*) AS found, count(*) FILTER (rn = 1) AS inserted,
         count(*) - count(*) FILTER (rn = 1) AS duplicates
  FROM (SELECT *, row_number() OVER (PARTITION BY kind, uuid ORDER BY event_id) AS rn FROM feed_rows)
  GROUP BY file, kind""", "feed_rows")
sql("ingest_accounting", "SELECT * FROM accounting", "accounting")
sql("ingest_totals", """
SELECT count(DISTINCT file) AS files, CAST(sum(found) AS BIGINT) AS found,
       CAST(sum(inserted) AS BIGINT) AS inserted, CAST(sum(duplicates) AS BIGINT) AS duplicates
FROM accounting""", "accounting")
sql("dup_by_file", "SELECT file, uuid, n, kind FROM keys_by_file WHERE n > 1", "keys_by_file")

cte("file_summary", """
  SELECT file, CAST(sum(n) AS BIGINT) AS objects, CAST(sum(alerts) AS BIGINT) AS alerts,
         CAST(sum(jams) AS BIGINT) AS jams, count(*) AS unique_keys,
         count(*) FILTER (n > 1) AS duplicated,
         count(*) FILTER (n > 1 AND kind = 'alerta') AS dup_alerta,
         count(*) FILTER (n > 1 AND kind = 'atasco') AS dup_atasco,
         count(*) FILTER (n > 1 AND kind = 'mixto') AS dup_mixto,
         count(*) FILTER (n > 1 AND kind = 'desconocido') AS dup_desconocido,
         CAST(100 AS DOUBLE) * count(*) FILTER (n > 1) / count(*) AS dup_percent
  FROM keys_by_file GROUP BY file""", "keys_by_file")
sql("dup_file_summary", "SELECT * FROM file_summary", "file_summary")
sql("dup_global_summary", """
SELECT count(*) AS files, count(*) FILTER (duplicated > 0) AS files_with_duplicates,
       CAST(sum(duplicated) AS BIGINT) AS duplicated FROM file_summary""", "file_summary")
cte("flat_keys_by_file", """
SELECT file, uuid, count(*) AS n, count(*) FILTER (kind = 'alerta') AS alerts,
       count(*) FILTER (kind = 'atasco') AS jams,
       CASE WHEN bool_or(kind <> 'desconocido' AND kind <> first_kind) THEN 'mixto' ELSE min(first_kind) END AS kind
FROM (SELECT *, first_value(kind) OVER (PARTITION BY file, uuid ORDER BY pos) AS first_kind FROM flat_rows)
GROUP BY file, uuid""", "flat_rows")
sql("flat_kind_merge", "SELECT * FROM flat_keys_by_file", "flat_keys_by_file")
sql("dup_mixed_shapes", """
SELECT * FROM flat_keys_by_file UNION ALL SELECT file, uuid, n, alerts, jams, kind FROM keys_by_file""",
    "flat_keys_by_file keys_by_file")
sql("flat_feed_in_ranges", """
SELECT printf('flat_%09d.json', id // 4096) AS file, id % 4096 AS pos, uuid, kind
FROM (SELECT *, CAST(file[6:14] AS BIGINT) * 64 + pos AS id FROM flat_rows)""", "flat_rows")
cte("run_keys", """
  SELECT file[6:13] AS run, uuid, count(*) AS n, count(*) FILTER (kind = 'alerta') AS alerts,
         count(*) FILTER (kind = 'atasco') AS jams
  FROM feed_rows WHERE uuid IS NOT NULL GROUP BY ALL""", "feed_rows")
sql("run_key_sketches", """
SELECT run, CAST(sum(n) AS BIGINT) AS objects, count(*) AS distinct_keys, count(*) FILTER (n > 1) AS repeated_keys,
       count(*) FILTER (alerts > 0 AND jams > 0) AS mixed_keys,
       count(*) FILTER (EXISTS (SELECT 1 FROM run_keys b WHERE b.uuid = a.uuid AND b.run = (
         SELECT max(c.run) FROM run_keys c WHERE c.run < a.run))) AS kept_keys
FROM run_keys a GROUP BY run""", "run_keys")
sql("repeated_keys", "SELECT uuid, count(*) AS n FROM feed_rows GROUP BY uuid HAVING count(*) > 1", "feed_rows")
sql("repeated_alerts", """
SELECT uuid, count(*) AS n FROM reports WHERE uuid IS NOT NULL GROUP BY uuid HAVING count(*) > 1""", "reports")
sql("repeated_instances", """
SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY uuid) AS n,
                      row_number() OVER (PARTITION BY uuid ORDER BY file, pos) AS instance
               FROM reports WHERE uuid IS NOT NULL) WHERE n > 1""", "reports")
sql("key_counts", """
SELECT CAST(sum(n) AS BIGINT) AS total, count(*) AS distinct_keys, count(*) FILTER (n > 1) AS repeated_keys
FROM (SELECT uuid, count(*) AS n FROM reports WHERE uuid IS NOT NULL GROUP BY uuid)""", "reports")
sql("mixed_keys", """
SELECT DISTINCT uuid FROM feed_rows WHERE kind = 'alerta' AND uuid IN (SELECT uuid FROM feed_rows WHERE kind = 'atasco')""",
    "feed_rows")

# -- counts, totals, rankings, top-k --------------------------------------------------------

sql("count_alerts", "SELECT count(*) AS count FROM alerts", "alerts")
sql("count_jams", "SELECT count(*) AS count FROM jams", "jams")
sql("count_accidents", "SELECT count(*) AS count FROM alerts WHERE type = 'ACCIDENT'", "alerts")
sql("alert_cube", """
SELECT substr(fecha, 12, 2) AS hora, city, type, street, count(*) AS n FROM alerts
GROUP BY ALL""", "alerts")

HOURS = "SELECT substr(fecha, 12, 2) AS hora, count(*) AS cantidad_alertas FROM alerts GROUP BY 1"
CITIES = "SELECT city AS comuna, count(*) AS cantidad_alertas FROM alerts GROUP BY 1"
TYPES = "SELECT type AS tipo_alerta, count(*) AS cantidad FROM alerts GROUP BY 1"
STREETS = "SELECT street AS calle, count(*) AS cantidad_alertas FROM alerts GROUP BY 1"
CITY_ACCIDENTS = """
SELECT city AS comuna, count(*) AS cantidad_accidentes FROM alerts WHERE type = 'ACCIDENT' GROUP BY 1"""
STREET_ACCIDENTS = """
SELECT street AS calle, city AS ciudad, count(*) AS cantidad_accidentes FROM alerts
WHERE type = 'ACCIDENT' GROUP BY 1, 2"""
CITY_JAMS = """
SELECT city AS ciudad, CAST(sum(length) AS BIGINT) AS largo_total, count(*) AS num_atascos FROM jams GROUP BY 1"""

sql("peak_hours", HOURS, "alerts")
sql("alerts_by_city", CITIES, "alerts")
sql("alerts_by_type", TYPES, "alerts")
sql("type_frequency", TYPES, "alerts")
sql("alerts_by_street", STREETS, "alerts")
sql("accidents_by_city", CITY_ACCIDENTS, "alerts")
sql("accidents_by_street_city", STREET_ACCIDENTS, "alerts")
sql("jams_by_city", CITY_JAMS, "jams")
sql("longest_jams", "SELECT * FROM jams", "jams")
sql("sample_alerts", "SELECT * FROM alerts ORDER BY uuid LIMIT 10", "alerts")
sql("sample_jams", "SELECT * FROM jams ORDER BY uuid LIMIT 10", "jams")
sql("top10_accident_streets", STREET_ACCIDENTS + " ORDER BY 3 DESC, 1, 2 LIMIT 10", "alerts")
sql("top10_alert_streets", STREETS + " ORDER BY 2 DESC, 1 LIMIT 10", "alerts")
sql("top5_accident_cities", CITY_ACCIDENTS + " ORDER BY 2 DESC, 1 LIMIT 5", "alerts")
sql("top10_alert_cities", CITIES + " ORDER BY 2 DESC, 1 LIMIT 10", "alerts")
sql("hour_distribution", f"""
SELECT hora, cantidad_alertas, coalesce(hora, 'Sin hora') AS hora_etiqueta,
       coalesce(TRY_CAST(hora AS INTEGER), -1) AS hora_num FROM ({HOURS})""", "alerts")
sql("top10_jam_length", CITY_JAMS + " ORDER BY 2 DESC, 1 LIMIT 10", "jams")
sql("top10_jam_count", CITY_JAMS + " ORDER BY 3 DESC, 1 LIMIT 10", "jams")

# -- keyed sinks and documents --------------------------------------------------------------

cte("loads", """
  SELECT uuid, type, street, fecha, seq,
         CASE WHEN type IN ('JAM', 'HAZARD', 'ACCIDENT') THEN 0 ELSE 1 END AS load
  FROM alert_docs""", "alert_docs")
sql("insert_if_absent", """
SELECT uuid, type, street, fecha, seq
FROM (SELECT *, row_number() OVER (PARTITION BY uuid ORDER BY load, seq) AS rn FROM loads) WHERE rn = 1""", "loads")
sql("keyed_upsert", """
SELECT uuid, type, street, fecha, seq
FROM (SELECT *, row_number() OVER (PARTITION BY uuid ORDER BY load DESC, seq DESC) AS rn FROM loads) WHERE rn = 1""",
    "loads")
JAM_FIELDS = "severity country length endnode roadtype speed street fecha region city".split()
ALERT_FIELDS = "uuid city municipalityUser type street confidence location_x location_y fecha".split()


def json_of(fields: list[str], more: str = "") -> str:
    named = ", ".join(f"'{f}': \"{f}\"" for f in fields)
    return f"CAST(to_json({{{named}{more}}}) AS VARCHAR)"


sql("collection_documents", f"""
SELECT 'atascos' AS _index, uuid AS _id, {json_of(JAM_FIELDS)} AS _source FROM staged_jams""", "staged_jams")
sql("doc_json", f"SELECT seq, {json_of(ALERT_FIELDS)} AS doc FROM staged_alerts", "staged_alerts")

RESULTS = {     # name: (rows, order, columns)
    "horas_pico": (HOURS, "cantidad_alertas DESC, hora", ["hora", "cantidad_alertas"]),
    "comunas_con_mas_alertas": (CITIES, "cantidad_alertas DESC, comuna", ["comuna", "cantidad_alertas"]),
    "tipos_alerta_frecuencia": (TYPES, "cantidad DESC, tipo_alerta", ["tipo_alerta", "cantidad"]),
    "alertas_tipo_false": ("SELECT * FROM staged_alerts WHERE type = 'false'", "uuid, fecha", ALERT_FIELDS),
    "comunas_con_mas_accidentes": (CITY_ACCIDENTS, "cantidad_accidentes DESC, comuna", ["comuna", "cantidad_accidentes"]),
    "calles_con_mas_alertas": (STREETS, "cantidad_alertas DESC, calle", ["calle", "cantidad_alertas"]),
    "calles_con_mas_accidentes": (STREET_ACCIDENTS, "cantidad_accidentes DESC, calle, ciudad",
                                  ["calle", "ciudad", "cantidad_accidentes"]),
    "atascos_largos": ("SELECT * FROM jams", "length DESC, uuid", ["uuid", *JAM_FIELDS]),
    "atascos_por_ciudad": (CITY_JAMS, "largo_total DESC, ciudad", ["ciudad", "largo_total", "num_atascos"]),
}


def documents_of(name: str) -> str:
    rows, order, columns = RESULTS[name]
    lineage = f", 'archivo_origen': '{name}', 'fecha_procesamiento': '2024-01-31T00:00:00', 'fila_numero': rn"
    return f"""
SELECT 'analisis_{name}' AS _index, '{name}_' || CAST(rn - 1 AS VARCHAR) AS _id, {json_of(columns, lineage)} AS _source
FROM (SELECT *, row_number() OVER (ORDER BY {order}) AS rn FROM ({rows}))"""


sql("result_documents", " UNION ALL ".join(documents_of(name) for name in RESULTS), "alerts jams staged_alerts")
# Three loads into the collection: a key's first document stays, and places count in the order of storing.
ORACLE["refreshed_results"] = ORACLE["result_documents"].replace("alert_docs AS (", "incoming AS (", 1).replace(
    "staged_alerts AS (", """alert_docs AS (
  SELECT * EXCLUDE (seq, load, rn), row_number() OVER (ORDER BY load, seq) - 1 AS seq
  FROM (SELECT *, row_number() OVER (PARTITION BY uuid ORDER BY load, seq) AS rn
        FROM (SELECT *, CASE WHEN type IN ('JAM', 'HAZARD', 'ACCIDENT') THEN 2 WHEN type = 'POLICE' THEN 0 ELSE 1 END AS load
              FROM incoming)) WHERE rn = 1),
staged_alerts AS (""", 1).replace("staged_jams AS (", "incoming_jams AS (", 1).replace("whole_jams AS (", """staged_jams AS (
  SELECT * EXCLUDE (rn)
  FROM (SELECT *, row_number() OVER (PARTITION BY uuid ORDER BY severity % 3, fecha, severity, country,
               length NULLS FIRST, endnode, roadtype, street) AS rn FROM incoming_jams)
  WHERE rn = 1),
whole_jams AS (""", 1)
ORACLE["inserted_in_batches"] = ORACLE["insert_if_absent"]
sql("indexed_in_batches", f"""
SELECT 'alertas' AS _index, uuid AS _id, {json_of(["type", "seq"])} AS _source
FROM (SELECT *, row_number() OVER (PARTITION BY uuid ORDER BY load DESC, seq DESC) AS rn FROM loads)
WHERE rn = 1 AND uuid IS NOT NULL""", "loads")
sql("index_counts", f"""
SELECT 'analisis_horas_pico' AS _index, (SELECT count(*) FROM ({HOURS})) AS documents
UNION ALL SELECT 'analisis_comunas_con_mas_alertas', (SELECT count(*) FROM ({CITIES}))
UNION ALL SELECT 'analisis_tipos_alerta_frecuencia', (SELECT count(*) FROM ({TYPES}))
UNION ALL SELECT 'analisis_alertas_tipo_false', (SELECT count(*) FROM staged_alerts WHERE type = 'false')
UNION ALL SELECT 'analisis_comunas_con_mas_accidentes', (SELECT count(*) FROM ({CITY_ACCIDENTS}))
UNION ALL SELECT 'analisis_calles_con_mas_alertas', (SELECT count(*) FROM ({STREETS}))
UNION ALL SELECT 'analisis_calles_con_mas_accidentes', (SELECT count(*) FROM ({STREET_ACCIDENTS}))
UNION ALL SELECT 'analisis_atascos_largos', (SELECT count(*) FROM jams)
UNION ALL SELECT 'analisis_atascos_por_ciudad', (SELECT count(*) FROM ({CITY_JAMS}))""", "alerts jams")

# -- lookups --------------------------------------------------------------------------------

sql("tagged_ids", "SELECT * FROM ids", "ids")
sql("lookup_alerts", """
SELECT r.*, a.city, a.type, a.fecha, CASE WHEN a.uuid IS NULL THEN 'no_encontrado' ELSE 'encontrado' END AS estado
FROM requests r LEFT JOIN alerts a ON r.uuid = a.uuid WHERE r.tipo = 'alerta'""", "requests alerts")
sql("lookup_jams", """
SELECT r.*, j.city, j.length, CASE WHEN j.uuid IS NULL THEN 'no_encontrado' ELSE 'encontrado' END AS estado
FROM requests r LEFT JOIN jams j ON TRY_CAST(r.uuid AS BIGINT) = CAST(j.uuid AS BIGINT) WHERE r.tipo = 'atasco'""",
    "requests jams")
cte("found", """
  SELECT r.*, CASE WHEN i.uuid IS NULL THEN 'no_encontrado' ELSE 'encontrado' END AS estado
  FROM requests r LEFT JOIN ids i ON r.tipo = i.tipo AND r.uuid = i.uuid""", "requests ids")
sql("tagged_lookup", "SELECT * FROM found", "found")

cte("log", """
  SELECT segundo, CASE WHEN is_alert THEN 'alerta' ELSE 'atasco' END AS tipo,
         CASE WHEN k % 10 = 0 THEN 'no_encontrado' WHEN k % 3 = 0 THEN 'hit' ELSE 'miss' END AS resultado,
         CAST(CASE WHEN k % 10 <> 0 THEN value END AS DECIMAL(18, 2)) AS ms
  FROM ev""", "ev")
sql("request_summary", """
SELECT *, CAST(100 AS DOUBLE) * cache_hits / total_requests AS hit_rate, hit_ms / cache_hits AS hit_ms_mean,
       miss_ms / cache_misses AS miss_ms_mean,
       CAST(total_requests AS DOUBLE) / elapsed_seconds AS requests_per_second
FROM (SELECT coalesce(tipo, 'todos') AS tipo, count(*) AS total_requests,
             count(*) FILTER (resultado = 'hit') AS cache_hits, count(*) FILTER (resultado = 'miss') AS cache_misses,
             count(*) FILTER (resultado = 'no_encontrado') AS not_found,
             CAST(sum(ms) FILTER (resultado = 'hit') AS DOUBLE) AS hit_ms,
             CAST(sum(ms) FILTER (resultado = 'miss') AS DOUBLE) AS miss_ms,
             max(segundo) - min(segundo) AS elapsed_seconds
      FROM log GROUP BY GROUPING SETS ((), (tipo)))""", "log")

sql("latency_sketches", """
SELECT resultado, count(*) AS n, true AS p50_near, true AS p90_near, true AS p99_near
FROM log WHERE ms IS NOT NULL GROUP BY resultado""", "log")
sql("latency_percentiles", """
SELECT resultado, count(*) AS n, CAST(min(ms) FILTER (r * 100 >= total * 50) AS DOUBLE) AS p50,
       CAST(min(ms) FILTER (r * 100 >= total * 90) AS DOUBLE) AS p90,
       CAST(min(ms) FILTER (r * 100 >= total * 99) AS DOUBLE) AS p99
FROM (SELECT resultado, ms, row_number() OVER (PARTITION BY resultado ORDER BY ms) AS r,
             count(*) OVER (PARTITION BY resultado) AS total FROM log WHERE ms IS NOT NULL)
GROUP BY resultado""", "log")


def ttl_sql(keys: str, source: str) -> tuple[str, str]:
    """(needs-free CTE text, body) that follows each key from fill to fill."""
    names = keys.split(", ")
    same = " AND ".join(f"f.{k} = m.{k}" for k in names)
    own = ", ".join(f"m.{k}" for k in names)
    return (f"""moments AS (
  SELECT {keys}, segundo, min(segundo) OVER (PARTITION BY {keys} ORDER BY segundo
         RANGE BETWEEN 300 FOLLOWING AND UNBOUNDED FOLLOWING) AS following
  FROM (SELECT DISTINCT {keys}, segundo FROM {source})),
fills AS (
  SELECT {keys}, min(segundo) AS segundo FROM moments GROUP BY {keys}
  UNION ALL
  SELECT {own}, m.following AS segundo FROM fills f JOIN moments m ON {same} AND f.segundo = m.segundo
  WHERE m.following IS NOT NULL)""", f"SELECT {keys}, segundo FROM fills")


_chain, _body = ttl_sql("user_id", "ev")
sql("ttl_first_seen", _body, "ev", _chain)
_chain, _body = ttl_sql("event_type", "ev")
sql("ttl_first_seen_by_type", _body, "ev", _chain)
_chain, _ = ttl_sql("tipo, uuid", "found")
sql("request_outcomes", """
SELECT r.seq, r.segundo, r.tipo, r.uuid,
       CASE WHEN r.estado = 'no_encontrado' THEN 'no_encontrado'
            WHEN f.segundo IS NOT NULL AND r.first_seq = r.seq THEN 'miss' ELSE 'hit' END AS resultado
FROM (SELECT *, min(seq) OVER (PARTITION BY tipo, uuid, segundo) AS first_seq FROM found) r
     LEFT JOIN fills f ON r.tipo = f.tipo AND r.uuid = f.uuid AND r.segundo = f.segundo""", "found", _chain)

# -- grid -----------------------------------------------------------------------------------

cte("celled", """
  SELECT uuid, location_x, location_y,
         CASE WHEN r BETWEEN 0 AND 3 AND c BETWEEN 0 AND 7 THEN CAST(r * 8 + c AS INTEGER) END AS indice_celda
  FROM (SELECT *, floor((CAST(-33.2 AS DOUBLE) - location_y) / CAST(0.1267 AS DOUBLE)) AS r,
               floor((location_x - CAST(-71.0 AS DOUBLE)) / CAST(0.0667 AS DOUBLE)) AS c FROM alerts)""", "alerts")
sql("assign_cell", "SELECT * FROM celled", "celled")
sql("counts_by_cell", "SELECT indice_celda, count(*) AS cantidad FROM celled GROUP BY 1", "celled")
sql("grid_cells", """
SELECT CAST(i AS INTEGER) AS indice_celda,
       CAST(-33.2 AS DOUBLE) - (i // 8) * CAST(0.1267 AS DOUBLE) AS top,
       CAST(-33.2 AS DOUBLE) - (i // 8) * CAST(0.1267 AS DOUBLE) - CAST(0.1267 AS DOUBLE) AS bottom,
       CAST(-71.0 AS DOUBLE) + (i % 8) * CAST(0.0667 AS DOUBLE) AS "left",
       CAST(-71.0 AS DOUBLE) + (i % 8) * CAST(0.0667 AS DOUBLE) + CAST(0.0667 AS DOUBLE) AS "right",
       'Celda ' || CAST(i + 1 AS VARCHAR) AS zona_aproximada, CAST(i // 8 + 1 AS INTEGER) AS fila,
       CAST(i % 8 + 1 AS INTEGER) AS columna, CAST(32 AS INTEGER) AS total_celdas, '8x4' AS grid_size,
       (SELECT count(*) FROM celled WHERE indice_celda = i) AS cantidad
FROM range(32) t(i)""", "celled")
sql("feed_cell_counts", """
SELECT c.cell AS indice_celda, (SELECT count(DISTINCT file) FROM feed_rows) AS consultas,
       count(*) FILTER (is_alert) AS alertas, count(*) FILTER (NOT is_alert) AS atascos
FROM feed_rows c GROUP BY c.cell""", "feed_rows")

# -- sampling: the same md5-based draws -------------------------------------------------------


def uniform(text: str, start: int) -> str:
    return f"((CAST(('0x' || substr(md5({text}), {start}, 13)) AS UBIGINT) + CAST(0.5 AS DOUBLE)) / CAST(4503599627370496 AS DOUBLE))"


cte("shuffled", """
  SELECT tipo, uuid, row_number() OVER (ORDER BY md5('shuffle:' || tipo || ':' || uuid), tipo, uuid) - 1 AS indice
  FROM ids""", "ids")
cte("listed", "SELECT tipo, uuid, row_number() OVER (ORDER BY tipo, uuid) - 1 AS indice FROM ids", "ids")
sql("shuffled_ids", "SELECT * FROM shuffled", "shuffled")

_u1 = uniform("'normal:' || CAST(event_id AS VARCHAR)", 1)
_u2 = uniform("'normal:' || CAST(event_id AS VARCHAR)", 14)
sql("sample_normal", f"""
SELECT d.draw, s.* FROM (
  SELECT event_id AS draw, CAST(least(greatest(round_even(
           n / 2 + n / 3 * sqrt(-2 * ln({_u1})) * cos(2 * pi() * {_u2}), 0), 0), n - 1) AS BIGINT) AS indice
  FROM events, (SELECT CAST(count(*) AS DOUBLE) AS n FROM ids)) d JOIN shuffled s ON d.indice = s.indice""",
    "ids shuffled")

_t = "'zipf:' || CAST(event_id AS VARCHAR) || ':' || CAST(a AS VARCHAR)"
sql("sample_zipf", f"""
SELECT z.draw, s.tipo, s.uuid, s.indice
FROM (SELECT draw, (CAST(x AS HUGEINT) - 1) % (SELECT count(*) FROM ids) AS indice
      FROM (SELECT draw, x, row_number() OVER (PARTITION BY draw ORDER BY a) AS rn
            FROM (SELECT event_id AS draw, a, floor(pow({uniform(_t, 1)}, CAST(-1 / (1.3::DOUBLE - 1) AS DOUBLE))) AS x,
                         {uniform(_t, 14)} AS v
                  FROM events, range(32) t(a))
            WHERE x <= CAST(4611686018427387904 AS DOUBLE)
              AND v * x * (pow(1 + 1 / x, 1.3::DOUBLE - 1) - 1) / (pow(2::DOUBLE, 1.3::DOUBLE - 1) - 1)
                  <= pow(1 + 1 / x, 1.3::DOUBLE - 1) / pow(2::DOUBLE, 1.3::DOUBLE - 1))
      WHERE rn = 1) z JOIN listed s ON z.indice = s.indice""", "listed")

sql("arrival_times", f"""
SELECT draw, gap_us, CAST(sum(gap_us) OVER (ORDER BY draw) AS BIGINT) AS arrival_us
FROM (SELECT event_id AS draw, CASE WHEN event_id = 0 THEN 0 ELSE CAST(round_even(
        -ln({uniform("'arrival:' || CAST(event_id AS VARCHAR)", 1)}) / 0.5::DOUBLE * 1000000, 0) AS BIGINT) END AS gap_us
      FROM events)""")
