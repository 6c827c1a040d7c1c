"""The queries in DuckDB's SQL, written independently of the Spark operators."""

from __future__ import annotations

CHOSEN_CITY = "Click (Zone 3)"
CHOSEN_POLLUTANT = "no2"
CHOSEN_CATEGORIES = ["Moderate", "Unhealthy"]

_READINGS = """readings AS (
SELECT event_id AS reading_id,
 CASE WHEN user_id % 40 = 39 THEN NULL
      ELSE concat(repeat(' ', CAST(user_id % 3 AS INT)),
                  CASE WHEN event_id % 2 = 0 THEN upper(event_type) ELSE event_type END,
                  ' (zone?? ', CAST(user_id % 8 AS STRING), ') ') END AS city,
 CASE WHEN user_id % 25 = 0 THEN NULL ELSE concat(' station  ', CAST(user_id AS STRING)) END AS station,
 CASE WHEN event_id % 17 = 0 THEN '-' ELSE CAST(value AS STRING) END AS aqi,
 CASE WHEN event_id % 5 = 0 THEN NULL ELSE value END AS pm25,
 CASE WHEN event_id % 3 = 0 THEN NULL ELSE value * 0.5 END AS pm10,
 CASE WHEN event_id % 4 = 0 THEN NULL ELSE value * 0.25 END AS o3,
 value * 0.125 AS no2,
 CASE WHEN event_id % 7 = 0 THEN value * 0.0625 ELSE NULL END AS co,
 CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 2 = 0 THEN 'pm25' ELSE 'o3' END AS dominant_pollutant,
 date_trunc('hour', ts) AS recorded_at,
 ts AS fetched_at
FROM events)"""

_AQI = "CAST(trunc(TRY_CAST(aqi AS DOUBLE)) AS INTEGER)"
_BAND = """CASE WHEN aqi <= 50 THEN 'Good' WHEN aqi <= 100 THEN 'Moderate'
 WHEN aqi <= 150 THEN 'Unhealthy for Sensitive Groups' WHEN aqi <= 200 THEN 'Unhealthy'
 WHEN aqi <= 300 THEN 'Very Unhealthy' ELSE 'Hazardous' END"""

_TYPED = f"""typed AS (
SELECT reading_id, city, station, aqi, pm25, pm10, o3, no2, co, {_BAND} AS aqi_category,
 dominant_pollutant, recorded_at, fetched_at
FROM (SELECT reading_id, lower(trim(city)) AS city, trim(station) AS station, {_AQI} AS aqi,
 CAST(pm25 AS FLOAT) AS pm25, CAST(pm10 AS FLOAT) AS pm10, CAST(o3 AS FLOAT) AS o3,
 CAST(no2 AS FLOAT) AS no2, CAST(co AS FLOAT) AS co, dominant_pollutant, recorded_at, fetched_at
 FROM readings))"""

_COLUMNS = ("city, station, aqi, pm25, pm10, o3, no2, co, aqi_category, dominant_pollutant, "
            "recorded_at, fetched_at")
_CLEAN_COLUMNS = _COLUMNS.removesuffix(", fetched_at")

_FACT = f"""fact AS (
SELECT {_COLUMNS} FROM (
 SELECT *, row_number() OVER (PARTITION BY city, recorded_at ORDER BY reading_id) AS rn
 FROM typed WHERE aqi IS NOT NULL) WHERE rn = 1)"""

_STORED = f"""stored AS (
SELECT {_COLUMNS} FROM (
 SELECT *, row_number() OVER (PARTITION BY city, recorded_at ORDER BY reading_id) AS rn
 FROM typed WHERE aqi IS NOT NULL
 AND fetched_at < (SELECT max(fetched_at) - INTERVAL 10 DAY FROM readings)) WHERE rn = 1)"""


def _display(value: str) -> str:
    tidy = f"trim(replace(replace({value}, '??', ''), '  ', ' '))"
    words = f"regexp_extract_all(lower({tidy}), '([\\p{{Lu}}\\p{{Ll}}\\p{{Lt}}]+|[^\\p{{Lu}}\\p{{Ll}}\\p{{Lt}}]+)')"
    title = f"array_to_string(list_transform({words}, lambda w: concat(upper(w[1]), w[2:])), '')"
    return f"coalesce(nullif({title}, ''), 'Unknown')"


_PREPARED = f"""prepared AS (
SELECT {_display('city')} AS city,
 {_display('coalesce(station, ' + _display('city') + ')')} AS station,
 aqi, CAST(pm25 AS DOUBLE) AS pm25, CAST(pm10 AS DOUBLE) AS pm10, CAST(o3 AS DOUBLE) AS o3,
 CAST(no2 AS DOUBLE) AS no2, CAST(co AS DOUBLE) AS co,
 coalesce(aqi_category, 'Unknown') AS aqi_category, dominant_pollutant, recorded_at, fetched_at
FROM fact)"""

_LATEST = f"""latest AS (
SELECT {_COLUMNS} FROM (
 SELECT *, row_number() OVER (PARTITION BY city ORDER BY fetched_at DESC NULLS FIRST) AS rn
 FROM prepared) WHERE rn = 1)"""

_WORST = "worst AS (SELECT * FROM latest ORDER BY aqi DESC NULLS LAST, city LIMIT 1)"

_CATEGORIES = """categories AS (SELECT * FROM (VALUES
 ('Good', 0, 50, '#00a65a'), ('Moderate', 51, 100, '#f39c12'),
 ('Unhealthy for Sensitive Groups', 101, 150, '#f09300'), ('Unhealthy', 151, 200, '#dd4b39'),
 ('Very Unhealthy', 201, 300, '#8e44ad'), ('Hazardous', 301, 500, '#7f1d1d'))
 AS t(category, low, high, color))"""

_POLLUTANTS = """pollutants AS (SELECT * FROM (VALUES
 ('pm25', 'Particulate Matter 2.5', 'µg/m³'), ('pm10', 'Particulate Matter 10', 'µg/m³'),
 ('o3', 'Ozone', 'ppb'), ('no2', 'Nitrogen Dioxide', 'ppb'), ('co', 'Carbon Monoxide', 'ppm'))
 AS t(pollutant, name, unit))"""

_LONG = """long AS (
SELECT v.city, v.fetched_at, v.pollutant, v.value, d.name, d.unit FROM (
 SELECT city, fetched_at, 'pm25' AS pollutant, pm25 AS value FROM {source}
 UNION ALL SELECT city, fetched_at, 'pm10', pm10 FROM {source}
 UNION ALL SELECT city, fetched_at, 'o3', o3 FROM {source}
 UNION ALL SELECT city, fetched_at, 'no2', no2 FROM {source}
 UNION ALL SELECT city, fetched_at, 'co', co FROM {source}) v
JOIN pollutants d ON d.pollutant = v.pollutant WHERE v.value IS NOT NULL)"""

_ISO = "strftime(recorded_at, '%Y-%m-%dT%H:%M:%S+00:00')"

_RESPONSES = f"""responses AS (
SELECT station AS feed, CASE WHEN failed THEN 'error' ELSE 'ok' END AS status,
 CASE WHEN NOT failed THEN aqi END AS aqi, CASE WHEN NOT failed THEN city END AS city_name,
 CASE WHEN NOT failed THEN pm25 END AS pm25, CASE WHEN NOT failed THEN pm10 END AS pm10,
 CASE WHEN NOT failed THEN o3 END AS o3, CASE WHEN NOT failed THEN no2 END AS no2,
 CASE WHEN NOT failed THEN co END AS co, CASE WHEN NOT failed THEN dominant_pollutant END AS dominentpol,
 CASE WHEN NOT failed THEN {_ISO} END AS iso
FROM (SELECT *, reading_id % 13 = 0 AS failed FROM readings))"""

_TREND = """trend AS (
SELECT records, current_avg, CASE WHEN records > 10 THEN older_avg ELSE current_avg END AS previous_avg
FROM (SELECT count(*) AS records, avg(aqi) AS current_avg,
 avg(aqi) FILTER (WHERE fetched_at < (SELECT max(fetched_at) FROM prepared) - INTERVAL 1 HOUR) AS older_avg
 FROM prepared)), trend_pct AS (
SELECT *, CASE WHEN previous_avg > 0 THEN (current_avg - previous_avg) / previous_avg * 100 ELSE 0.0::DOUBLE END
 AS trend_pct FROM trend)"""

_LOG = """log AS (
SELECT fetched_at AS "Ingestion Timestamp", recorded_at AS "Measurement Timestamp", city AS "Location",
 station AS "Station ID", aqi AS "AQI", aqi_category AS "Classification",
 CAST(CAST(CAST(pm25 AS FLOAT) AS VARCHAR) AS DOUBLE) AS "PM2.5 (µg/m³)",
 dominant_pollutant AS "Primary Pollutant"
FROM prepared ORDER BY fetched_at DESC NULLS LAST LIMIT 100)"""

_KNOWN = ("EXISTS (SELECT 1 FROM stored s WHERE s.city IS NOT DISTINCT FROM f.city "
          "AND s.recorded_at IS NOT DISTINCT FROM f.recorded_at)")

_CLEANING = (_READINGS, _TYPED)
_STORING = (*_CLEANING, _FACT)
_UPSERT = (*_STORING, _STORED)
_PREPARING = (*_STORING, _PREPARED)
_MONITORING = (*_PREPARING, _LATEST, _WORST)


def _sql(parts, select: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n" + select


def _text(column: str) -> str:
    return f"CAST(CAST({column} AS DOUBLE) AS VARCHAR) AS {column}"


#: Queries that reach another one's result by another way.
SAME = {
    "overview_from_partials": "overview", "distribution_from_partials": "category_distribution",
    "latest_from_partials": "latest_by_city", "hourly_from_partials": "hourly_avg",
}


def oracle_queries() -> dict[str, str]:
    queries = _oracle_queries()
    # Of the two loads: an earlier reading of a key stays.
    loaded = f"""fact AS (SELECT {_COLUMNS} FROM stored UNION ALL SELECT {_COLUMNS} FROM once f WHERE NOT {_KNOWN})"""
    for name, other in {**SAME, "recent_from_partials": "recent_readings"}.items():
        queries[name] = queries[other].replace(_FACT, _FACT.replace("fact AS (", "once AS (", 1) + ",\n" + _STORED + ",\n" + loaded)
    return queries


def _oracle_queries() -> dict[str, str]:
    raw, typed = (_READINGS,), _CLEANING
    replies = (_READINGS, _RESPONSES)
    categories = ", ".join(f"'{c}'" for c in CHOSEN_CATEGORIES)
    return {
        "ingest_responses": _sql(replies, "SELECT * FROM responses"),
        "ingest_ok": _sql(replies, "SELECT * FROM responses WHERE status = 'ok'"),
        "ingest_rejected": _sql(replies, "SELECT feed, status FROM responses WHERE status <> 'ok'"),
        "ingest_flatten": _sql(replies, """SELECT coalesce(city_name, feed) AS city,
 coalesce(city_name, feed) AS station, aqi, pm25, pm10, o3, no2, co, dominentpol AS dominant_pollutant,
 iso AS recorded_at FROM responses WHERE status = 'ok'"""),
        "feed_list": _sql(raw, """, settings AS (SELECT reading_id,
 CASE WHEN reading_id % 9 = 0 THEN '@1451'
 ELSE concat(' @', reading_id, ' ,, ', coalesce(station, ''), ' ,') END AS feeds FROM readings),
tokens AS (SELECT reading_id,
 list_filter(list_transform(string_split(feeds, ','), lambda t: trim(t)), lambda t: t <> '') AS list
 FROM settings)
SELECT reading_id, CAST(i AS INTEGER) AS position, list[i + 1] AS feed
FROM (SELECT reading_id, list, unnest(range(len(list))) AS i FROM tokens)"""),
        "scan_raw": _sql(raw, f"""SELECT city, station, aqi, pm25, pm10, o3, no2, co, dominant_pollutant,
 {_ISO} AS recorded_at FROM readings"""),
        "scan_clean": _sql(_STORING, f"SELECT {_CLEAN_COLUMNS} FROM fact"),
        "append_twice": _sql(_UPSERT, f"""SELECT {_COLUMNS} FROM stored
UNION ALL SELECT {_COLUMNS} FROM fact f WHERE NOT {_KNOWN}"""),
        "stream_ingest": _sql(_STORING, "SELECT city, recorded_at FROM fact"),
        "overview_from_stream": _sql(_PREPARING, "SELECT count(*) AS records, count(DISTINCT city) AS cities FROM prepared"),
        "stream_rejected": _sql(replies, "SELECT feed, status FROM responses WHERE status <> 'ok'"),
        "stream_hourly": _sql(_CLEANING, f"""SELECT city, hour, count(*) AS readings, sum(aqi) / count(*) AS avg_aqi
FROM (SELECT {_display('city')} AS city, date_trunc('hour', recorded_at) AS hour, aqi FROM typed WHERE aqi IS NOT NULL)
WHERE hour + INTERVAL 3 HOUR <= (SELECT max(recorded_at) FROM typed WHERE aqi IS NOT NULL) GROUP BY city, hour"""),
        "coverage_from_sketches": _sql((*_STORING, _STORED, """loaded AS (SELECT * FROM stored UNION ALL SELECT * FROM fact f
 WHERE NOT """ + _KNOWN + ")"), f"""SELECT strftime(recorded_at, '%Y-%m') AS month, count(DISTINCT city) AS cities,
 count(DISTINCT station) AS stations, TRUE AS cities_close, TRUE AS stations_close
FROM (SELECT recorded_at, {_display('city')} AS city, {_display('coalesce(station, ' + _display('city') + ')')} AS station
 FROM loaded) GROUP BY ALL"""),
        "selection_join": _sql(_PREPARING, f"""SELECT {_COLUMNS} FROM prepared
WHERE regexp_extract(city, '([0-9])', 1) IN ('0', '2', '4', '6')"""),
        "alert_flags": _sql(_MONITORING, """SELECT city, aqi, pm25, coalesce(aqi > 100, false) AS mitigation,
 coalesce(aqi > 150, false) AS advisory, coalesce(pm25 > 35, false) AS filtration FROM latest"""),
        "hourly_avg": _sql(_PREPARING, """SELECT city, date_trunc('hour', recorded_at) AS hour, count(*) AS readings,
 avg(aqi) AS avg_aqi FROM prepared GROUP BY ALL"""),
        "rolling_avg_2h": _sql(_PREPARING, """SELECT city, recorded_at, readings, sum(aqi_sum) OVER two / sum(aqi_rows) OVER two
 AS rolling_avg FROM (SELECT city, recorded_at, count(*) AS readings, sum(aqi) AS aqi_sum, count(aqi) AS aqi_rows
 FROM prepared WHERE recorded_at IS NOT NULL GROUP BY ALL)
WINDOW two AS (PARTITION BY city ORDER BY recorded_at RANGE BETWEEN INTERVAL 2 HOUR PRECEDING AND CURRENT ROW)"""),
        "scan_fact": _sql(_STORING, f"SELECT {_COLUMNS} FROM fact"),
        "clean_city": _sql(raw, "SELECT reading_id, lower(trim(city)) AS city FROM readings"),
        "clean_station": _sql(raw, "SELECT reading_id, trim(station) AS station FROM readings"),
        "parse_event_time": _sql(raw, """SELECT reading_id,
 CASE WHEN reading_id % 17 <> 0 THEN fetched_at - INTERVAL 330 MINUTE END AS recorded_at FROM readings"""),
        "cast_aqi": _sql(typed, "SELECT reading_id, aqi FROM typed"),
        "cast_pollutants": _sql(typed, "SELECT reading_id, pm25, pm10, o3, no2, co FROM typed"),
        "aqi_band": _sql(typed, "SELECT reading_id, aqi, aqi_category FROM typed"),
        "filter_valid_aqi": _sql(typed, f"SELECT {_CLEAN_COLUMNS}, reading_id FROM typed WHERE aqi IS NOT NULL"),
        "dedup_readings": _sql(raw, """SELECT * EXCLUDE (rn) FROM (
 SELECT *, row_number() OVER (PARTITION BY city, recorded_at ORDER BY reading_id) AS rn FROM readings)
WHERE rn = 1"""),
        "clean": _sql(_STORING, f"SELECT {_COLUMNS} FROM fact"),
        "quality_counts": _sql(_STORING, """SELECT (SELECT count(*) FROM readings) AS raw_rows,
 (SELECT count(*) FROM typed WHERE aqi IS NOT NULL) AS valid_rows,
 (SELECT count(*) FROM fact) AS clean_rows"""),
        "stringify_clean": _sql(_STORING, f"""SELECT city, station, CAST(aqi AS VARCHAR) AS aqi,
 {_text('pm25')}, {_text('pm10')}, {_text('o3')}, {_text('no2')}, {_text('co')}, aqi_category,
 dominant_pollutant, strftime(recorded_at, '%Y-%m-%d %H:%M:%S') AS recorded_at FROM fact"""),
        "upsert_new": _sql(_UPSERT, f"SELECT {_COLUMNS} FROM fact f WHERE NOT {_KNOWN}"),
        "upsert_skipped": _sql(_UPSERT, f"SELECT {_COLUMNS} FROM fact f WHERE {_KNOWN}"),
        "load_counts": _sql(_UPSERT, f"""SELECT count(*) AS batch_rows,
 count(*) FILTER (WHERE NOT known) AS inserted_rows, count(*) FILTER (WHERE known) AS skipped_rows
FROM (SELECT {_KNOWN} AS known FROM fact f)"""),
        "load_repeats": _sql(_UPSERT, f"""SELECT count(*) AS batch_rows,
 (SELECT count(*) FROM fact f WHERE NOT {_KNOWN}) AS inserted_rows,
 count(*) - (SELECT count(*) FROM fact f WHERE NOT {_KNOWN}) AS skipped_rows FROM typed WHERE aqi IS NOT NULL"""),
        "history_union": _sql(_UPSERT, f"SELECT {_COLUMNS} FROM stored UNION ALL SELECT {_COLUMNS} FROM fact"),
        "prepare": _sql(_PREPARING, f"SELECT {_COLUMNS} FROM prepared"),
        "prepare_common_names": _sql(_PREPARING, f"SELECT {_COLUMNS} FROM prepared"),
        "display_name": _sql(raw, f"SELECT reading_id, {_display('city')} AS city FROM readings"),
        "station_fallback": _sql(raw, f"""SELECT reading_id,
 {_display('coalesce(station, ' + _display('city') + ')')} AS station FROM readings"""),
        "aqi_band_range_join": _sql((_READINGS, _CATEGORIES), """SELECT r.reading_id, r.aqi,
 coalesce(c.category, 'Hazardous') AS category
FROM (SELECT reading_id, TRY_CAST(aqi AS DOUBLE) AS aqi FROM readings) r
LEFT JOIN categories c ON r.aqi BETWEEN c.low AND c.high"""),
        "category_lookup": _sql((*_PREPARING, _CATEGORIES), """SELECT p.city, p.fetched_at, p.aqi_category,
 coalesce(c.color, '#7f8c8d') AS color FROM prepared p LEFT JOIN categories c ON c.category = p.aqi_category"""),
        "pollutant_lookup": _sql((_READINGS, _POLLUTANTS), """SELECT r.reading_id,
 r.dominant_pollutant AS pollutant, d.name, d.unit
FROM readings r LEFT JOIN pollutants d ON d.pollutant = r.dominant_pollutant"""),
        "filter_selection": _sql(_PREPARING, f"""SELECT {_COLUMNS} FROM prepared
WHERE city IN (SELECT DISTINCT city FROM prepared ORDER BY city LIMIT 3) AND aqi_category IN ({categories})"""),
        "distinct_cities": _sql(_PREPARING, "SELECT DISTINCT city FROM prepared ORDER BY city"),
        "distinct_categories": _sql(_PREPARING, "SELECT DISTINCT aqi_category FROM prepared ORDER BY 1"),
        "default_cities": _sql(_PREPARING, "SELECT DISTINCT city FROM prepared ORDER BY city LIMIT 3"),
        "latest_by_city": _sql(_MONITORING, "SELECT * FROM latest ORDER BY aqi DESC NULLS LAST, city"),
        "status_panel": _sql((*_MONITORING, _CATEGORIES), """SELECT w.city, upper(w.aqi_category) AS status,
 coalesce(c.color, '#7f8c8d') AS color, CAST(trunc(w.aqi) AS INTEGER) AS current_aqi,
 CASE WHEN length(w.dominant_pollutant) > 0 THEN upper(w.dominant_pollutant) ELSE 'N/A' END AS primary_pollutant
FROM worst w LEFT JOIN categories c ON c.category = w.aqi_category"""),
        "peak_city": _sql(_MONITORING, "SELECT city, CAST(trunc(aqi) AS INTEGER) AS peak_aqi FROM worst"),
        "delta_to_threshold": _sql(_MONITORING, """SELECT city, CAST(trunc(aqi) AS INTEGER) AS current_aqi,
 CAST(trunc(aqi) AS INTEGER) - 100 AS delta FROM latest"""),
        "freshness": _sql(_PREPARING, """SELECT last_seen, strftime(last_seen, '%Y-%m-%d') AS seen_date,
 strftime(last_seen, '%H:%M:%S') AS seen_time FROM (SELECT max(fetched_at) AS last_seen FROM prepared)"""),
        "kpi_summary": _sql(_PREPARING, """SELECT avg(aqi) AS avg_aqi, max(pm25) AS peak_pm25,
 count(*) AS records FROM prepared"""),
        "kpi_rounded": _sql(_PREPARING, """SELECT round_even(avg(aqi), 1) AS avg_aqi,
 round_even(max(pm25), 1) AS peak_pm25, count(*) AS records FROM prepared"""),
        "aqi_trend": _sql((*_PREPARING, _TREND), """SELECT records, current_avg, previous_avg, trend_pct
FROM trend_pct"""),
        "aqi_trend_flag": _sql((*_PREPARING, _TREND), """SELECT
 CASE WHEN trend_pct > 0 THEN 'up' ELSE 'down' END AS direction, abs(trend_pct) AS change_pct FROM trend_pct"""),
        "network_coverage": _sql(_PREPARING, """SELECT count(DISTINCT city) AS cities,
 count(DISTINCT station) AS stations FROM prepared"""),
        "network_coverage_approx": "SELECT TRUE AS cities_close, TRUE AS stations_close",
        "overview": _sql(_PREPARING, """SELECT avg(aqi) AS avg_aqi, max(pm25) AS peak_pm25, count(*) AS records,
 max(fetched_at) AS last_seen, count(DISTINCT city) AS cities, count(DISTINCT station) AS stations
FROM prepared"""),
        "category_distribution": _sql(_PREPARING, """SELECT aqi_category AS category, count(*) AS readings,
 count(*) / (SELECT count(*) FROM prepared) AS share FROM prepared GROUP BY aqi_category"""),
        "recent_readings": _sql(_STORING, f"""SELECT {_COLUMNS} FROM fact
ORDER BY fetched_at DESC NULLS LAST LIMIT 2000"""),
        "monitoring_log": _sql((*_PREPARING, _LOG), "SELECT * FROM log"),
        "export_rows": _sql((*_PREPARING, _LOG), """SELECT * REPLACE (
 CASE WHEN microsecond("Ingestion Timestamp") % 1000000 = 0
 THEN strftime("Ingestion Timestamp", '%Y-%m-%d %H:%M:%S')
 ELSE strftime("Ingestion Timestamp", '%Y-%m-%d %H:%M:%S.%f') END AS "Ingestion Timestamp",
 strftime("Measurement Timestamp", '%Y-%m-%d %H:%M:%S') AS "Measurement Timestamp",
 CAST("PM2.5 (µg/m³)" AS VARCHAR) AS "PM2.5 (µg/m³)") FROM log"""),
        "time_series": _sql(_PREPARING, "SELECT fetched_at, aqi, city FROM prepared"),
        "city_series": _sql(_PREPARING, f"""SELECT fetched_at, {CHOSEN_POLLUTANT} AS value FROM prepared
WHERE city = '{CHOSEN_CITY}' AND (SELECT count(*) FROM prepared WHERE city = '{CHOSEN_CITY}') > 1"""),
        "pollutant_profile": _sql(
            (*_PREPARING, _LATEST, _POLLUTANTS, _LONG.format(source="latest")),
            f"SELECT name AS pollutant, value, unit FROM long WHERE city = '{CHOSEN_CITY}'"),
        "pollutant_long": _sql(
            (*_PREPARING, _POLLUTANTS, _LONG.format(source="prepared")),
            "SELECT city, fetched_at, pollutant, value, name, unit FROM long"),
    }
