"""DuckDB SQL for the registered queries, written row by row.

The SQL follows the definitions directly: no slices, no collapsed instants, no
copies. It is an independent check of what the operators do to scale.
"""

from __future__ import annotations

from lanepulse import schemas as S
from lanepulse.plans import intake_streams as I

_CLASSES = S.CLASSES


def _measurements(ts: str = "ts", sensor: str = "user_id", where: str = "true") -> str:
    return f"""m AS (
      SELECT event_id, CAST({sensor} AS INTEGER) AS uniqueId,
             CAST(floor(value) AS INTEGER) AS reading,
             CAST(json_extract_string(props, '$.k') AS INTEGER) AS occ, {ts} AS ts
      FROM events WHERE {where})"""


def _flagged(short: str = "12 HOUR", long: str = "48 HOUR", ts: str = "ts",
             sensor: str = "user_id", where: str = "true") -> str:
    """CTEs m (input), p (windows), q (previous), f (flags), loc, r (results)."""
    frame = "PARTITION BY uniqueId ORDER BY ts RANGE BETWEEN INTERVAL {} PRECEDING AND CURRENT ROW"
    return f"""WITH {_measurements(ts, sensor, where)},
    p AS (
      SELECT event_id, uniqueId,
             CAST(trunc(avg(reading) OVER w0) AS INTEGER) AS speed,
             CAST(trunc(avg(occ) OVER w0) AS INTEGER) AS bezettingsgraad,
             CAST(max(epoch_us(ts)) OVER w0 // 1000 AS BIGINT) AS recordTimestamp,
             CAST(trunc(avg(reading) OVER w3) AS INTEGER) AS avgSpeed3Minutes,
             CAST(trunc(avg(reading) OVER w10) AS INTEGER) AS avgSpeed10Minutes,
             max(ts) OVER w0 AS originalRecordTimestamp
      FROM m
      WINDOW w0 AS ({frame.format('0 MINUTE')}),
             w3 AS ({frame.format(short)}),
             w10 AS ({frame.format(long)})),
    q AS (
      SELECT *, lag(speed, 1, speed) OVER (
               PARTITION BY uniqueId ORDER BY originalRecordTimestamp, event_id) AS previousSpeed
      FROM p),
    f AS (
      SELECT *,
             CAST(CASE WHEN avgSpeed3Minutes BETWEEN 0 AND 40 AND bezettingsgraad <> 0 THEN 1
                  WHEN avgSpeed3Minutes BETWEEN 41 AND 250 OR bezettingsgraad = 0 THEN 0
                  ELSE -1 END AS INTEGER) AS trafficJamIndicator,
             speed - previousSpeed AS speedDiff,
             CAST(CASE WHEN speed - previousSpeed >= 20 THEN 1
                  WHEN speed - previousSpeed <= -20 THEN -1
                  ELSE 0 END AS INTEGER) AS speedDiffIndicator
      FROM q),
    loc AS (SELECT CAST(s_suppkey AS INTEGER) AS id, s_name AS locatie FROM supplier),
    fl AS (SELECT f.*, loc.locatie AS location FROM f LEFT JOIN loc ON f.uniqueId = loc.id)"""


_RESULTS = """,
    r AS (
      SELECT 'SPEED_DIFFERENTIAL' AS outputType, uniqueId, previousSpeed, speed AS currentSpeed,
             CAST(NULL AS INTEGER) AS avgSpeed3Minutes, CAST(NULL AS INTEGER) AS avgSpeed10Minutes,
             speedDiffIndicator, CAST(NULL AS INTEGER) AS trafficJamIndicator, bezettingsgraad,
             recordTimestamp, location, originalRecordTimestamp, event_id FROM fl
      UNION ALL BY NAME
      SELECT 'TRAFFIC_JAM' AS outputType, uniqueId, speed AS currentSpeed, trafficJamIndicator,
             recordTimestamp, location, originalRecordTimestamp, event_id FROM fl
      UNION ALL BY NAME
      SELECT 'SPEED_AVG' AS outputType, uniqueId, speed AS currentSpeed, avgSpeed3Minutes,
             avgSpeed10Minutes, recordTimestamp, location, originalRecordTimestamp, event_id
      FROM fl)"""

_JAM_POINTS = """,
    jam_before AS (
      SELECT *, lag(trafficJamIndicator) OVER (
               PARTITION BY uniqueId ORDER BY originalRecordTimestamp, event_id) AS before
      FROM fl),
    jam_points AS (
      SELECT * FROM jam_before WHERE before IS NULL OR before <> trafficJamIndicator)"""

_SPEED_POINTS = """,
    speed_before AS (
      SELECT *, lag(speedDiffIndicator) OVER (
               PARTITION BY uniqueId ORDER BY originalRecordTimestamp, event_id) AS before
      FROM fl),
    speed_points AS (
      SELECT * FROM speed_before WHERE before IS NULL OR before <> speedDiffIndicator)"""

_STATE = f"""{_JAM_POINTS}{_SPEED_POINTS},
    writes AS (
      SELECT 'SPEED_DIFFERENTIAL' AS outputType, uniqueId, previousSpeed, speed AS currentSpeed,
             CAST(NULL AS INTEGER) AS avgSpeed3Minutes, CAST(NULL AS INTEGER) AS avgSpeed10Minutes,
             speedDiffIndicator, CAST(NULL AS INTEGER) AS trafficJamIndicator, bezettingsgraad,
             recordTimestamp, location, originalRecordTimestamp, event_id FROM speed_points
      UNION ALL BY NAME
      SELECT 'TRAFFIC_JAM' AS outputType, uniqueId, speed AS currentSpeed, trafficJamIndicator,
             recordTimestamp, location, originalRecordTimestamp, event_id FROM jam_points
      UNION ALL BY NAME
      SELECT 'SPEED_AVG' AS outputType, uniqueId, speed AS currentSpeed, avgSpeed3Minutes,
             avgSpeed10Minutes, recordTimestamp, location, originalRecordTimestamp, event_id
      FROM fl),
    newest AS (
      SELECT *, row_number() OVER (PARTITION BY uniqueId, outputType
               ORDER BY originalRecordTimestamp DESC, event_id DESC) AS rn FROM writes),
    state AS (
      SELECT CAST(uniqueId AS VARCHAR) AS uniqueId, outputType,
             CAST(recordTimestamp AS VARCHAR) AS recordTimestamp,
             outputType || '_' || recordTimestamp AS outputType_recordTimestamp,
             currentSpeed, previousSpeed, avgSpeed3Minutes, avgSpeed10Minutes,
             speedDiffIndicator, trafficJamIndicator, bezettingsgraad, location AS loc
      FROM newest WHERE rn = 1)"""

_NOTES = f"""{_JAM_POINTS},
    alerts AS (
      SELECT CAST(uniqueId AS VARCHAR) AS uniqueId, originalRecordTimestamp, event_id,
             CAST(trafficJamIndicator AS VARCHAR) AS alertIndicator, location AS loc
      FROM jam_points),
    alert_feed AS (
      SELECT *, row_number() OVER (PARTITION BY uniqueId
               ORDER BY originalRecordTimestamp, event_id) AS version FROM alerts),
    notes AS (
      SELECT uniqueId, originalRecordTimestamp,
             CASE WHEN alertIndicator = '1'
                  THEN 'New traffic jam at location: ' || coalesce(loc, uniqueId)
                  ELSE 'The traffic jam at location: ' || coalesce(loc, uniqueId) || ' is gone!'
             END AS message,
             alertIndicator = '1' AS incoming
      FROM alert_feed
      WHERE alertIndicator = '1' OR (alertIndicator = '0' AND version > 1))"""

_PROFILE = """uniqueId, speed, bezettingsgraad, recordTimestamp, avgSpeed3Minutes,
    avgSpeed10Minutes, originalRecordTimestamp"""
_RESULT = ", ".join(S.RESULT_COLUMNS)


def _flat_events(epoch: str | None = None) -> str:
    """CTE fe: ``events`` as flat events. ``epoch`` replaces the ISO time."""
    iso = "strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+01:00'"
    observed = {
        None: iso,
        "instant": "CAST(epoch_us(ts) // 1000000 - 3600 AS VARCHAR)",
        "wall_clock": "CAST(epoch_us(ts) // 1000000 AS VARCHAR)",
    }[epoch]
    speed = "CAST(CAST(floor(value) AS INTEGER) AS VARCHAR)"
    columns = []
    for n in _CLASSES:
        intensity, mean, harm = S.class_columns(n)
        if n == 2:
            value = (f"CASE event_type WHEN 'error' THEN '252' WHEN 'signup' THEN '254' "
                     f"ELSE {speed} END")
        else:
            value = f"CASE WHEN event_id % {n + 1} = 0 THEN '252' ELSE {speed} END"
        columns += [
            f"CAST(event_id % {n + 3} AS VARCHAR) AS {intensity}",
            f"{speed} AS {mean}",
            f"{value} AS {harm}",
        ]
    return f"""WITH fe AS (
      SELECT event_id, 'H' || user_id || 'L10' AS beschrijvende_id,
             CAST(user_id AS VARCHAR) AS unieke_id,
             json_extract_string(props, '$.k') AS lve_nr,
             {observed} AS tijd_waarneming, {iso} AS tijd_laatst_gewijzigd,
             '1' AS actueel_publicatie, '1' AS beschikbaar, '0' AS defect, '0' AS geldig,
             {", ".join(columns)},
             json_extract_string(props, '$.k') AS rekendata_bezettingsgraad,
             '100' AS rekendata_beschikbaarheidsgraad, '86' AS rekendata_onrustigheid
      FROM events)"""


_USABLE = "voertuigsnelheid_harmonisch_klasse2 NOT IN ('252', '254')"


def _typed_input() -> str:
    columns = []
    for f in S.INPUT_ROW.fields:
        if f.name in S.INPUT_TEXT_LENGTH:
            columns.append(f"left({f.name}, {S.INPUT_TEXT_LENGTH[f.name]}) AS {f.name}")
        else:
            dtype = "BIGINT" if f.name == "tijd_waarneming" else "INTEGER"
            columns.append(f"CAST({f.name} AS {dtype}) AS {f.name}")
    return ", ".join(columns)


# lineitem as snapshot stations: all lines; the last of a line number in a total order.
_LINES = """WITH line AS (
      SELECT l_orderkey, l_linenumber,
             CAST(CAST(trunc(l_quantity) AS INTEGER) AS VARCHAR) AS intensity,
             CAST(CAST(floor(l_extendedprice / 1000) AS BIGINT) AS VARCHAR) AS mean,
             CAST(CAST(round(l_tax * 100) AS INTEGER) AS VARCHAR) AS harm,
             row_number() OVER (PARTITION BY l_orderkey, l_linenumber
               ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC,
                        l_quantity DESC, l_tax DESC) AS rn
      FROM lineitem),
    o AS (
      SELECT l_orderkey, max(l_shipdate) AS shipped,
             CAST(CAST(trunc(min(l_quantity)) AS INTEGER) AS VARCHAR) AS occupancy
      FROM lineitem GROUP BY l_orderkey)"""


def _pivot() -> str:
    columns = []
    for n in _CLASSES:
        for source, target in zip(("intensity", "mean", "harm"), S.class_columns(n)):
            columns.append(f"max({source}) FILTER (l_linenumber = {n}) AS {target}")
    return ", ".join(columns)


_PIVOT_NAMES = ", ".join(c for n in _CLASSES for c in S.class_columns(n))
_PIVOTED = f"""{_LINES},
    pv AS (SELECT l_orderkey, {_pivot()} FROM line WHERE rn = 1 GROUP BY l_orderkey)"""
_SNAPSHOT_EVENTS = f"""{_PIVOTED}
    SELECT 'H' || o.l_orderkey AS beschrijvende_id, CAST(o.l_orderkey AS VARCHAR) AS unieke_id,
           '31' AS lve_nr, CAST(epoch_us(shipped) // 1000000 - 3600 AS VARCHAR) AS tijd_waarneming,
           strftime(shipped, '%Y-%m-%dT%H:%M:%S') || '+01:00' AS tijd_laatst_gewijzigd,
           '0' AS actueel_publicatie, '1' AS beschikbaar, '0' AS defect, '0' AS geldig,
           {_PIVOT_NAMES}, occupancy AS rekendata_bezettingsgraad,
           '100' AS rekendata_beschikbaarheidsgraad, '0' AS rekendata_onrustigheid
    FROM o JOIN pv ON o.l_orderkey = pv.l_orderkey"""

_DAY = "CAST(date_trunc('day', ts) AS TIMESTAMP)"
_STATION_TEXT = """WITH st AS (
      SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name AS name,
             s_nationkey || '.5' AS lon, '51.' || s_suppkey || '1' AS lat FROM supplier),
    ft AS (
      SELECT id, '{"type":"Feature","id":"' || id
             || '","geometry":{"type":"Point","coordinates":[' || lon || ',' || lat
             || ']},"properties":{"name":"' || name || ' - ' || id || '"}}' AS json
      FROM st)"""


def _sliding(fn: str, value: str) -> str:
    wide = f"{fn}({value}) OVER w"
    result = f"CAST(trunc({wide}) AS INTEGER)" if fn == "avg" else wide
    return f"""WITH {_measurements()}
    SELECT DISTINCT uniqueId, ts AS recordTimestamp, {result} AS value FROM m
    WINDOW w AS (PARTITION BY uniqueId ORDER BY ts
                 RANGE BETWEEN INTERVAL 6 HOUR PRECEDING AND CURRENT ROW)"""


def _removed() -> str:
    columns = []
    for n in _CLASSES:
        harm = f"voertuigsnelheid_harmonisch_klasse{n}"
        columns += [
            f"CASE WHEN {harm} = '252' THEN NULL ELSE {c} END AS {c}" for c in S.class_columns(n)
        ]
    return ", ".join(columns)


def build(allowed: str, map_stations: tuple[str, ...]) -> dict[str, str]:
    """All oracle queries. The two lists are those the queries use."""
    f = _flagged()
    ids = ", ".join(f"'{i.strip()}'" for i in allowed.split(","))
    map_ids = ", ".join(f"'{i}'" for i in map_stations)
    change = "uniqueId, originalRecordTimestamp, previousSpeed, speed AS currentSpeed"
    bad_line = f"{I.TRUNCATED} OR {I.NO_SENSOR} OR {I.NO_NUMBER}"
    def restarted(unit: str, rows: int) -> str:
        return f"""CAST(trunc(avg(reading) OVER (PARTITION BY uniqueId, date_trunc('{unit}', ts)
            ORDER BY ts, reading NULLS FIRST ROWS {rows} PRECEDING)) AS INTEGER) AS per_{unit}"""

    first_half = "epoch_us(ts) < (SELECT (min(epoch_us(ts)) + max(epoch_us(ts))) // 2 FROM events)"
    images = ", ".join(f"old.{c} AS old_{c}, new.{c} AS new_{c}" for c in S.STATE.fieldNames() if c not in S.STATE_KEYS)
    sql = {
        "speed_profile": f"{f} SELECT {_PROFILE} FROM p",
        "speed_profile_minutes":
            f"{_flagged('3 MINUTE', '10 MINUTE')} SELECT {_PROFILE} FROM p",
        "speed_profile_ties": f"{_flagged(ts=_DAY)} SELECT {_PROFILE}, previousSpeed FROM q",
        "sliding_average": _sliding("avg", "occ"),
        "sliding_maximum": _sliding("max", "reading"),
        "previous_speed": f"""{f} SELECT uniqueId, previousSpeed, speed AS currentSpeed,
            bezettingsgraad, recordTimestamp, originalRecordTimestamp FROM q""",
        "latest_averages": f"""{f} SELECT uniqueId, speed AS currentSpeed, avgSpeed3Minutes,
            avgSpeed10Minutes, recordTimestamp, originalRecordTimestamp FROM p""",
        "traffic_jam": f"""{f} SELECT uniqueId, speed, trafficJamIndicator, recordTimestamp,
            originalRecordTimestamp FROM f""",
        "speed_change": f"""{f} SELECT uniqueId, previousSpeed, speed AS currentSpeed, speedDiff,
            bezettingsgraad, recordTimestamp, originalRecordTimestamp FROM f""",
        "speed_diff_indicator": f"""{f} SELECT uniqueId, previousSpeed, speed AS currentSpeed,
            speedDiffIndicator, bezettingsgraad, recordTimestamp, originalRecordTimestamp
            FROM f""",
        "location_join": f"""{f} SELECT uniqueId, reading AS speed, occ AS bezettingsgraad,
            ts AS recordTimestamp, locatie AS location
            FROM m LEFT JOIN loc ON m.uniqueId = loc.id""",
        "traffic_output": f"{f}{_RESULTS} SELECT {_RESULT} FROM r",
        "traffic_output_ties": f"{_flagged(ts=_DAY)}{_RESULTS} SELECT {_RESULT} FROM r",
        "tag_output": f"{f}{_RESULTS} SELECT {_RESULT} FROM r WHERE outputType = 'TRAFFIC_JAM'",
        "variant_routing": f"""{f}{_RESULTS} SELECT outputType, count(*) AS n,
            CAST(sum(currentSpeed) AS BIGINT) AS total FROM r GROUP BY outputType""",
        "routed_averages": f"""{f}{_RESULTS} SELECT uniqueId, currentSpeed, avgSpeed3Minutes,
            avgSpeed10Minutes, recordTimestamp FROM r WHERE outputType = 'SPEED_AVG'""",
        "composite_key": f"""{f}{_RESULTS} SELECT uniqueId, outputType, recordTimestamp,
            outputType || '_' || recordTimestamp AS outputType_recordTimestamp FROM r""",
        "state_item": f"""{f}{_RESULTS} SELECT CAST(uniqueId AS VARCHAR) AS uniqueId, outputType,
            CAST(recordTimestamp AS VARCHAR) AS recordTimestamp,
            outputType || '_' || recordTimestamp AS outputType_recordTimestamp, currentSpeed,
            previousSpeed, avgSpeed3Minutes, avgSpeed10Minutes, speedDiffIndicator,
            trafficJamIndicator, bezettingsgraad, location AS loc FROM r""",
        "dashboard_rows": f"""{f}{_RESULTS} SELECT {_RESULT},
            outputType || '_' || recordTimestamp AS outputType_recordTimestamp FROM r""",
        "jam_change_points": f"""{f}{_JAM_POINTS} SELECT uniqueId, originalRecordTimestamp,
            speed AS currentSpeed, trafficJamIndicator, location AS loc FROM jam_points""",
        "speed_change_points": f"""{f}{_SPEED_POINTS} SELECT {change}, speedDiffIndicator,
            bezettingsgraad, location AS loc FROM speed_points""",
        "latest_reading": f"""{f}, n AS (SELECT *, row_number() OVER (PARTITION BY uniqueId
            ORDER BY originalRecordTimestamp DESC) AS rn FROM p)
            SELECT uniqueId, speed AS currentSpeed, avgSpeed3Minutes, avgSpeed10Minutes,
            recordTimestamp, originalRecordTimestamp FROM n WHERE rn = 1""",
        "latest_state": f"{f}{_STATE} SELECT * FROM state",
        "latest_state_ties": f"""{_flagged(ts=_DAY)}{_STATE} SELECT uniqueId, outputType,
            recordTimestamp, currentSpeed, avgSpeed3Minutes, speedDiffIndicator,
            trafficJamIndicator FROM state""",
        "change_feed": f"""{f}{_JAM_POINTS} SELECT uniqueId, originalRecordTimestamp,
            lag(trafficJamIndicator) OVER k AS oldIndicator,
            lag(recordTimestamp) OVER k AS oldTimestamp,
            trafficJamIndicator AS newIndicator, recordTimestamp AS newTimestamp
            FROM jam_points WINDOW k AS (PARTITION BY uniqueId ORDER BY originalRecordTimestamp)""",
        "state_change_feed": f"""{f}{_JAM_POINTS} SELECT uniqueId, 'TRAFFIC_JAM' AS outputType,
            originalRecordTimestamp, CAST(CASE WHEN row_number() OVER (PARTITION BY uniqueId
            ORDER BY originalRecordTimestamp) = 1 THEN 1 ELSE 0 END AS INTEGER) AS isNew,
            trafficJamIndicator FROM jam_points""",
        "alert_versions": f"""{f}{_NOTES} SELECT uniqueId, originalRecordTimestamp,
            alertIndicator, loc FROM alerts""",
        "notifications": f"{f}{_NOTES} SELECT * FROM notes",
        "current_situation": f"""{f}{_STATE} SELECT uniqueId, CAST(count(*) AS INTEGER) AS n,
            string_agg(outputType_recordTimestamp, ',' ORDER BY CASE outputType
              WHEN 'SPEED_DIFFERENTIAL' THEN 1 WHEN 'TRAFFIC_JAM' THEN 2 ELSE 3 END) AS keys
            FROM state GROUP BY uniqueId""",
        "current_situation_json": f"""{f}{_STATE} SELECT uniqueId, uniqueId AS sensor,
            'SPEED_DIFFERENTIAL' AS firstType, CAST(count(*) + 1 AS INTEGER) AS parts
            FROM state GROUP BY uniqueId""",
        "current_alerts": f"""{f}{_NOTES}, n AS (SELECT *, row_number() OVER (
            PARTITION BY uniqueId ORDER BY version DESC) AS rn FROM alert_feed)
            SELECT uniqueId, '{{"uniqueId":"' || uniqueId || '","alertIndicator":"'
            || alertIndicator || '"' || CASE WHEN loc IS NULL THEN ''
            ELSE ',"loc":"' || loc || '"' END || '}}' AS entry FROM n WHERE rn = 1""",
        "distinct_ids": f"{f} SELECT DISTINCT uniqueId FROM m",
        "row_count": f"{f} SELECT count(*) AS n FROM m",
        "flag_count": f"""{f} SELECT uniqueId, count(*) AS n FROM f
            WHERE trafficJamIndicator = 1 GROUP BY uniqueId""",
        "state_lookup": f"""{f}{_STATE} SELECT uniqueId, outputType, trafficJamIndicator,
            recordTimestamp FROM state WHERE outputType = 'TRAFFIC_JAM'
            AND trafficJamIndicator = 1""",
        "key_scan": "SELECT user_id, event_type FROM events",
        "unmeasured_filter": f"""{_flat_events()} SELECT event_id, unieke_id,
            voertuigsnelheid_harmonisch_klasse2 FROM fe WHERE {_USABLE}""",
        "sensor_allowlist": f"""{_flat_events()} SELECT event_id, unieke_id FROM fe
            WHERE unieke_id IN ({ids})""",
        "sensor_allowlist_table": f"""{_flat_events()} SELECT event_id, unieke_id FROM fe
            WHERE unieke_id IN (SELECT CAST(s_suppkey AS VARCHAR) FROM supplier)""",
        "input_filter": f"""{_flat_events()} SELECT event_id, unieke_id,
            voertuigsnelheid_harmonisch_klasse2 FROM fe
            WHERE {_USABLE} AND unieke_id IN ({ids})""",
        "class_removal": f"{_flat_events()} SELECT event_id, {_removed()} FROM fe",
        "disposition": f"""{_flat_events()} SELECT event_id AS "recordId",
            CASE WHEN {_USABLE} THEN 'Ok' ELSE 'Dropped' END AS result,
            CASE WHEN {_USABLE} THEN unieke_id END AS sensor,
            CASE WHEN {_USABLE} AND voertuigsnelheid_harmonisch_klasse1 <> '252'
                 THEN voertuigsnelheid_rekenkundig_klasse1 END AS speed1 FROM fe""",
        "preprocess": f"""{_flat_events()} SELECT event_id, unieke_id,
            voertuigsnelheid_rekenkundig_klasse2,
            CASE WHEN voertuigsnelheid_harmonisch_klasse5 <> '252'
                 THEN voertuigsnelheid_harmonisch_klasse5 END
              AS voertuigsnelheid_harmonisch_klasse5 FROM fe WHERE {_USABLE}""",
        "json_parse": f"{_flat_events('instant')} SELECT {_typed_input()} FROM fe",
        "json_parse_raw": """SELECT event_id,
            CAST(json_extract_string(props, '$.k') AS INTEGER) AS lve_nr,
            CAST(NULL AS INTEGER) AS unieke_id FROM events""",
        "measurements_from_events": f"""{_flat_events('instant')}
            SELECT CAST(unieke_id AS INTEGER) AS uniqueId,
            CAST(voertuigsnelheid_rekenkundig_klasse2 AS INTEGER) AS speed,
            CAST(rekendata_bezettingsgraad AS INTEGER) AS bezettingsgraad,
            CAST(tijd_waarneming AS BIGINT) AS observed FROM fe WHERE {_USABLE}""",
        "normalize_time": """SELECT event_id,
            CAST(epoch_us(ts) // 1000000 - 3600 AS VARCHAR) AS instant,
            CAST(epoch_us(ts) // 1000000 AS VARCHAR) AS wall_clock FROM events""",
        "english_names": f"""{_flat_events()} SELECT unieke_id AS sensor_id,
            tijd_waarneming AS observed_at, rekendata_bezettingsgraad AS occupancy,
            verkeersintensiteit_klasse1 AS intensity_c1,
            voertuigsnelheid_harmonisch_klasse5 AS speed_harm_c5 FROM fe""",
        "strip_marker": f"""{_LINES} SELECT CAST(l_orderkey AS VARCHAR) AS unieke_id,
            'H' || l_orderkey AS beschrijvende_id,
            CAST(min(l_linenumber) AS VARCHAR) AS first_class,
            CAST(count(*) AS INTEGER) AS classes FROM line GROUP BY l_orderkey""",
        "class_pivot": f"""{_PIVOTED} SELECT CAST(l_orderkey AS VARCHAR) AS unieke_id,
            {_PIVOT_NAMES} FROM pv""",
        "flatten": f"""{_LINES} SELECT CAST(l_orderkey AS VARCHAR) AS unieke_id,
            occupancy AS rekendata_bezettingsgraad, '100' AS rekendata_beschikbaarheidsgraad,
            '0' AS rekendata_onrustigheid FROM o""",
        "flat_events": _SNAPSHOT_EVENTS,
        "clean_input": f"""{_flat_events('wall_clock')} SELECT CAST(unieke_id AS INTEGER)
            AS uniqueId, CAST(voertuigsnelheid_rekenkundig_klasse2 AS INTEGER) AS speed,
            CAST(rekendata_bezettingsgraad AS INTEGER) AS bezettingsgraad,
            CAST(tijd_waarneming AS BIGINT) AS observed FROM fe""",
        "number_text": """SELECT event_id, CASE WHEN floor(value * 2) % 2 = 0
            THEN CAST(CAST(floor(value * 2) / 2 AS BIGINT) AS VARCHAR)
            ELSE CAST(CAST(floor(value * 2) / 2 AS DOUBLE) AS VARCHAR) END AS n FROM events""",
        "payload_envelope": """SELECT event_id, to_base64(encode(props)) AS data,
            props AS payload FROM events""",
        "landed_names": "SELECT page_id, 'json/input/' || page_id || '.json' AS landed FROM pages",
        "locations_build": """SELECT s_name || '-' || s_suppkey AS locatieId, s_name AS locatie,
            CAST(s_suppkey AS INTEGER) AS id,
            CAST(s_nationkey || '.5' AS DOUBLE) AS longitude,
            CAST('51.' || s_suppkey || '1' AS DOUBLE) AS latitude FROM supplier""",
        "station_filter": f"""SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name AS volledige_naam
            FROM supplier WHERE CAST(s_suppkey AS VARCHAR) IN ({map_ids})""",
        "geojson_features": f"{_STATION_TEXT} SELECT id, json FROM ft",
        "geojson_collection": f"""{_STATION_TEXT}
            SELECT '{{"type":"FeatureCollection","features":['
            || string_agg(json, ',' ORDER BY id) || ']}}' AS value
            FROM ft WHERE id IN ({map_ids})""",
        "speed_ramp": """WITH steps AS (
              SELECT i AS step, CAST(CASE WHEN i < 10 THEN 120 WHEN i < 14 THEN 120 - 5 * (i - 10)
                     WHEN i < 20 THEN 100 - 10 * (i - 14) ELSE 40 - 2 * (i - 20) END AS INTEGER)
                     AS speed
              FROM generate_series(0, 34) AS g(i))
            SELECT CAST(s_suppkey AS VARCHAR) AS unieke_id, CAST(step AS INTEGER) AS step,
            CAST(1700000000 + 60 * step AS BIGINT) AS tijd_waarneming,
            speed AS voertuigsnelheid_rekenkundig_klasse2,
            speed AS voertuigsnelheid_harmonisch_klasse2 FROM supplier CROSS JOIN steps""",
        # Round trips
        "landed_snapshot": f"""{_LINES}, n AS (SELECT l_orderkey,
              CAST(count(*) AS INTEGER) AS classes FROM line GROUP BY l_orderkey)
            SELECT CAST(o.l_orderkey AS VARCHAR) AS unieke_id, classes, occupancy
            FROM o JOIN n ON o.l_orderkey = n.l_orderkey""",
        "raw_landing": """SELECT count(DISTINCT l_orderkey) AS stations, count(*) AS classes,
            true AS names_differ FROM lineitem""",
        "snapshot_lines": """SELECT count(*) AS lines, count(DISTINCT l_orderkey) AS stations
            FROM lineitem""",
        "events_jsonl": f"""{_flat_events()}
            SELECT {", ".join(S.FLAT_EVENT_COLUMNS)} FROM fe""",
        "archived_results": f"""{f}{_RESULTS} SELECT outputType, count(*) AS n,
            CAST(sum(currentSpeed) AS BIGINT) AS total,
            (SELECT count(*) FROM events) AS events FROM r GROUP BY outputType""",
        "published_results": f"{f}{_RESULTS} SELECT {_RESULT} FROM r",
        "archived_records": f"{f}{_RESULTS} SELECT {_RESULT} FROM r",
        "alert_table": f"""{f}{_NOTES}, n AS (SELECT *, row_number() OVER (
            PARTITION BY uniqueId ORDER BY version DESC) AS rn FROM alert_feed)
            SELECT uniqueId, alertIndicator, loc FROM n WHERE rn = 1""",
        "notification_table": f"{f}{_NOTES} SELECT message, incoming FROM notes",
        "dashboard_feed": f"""{f}{_RESULTS} SELECT uniqueId,
            outputType || '_' || recordTimestamp AS outputType_recordTimestamp FROM r""",
        "station_config_xml": """SELECT CAST(s_suppkey AS VARCHAR) AS unieke_id,
            'H' || s_suppkey || 'L10' AS beschrijvende_id, s_name AS volledige_naam,
            'B0070004' AS Ident_8, '12' AS lve_nr, '7,250' AS Kmp_Rsys, 'L20' AS Rijstrook,
            '100200,5' AS X_coord_EPSG_31370, '200100,25' AS Y_coord_EPSG_31370,
            s_nationkey || ',5' AS lengtegraad_EPSG_4326,
            '51,' || s_suppkey || '1' AS breedtegraad_EPSG_4326 FROM supplier""",
        "cleared_table": f"""{f}{_STATE} SELECT outputType, count(*) AS n FROM state
            WHERE outputType <> 'TRAFFIC_JAM' GROUP BY outputType""",
        # Intake, consumers and archives
        "stream_quarantine": f"""{_flagged(where=f"NOT ({bad_line})")} SELECT {_PROFILE} FROM p""",
        "quarantined_rows": f"""SELECT event_id,
            CASE WHEN {I.TRUNCATED} THEN 'corrupt' WHEN {I.NO_SENSOR} THEN 'no_sensor' ELSE 'failed' END AS reason,
            CASE WHEN {I.TRUNCATED} THEN substr('{{"id":"' || event_id || '","sensor":"' || user_id || '","speed":"'
                || CAST(floor(value) AS INTEGER) || '","occupancy":"', 1, {I.LINE_LENGTH}) END AS line,
            CASE WHEN {I.TRUNCATED} OR {I.NO_SENSOR} THEN NULL
                ELSE 'no number in speed: x' || CAST(floor(value) AS INTEGER) END AS error
            FROM events WHERE {bad_line}""",
        "stream_start_latest": f"""{_flagged(where="epoch_us(ts) >= (SELECT min(epoch_us(ts)) + (max(epoch_us(ts)) - min(epoch_us(ts))) * 3 // 6 FROM events)")}
            SELECT {_PROFILE} FROM p""",
        "corrupt_events": f"""{_flat_events()}, lines AS (SELECT *, {I.TRUNCATED} AS bad FROM fe)
            SELECT CASE WHEN NOT bad THEN unieke_id END AS unieke_id,
            CASE WHEN NOT bad THEN tijd_waarneming END AS tijd_waarneming,
            CASE WHEN NOT bad THEN rekendata_bezettingsgraad END AS rekendata_bezettingsgraad,
            CASE WHEN bad THEN substr('{{"beschrijvende_id":"' || beschrijvende_id || '","unieke_id', 1,
                {I.LINE_LENGTH}) END AS line FROM lines""",
        "stream_late_rows": f"""WITH {_measurements()}, s AS (
              SELECT min(epoch_us(ts)) AS a, max(epoch_us(ts)) AS b FROM m)
            SELECT uniqueId, reading AS speed, occ AS bezettingsgraad, epoch_us(ts) AS recordTimestamp,
            event_id % {I.LATE} = 9 AND epoch_us(ts) < a + (b - a) * 3 // 6 AS late FROM m, s""",
        "stream_replays": f"""WITH {_measurements()} SELECT DISTINCT uniqueId, reading AS speed,
            occ AS bezettingsgraad, epoch_us(ts) AS recordTimestamp FROM m""",
        "stream_tumbling": f"""WITH {_measurements()} SELECT uniqueId,
            epoch_us(ts) // 43200000000 * 43200000000 AS windowStart,
            CAST(trunc(avg(reading)) AS INTEGER) AS avgSpeed, CAST(trunc(avg(occ)) AS INTEGER) AS avgOccupancy,
            count(*) AS readings FROM m GROUP BY ALL""",
        "stream_stagger": f"""WITH RECURSIVE {_measurements()},
            step AS (SELECT DISTINCT uniqueId, ts, min(ts) OVER (PARTITION BY uniqueId ORDER BY ts RANGE BETWEEN
              INTERVAL 12 HOUR FOLLOWING AND UNBOUNDED FOLLOWING) AS after FROM m),
            w(uniqueId, start) AS (
              SELECT uniqueId, min(ts) FROM m GROUP BY uniqueId
              UNION ALL SELECT s.uniqueId, s.after FROM w JOIN step s ON s.uniqueId = w.uniqueId AND s.ts = w.start
              WHERE s.after IS NOT NULL)
            SELECT w.uniqueId, epoch_us(start) AS windowStart, CAST(trunc(avg(reading)) AS INTEGER) AS avgSpeed,
            count(*) AS readings FROM w JOIN m ON m.uniqueId = w.uniqueId AND m.ts >= start
              AND m.ts < start + INTERVAL 12 HOUR GROUP BY w.uniqueId, start""",
        "time_probe": f"""WITH {_measurements()}, s AS (
              SELECT min(epoch_us(ts)) AS a, max(epoch_us(ts)) AS b FROM m),
            k AS (SELECT max(g.i) AS batch FROM m, s, range({I.LANDINGS}) AS g(i)
              WHERE g.i = 0 OR epoch_us(ts) >= a + (b - a) * g.i // {I.LANDINGS} GROUP BY event_id)
            SELECT CAST(batch AS INTEGER) AS batch, count(*) AS readings, true AS in_order FROM k GROUP BY batch""",
        "restarted_averages": f"""WITH {_measurements()} SELECT uniqueId, reading AS speed, occ AS bezettingsgraad,
            ts AS recordTimestamp, {restarted("hour", 2)}, {restarted("day", 10)} FROM m""",
        "table_change_feed": f"""WITH old AS ({_flagged(where=first_half)}{_STATE} SELECT * FROM state),
            new AS ({f}{_STATE} SELECT * FROM state WHERE CAST(uniqueId AS INTEGER) % 7 <> 0)
            SELECT coalesce(old.uniqueId, new.uniqueId) AS uniqueId,
            coalesce(old.outputType, new.outputType) AS outputType,
            CASE WHEN old.uniqueId IS NULL THEN 'insert' WHEN new.uniqueId IS NULL THEN 'delete' ELSE 'update' END
                AS change, {images}
            FROM old FULL JOIN new ON old.uniqueId = new.uniqueId AND old.outputType = new.outputType
            WHERE old IS DISTINCT FROM new""",
        "archived_days": f"""{f}{_RESULTS} SELECT {_RESULT} FROM r WHERE CAST(originalRecordTimestamp AS DATE)
            < (SELECT CAST(min(originalRecordTimestamp) AS DATE) + 10 FROM r)""",
        # Streams
        "stream_null_sensor": f"""{_flagged(sensor="CASE WHEN user_id % 10 <> 3 THEN user_id END")}
            SELECT {_PROFILE} FROM p""",
        "stream_outputs_agree": """SELECT outputType, 2 * (SELECT count(*) FROM events) AS records,
            0 AS differ FROM (VALUES ('SPEED_DIFFERENTIAL'), ('TRAFFIC_JAM'), ('SPEED_AVG')) AS t(outputType)""",
        "stream_jam_change_points": f"""{f}{_JAM_POINTS} SELECT uniqueId,
            originalRecordTimestamp, speed AS currentSpeed, trafficJamIndicator
            FROM jam_points""",
        "stream_speed_change_points": f"""{f}{_SPEED_POINTS} SELECT {change},
            speedDiffIndicator, bezettingsgraad FROM speed_points""",
    }
    same_as = {
        "snapshot_xml": "flat_events",
        "snapshot_json": "flat_events",
        "published_events": "json_parse",
        "state_table": "latest_state",
        "state_from_archive": "latest_state",
        "json_dump": "latest_state",
        "location_table": "locations_build",
        "stream_speed_profile": "speed_profile",
        "stream_previous_speed": "previous_speed",
        "stream_traffic_output": "traffic_output",
        "stream_state_table": "latest_state",
        "stream_restart": "latest_state",
        "stream_rate_limited": "speed_profile",
        "geojson_document": "geojson_collection",
        "stream_consumer_state": "latest_state",
        "stream_consumer_restart": "latest_state",
        "stream_notifications": "notification_table",
    }
    sql.update({name: sql[source] for name, source in same_as.items()})
    return sql
