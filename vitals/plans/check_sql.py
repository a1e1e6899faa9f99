"""The registered queries in DuckDB SQL, written independently, for comparison on the same tables."""

from __future__ import annotations

from .fixed import DELIVERIES

# --- inputs derived from the events table ----------------------------------------------------------

_READINGS = """readings AS (
  SELECT printf('device_%03d', user_id) AS device_id, epoch_us(ts) // 1000000 AS timestamp,
         CAST(floor(value) AS INTEGER) AS bpm, CAST(props::JSON->>'k' AS INTEGER) AS steps,
         CAST(48 AS DOUBLE) + CAST(event_id % 64 AS DOUBLE) / CAST(64 AS DOUBLE) AS lat,
         CAST(2 AS DOUBLE) + CAST(event_id % 32 AS DOUBLE) / CAST(32 AS DOUBLE) AS lng
  FROM events)"""

_CLEAN = (
    _READINGS
    + """,
clean AS (
  SELECT *, make_timestamp(timestamp * 1000000) AS t FROM readings
  WHERE device_id IS NOT NULL AND timestamp IS NOT NULL AND bpm > 0 AND bpm < 300 AND steps >= 0
    AND lat IS NOT NULL AND lng IS NOT NULL)"""
)

_MESSAGES = """messages AS (
  SELECT CASE WHEN event_type = 'error' AND event_id % 4 = 0
    THEN concat('{"device_id":', event_id, ' oops')
    ELSE concat('{"device_id":"', printf('device_%03d', user_id),
      '","timestamp":', epoch_us(ts) // 1000000,
      ',"bpm":', CASE WHEN event_type = 'error' AND event_id % 4 = 1
        THEN concat('"', CAST(floor(value) AS INTEGER), '"')
        ELSE CAST(CAST(floor(value) AS INTEGER) AS VARCHAR) END,
      ',"steps":', props::JSON->>'k',
      ',"lat":48.', lpad(CAST(event_id % 64 * 15625 AS VARCHAR), 6, '0'),
      CASE WHEN event_type = 'error' AND event_id % 4 = 2 THEN ''
        ELSE concat(',"lng":2.', lpad(CAST(event_id % 32 * 31250 AS VARCHAR), 6, '0')) END, '}') END AS json
  FROM events),
fields AS (
  SELECT json, CASE WHEN json_valid(json) THEN json::JSON END AS j FROM messages),
parsed AS (
  SELECT json,
    CASE WHEN json_type(j, '$.device_id') = 'VARCHAR' THEN j->>'$.device_id' END AS device_id,
    CASE WHEN json_type(j, '$.timestamp') IN ('UBIGINT', 'BIGINT') THEN CAST(j->>'$.timestamp' AS BIGINT) END AS timestamp,
    CASE WHEN json_type(j, '$.bpm') IN ('UBIGINT', 'BIGINT') THEN CAST(j->>'$.bpm' AS INTEGER) END AS bpm,
    CASE WHEN json_type(j, '$.steps') IN ('UBIGINT', 'BIGINT') THEN CAST(j->>'$.steps' AS INTEGER) END AS steps,
    CASE WHEN json_type(j, '$.lat') IN ('UBIGINT', 'BIGINT', 'DOUBLE') THEN CAST(j->>'$.lat' AS DOUBLE) END AS lat,
    CASE WHEN json_type(j, '$.lng') IN ('UBIGINT', 'BIGINT', 'DOUBLE') THEN CAST(j->>'$.lng' AS DOUBLE) END AS lng
  FROM fields)"""

_COMPLETE = (
    "(device_id IS NOT NULL AND timestamp IS NOT NULL AND bpm IS NOT NULL AND steps IS NOT NULL"
    " AND lat IS NOT NULL AND lng IS NOT NULL)"
)

_RAW = """b AS (
  SELECT event_id, event_type = 'error' AS bad, event_id % 5 AS kind, ts,
         printf('watch-%04d', user_id) AS dev,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS iso,
         CAST(30 + CAST(floor(value) AS INTEGER) % 221 AS INTEGER) AS hr,
         CAST(props::JSON->>'k' AS INTEGER) AS k,
         100000 - CAST(event_id % 160 AS INTEGER) * 125 AS milli,
         CAST(event_id % 101 AS INTEGER) AS bat
  FROM events),
p AS (
  SELECT event_id, ts, dev,
    CASE WHEN bad AND kind = 4 THEN concat('<binary ', event_id)
    ELSE concat('{"event_id":"evt-', event_id, '","device_id":"', dev, '","timestamp":"',
      CASE WHEN bad AND kind = 2 THEN 'half past nine' ELSE iso END,
      '","heart_rate":', CASE WHEN bad AND kind = 1 THEN 999 ELSE hr END,
      ',"steps":', CASE WHEN bad AND kind = 3 THEN -k - 1 ELSE k END,
      ',"spo2":', milli // 1000, '.', lpad(CAST(milli % 1000 AS VARCHAR), 3, '0'),
      CASE WHEN bad AND kind = 0 THEN '' ELSE concat(',"battery":', bat) END, '}') END AS payload,
    ts + CASE WHEN event_id % 7 = 0 THEN INTERVAL '3' HOUR ELSE INTERVAL '2' SECOND END AS arrival
  FROM b),
raw AS (
  SELECT payload, dev AS partition_key, concat('881', lpad(CAST(event_id AS VARCHAR), 53, '0')) AS sequence_number,
         'shard-0001' AS shard_id, arrival AS arrival_ts FROM p
  UNION ALL
  SELECT payload, dev, concat('881', lpad(CAST(event_id + 1000000000 AS VARCHAR), 53, '0')),
         'shard-0001', arrival + INTERVAL '1' MINUTE FROM p WHERE event_id % 50 = 0)"""

_INT = "IN ('UBIGINT', 'BIGINT')"

_CLASSIFIED = (
    _RAW
    + f""",
docs AS (
  SELECT *, json_valid(payload) AS ok, CASE WHEN json_valid(payload) THEN payload::JSON END AS j FROM raw),
typed AS (
  SELECT * EXCLUDE (j), json_type(j) AS t_doc,
    CASE WHEN json_type(j, '$.event_id') = 'VARCHAR' THEN j->>'$.event_id' END AS event_id,
    CASE WHEN json_type(j, '$.device_id') = 'VARCHAR' THEN j->>'$.device_id' END AS device_id,
    TRY_CAST(replace(j->>'$.timestamp', 'Z', '') AS TIMESTAMP) AS event_time,
    CASE WHEN json_type(j, '$.heart_rate') {_INT} THEN CAST(j->>'$.heart_rate' AS INTEGER) END AS heart_rate,
    CASE WHEN json_type(j, '$.steps') {_INT} THEN CAST(j->>'$.steps' AS INTEGER) END AS steps,
    CASE WHEN json_type(j, '$.spo2') IN ('UBIGINT', 'BIGINT', 'DOUBLE') THEN CAST(j->>'$.spo2' AS DOUBLE) END AS spo2,
    CASE WHEN json_type(j, '$.battery') {_INT} THEN CAST(j->>'$.battery' AS INTEGER) END AS battery
  FROM docs),
classified AS (
  SELECT *, CASE WHEN NOT ok THEN 'payload is not valid JSON'
    WHEN t_doc <> 'OBJECT' THEN 'payload is not a JSON object'
    ELSE concat_ws('; ',
      CASE WHEN NOT coalesce(length(event_id) > 0, false) THEN 'event_id missing or not a string' END,
      CASE WHEN NOT coalesce(regexp_full_match(device_id, '[A-Za-z0-9_.:-]{{1,64}}'), false) THEN 'device_id missing or invalid' END,
      CASE WHEN event_time IS NULL THEN 'timestamp missing or unparseable'
        WHEN event_time < TIMESTAMP '2020-01-01' OR event_time > arrival_ts + INTERVAL '5' MINUTE
        THEN 'timestamp out of accepted range' END,
      CASE WHEN NOT coalesce(heart_rate BETWEEN 20 AND 250, false) THEN 'heart_rate must be an integer in [20, 250]' END,
      CASE WHEN NOT coalesce(steps BETWEEN 0 AND 10000, false) THEN 'steps must be an integer in [0, 10000]' END,
      CASE WHEN NOT coalesce(spo2 BETWEEN 50 AND 100, false) THEN 'spo2 must be a number in [50, 100]' END,
      CASE WHEN NOT coalesce(battery BETWEEN 0 AND 100, false) THEN 'battery must be an integer in [0, 100]' END) END AS errors
  FROM typed)"""
)

_SILVER = (
    _CLASSIFIED
    + """,
silver AS (
  SELECT event_id, device_id, date_trunc('millisecond', event_time) AS event_time, heart_rate, steps, spo2, battery,
    CASE WHEN heart_rate < 40 THEN 'bradycardia' WHEN heart_rate > 180 THEN 'tachycardia'
      WHEN heart_rate < 100 THEN 'resting' WHEN heart_rate < 130 THEN 'light'
      WHEN heart_rate < 160 THEN 'moderate' ELSE 'vigorous' END AS heart_rate_zone,
    heart_rate < 40 OR heart_rate > 180 AS is_abnormal_hr,
    CASE WHEN spo2 < 90 THEN 'critical' WHEN spo2 < 95 THEN 'low' ELSE 'normal' END AS spo2_status,
    battery < 15 AS battery_low,
    date_trunc('millisecond', arrival_ts) AS arrival_time,
    TIMESTAMP '2024-02-01 00:00:00' AS processed_at,
    CAST(greatest(0, (epoch_us(TIMESTAMP '2024-02-01 00:00:00') - epoch_us(event_time)) // 1000) AS BIGINT) AS end_to_end_latency_ms,
    sequence_number AS kinesis_sequence_number,
    strftime(event_time, '%Y-%m-%d') AS dt, strftime(event_time, '%H') AS hour
  FROM classified WHERE errors = '')"""
)

_SEQUENCE = "length(ltrim(kinesis_sequence_number, '0')), ltrim(kinesis_sequence_number, '0')"

_DEDUPED = (
    _SILVER
    + f""",
deduped AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY dt, hour, event_id ORDER BY {_SEQUENCE}) AS rn FROM silver)
  WHERE rn = 1)"""
)

_GOLD = (
    _DEDUPED
    + """,
gold AS (
  SELECT device_id, count(*) AS event_count, round_even(avg(heart_rate), 2) AS avg_heart_rate,
    min(heart_rate) AS min_heart_rate, max(heart_rate) AS max_heart_rate,
    count(*) FILTER (WHERE is_abnormal_hr) AS abnormal_hr_count, CAST(sum(steps) AS BIGINT) AS total_steps,
    round_even(avg(spo2), 2) AS avg_spo2, min(spo2) AS min_spo2,
    arg_max(battery, {'t': event_time, 'b': battery}) AS last_battery,
    min(event_time) AS first_event_time, max(event_time) AS last_event_time,
    TIMESTAMP '2024-02-01 00:00:00' AS aggregated_at, dt, hour
  FROM deduped GROUP BY dt, hour, device_id)"""
)

_LOCAL_GOLD = (
    _CLEAN
    + """,
bpm AS (
  SELECT device_id, strftime(t, '%Y-%m-%d %H') AS hour, avg(bpm) AS avg_bpm, max(bpm) AS max_bpm, min(bpm) AS min_bpm
  FROM clean GROUP BY ALL),
day_steps AS (
  SELECT device_id, strftime(t, '%Y-%m-%d') AS day, CAST(sum(steps) AS BIGINT) AS total_steps FROM clean GROUP BY ALL),
local_gold AS (
  SELECT bpm.device_id, hour, avg_bpm, max_bpm, min_bpm, total_steps
  FROM bpm LEFT JOIN day_steps ON bpm.device_id = day_steps.device_id AND substr(hour, 1, 10) = day),
dashboard AS (
  SELECT *, substr(hour, 1, 10) AS day, CAST(hour || ':00:00' AS TIMESTAMP) AS datetime FROM local_gold),
device_day AS (SELECT device_id, day, arg_min(total_steps, datetime) AS total_steps FROM dashboard GROUP BY ALL)"""
)

_MEASURED = (
    _CLASSIFIED
    + """,
timed AS (
  SELECT *, arrival_ts + to_milliseconds(CAST(right(sequence_number, 9) AS BIGINT) % 40 * 2500 + 500) AS processed
  FROM classified),
measured AS (
  SELECT date_trunc('minute', processed) AS minute, date_trunc('minute', arrival_ts) AS arrival_minute,
    errors = '' AS is_valid, errors = '' AND (heart_rate < 40 OR heart_rate > 180) AS is_abnormal_hr,
    CASE WHEN errors = '' THEN CAST(greatest(0, (epoch_us(processed) - epoch_us(event_time)) // 1000) AS BIGINT) END AS latency_ms,
    CAST((epoch_us(processed) - epoch_us(arrival_ts)) // 1000 AS BIGINT) AS lag_ms, sequence_number
  FROM timed),
spine AS (
  SELECT unnest(generate_series(min(minute), max(minute), INTERVAL '1' MINUTE)) AS minute FROM measured),
per_minute AS (
  SELECT spine.minute, coalesce(abnormal, 0) AS abnormal, coalesce(worst, 0) AS worst
  FROM spine LEFT JOIN (
    SELECT minute, count(*) FILTER (WHERE is_abnormal_hr) AS abnormal, max(lag_ms) AS worst
    FROM measured GROUP BY minute) m ON spine.minute = m.minute),
alarms AS (
  SELECT minute, abnormal, CASE WHEN abnormal >= 1 THEN 'ALARM' ELSE 'OK' END AS abnormal_state,
    CAST(sum(CASE WHEN worst > 60000 THEN 1 ELSE 0 END)
      OVER (ORDER BY minute ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS BIGINT) AS breaches
  FROM per_minute),
states AS (SELECT *, CASE WHEN breaches = 3 THEN 'ALARM' ELSE 'OK' END AS lagging_state FROM alarms)"""
)

# --- fixed question and answer texts ---------------------------------------------------------------

_Q1 = "Y a-t-il plus d''alertes critiques (BPM < 40) en semaine ou le week-end ?"
_Q2 = "Quel appareil déclenche le plus d''alertes critiques (BPM < 40) ?"
_Q3 = "À quelle heure de la journée le BPM moyen est-il le plus élevé ?"
_Q4 = "Quel appareil (porteur) a marché le plus de pas ?"

_ANSWER_1 = f"""SELECT '{_Q1}' AS question, CASE
    WHEN wd > we THEN concat('Il y a davantage en semaine (', wd, ' contre ', we, ' le week-end).')
    WHEN we > wd THEN concat('Il y a davantage le week-end (', we, ' contre ', wd, ' en semaine).')
    ELSE concat('Il y a autant en semaine qu''en week-end (', wd, ' chacun).') END AS answer
  FROM (SELECT count(*) FILTER (WHERE isodow(t) < 6) AS wd, count(*) FILTER (WHERE isodow(t) > 5) AS we
        FROM clean WHERE bpm < 40)"""
_ANSWER_2 = f"""SELECT '{_Q2}' AS question, coalesce(
    (SELECT concat('C''est ', device_id, ' avec ', count(*), ' alerte(s).') FROM clean WHERE bpm < 40
     GROUP BY device_id ORDER BY count(*) DESC, device_id LIMIT 1),
    'C''est aucun (pas d''alerte critique enregistrée).') AS answer"""
_ANSWER_3 = f"""SELECT '{_Q3}' AS question, coalesce(
    (SELECT printf('C''est à %02dh (BPM moyen : %.1f).', CAST(hour(t) AS INTEGER), avg(bpm)) FROM clean
     GROUP BY hour(t) ORDER BY avg(bpm) DESC, hour(t) LIMIT 1),
    'C''est à indéterminée (pas de données).') AS answer"""
_ANSWER_4 = f"""SELECT '{_Q4}' AS question, coalesce(
    (SELECT concat('C''est ', device_id, ' avec ', max(steps), ' pas.') FROM clean
     GROUP BY device_id ORDER BY max(steps) DESC, device_id LIMIT 1),
    'C''est indéterminé (pas de données).') AS answer"""

_BODY = (
    "concat('ALERTE CARDIAQUE DÉTECTÉE', chr(10), chr(10), 'Device ID  : ', device_id, chr(10),"
    " 'BPM        : ', bpm, chr(10), 'Horodatage : ',"
    " strftime(make_timestamp(timestamp * 1000000), '%Y-%m-%d %H:%M:%S'), chr(10),"
    " 'Position   : lat=', lat, ', lng=', lng, chr(10), chr(10), 'Action immédiate requise.')"
)

_ISO_UTC = (
    "(CASE WHEN epoch_us({t}) % 1000000 = 0 THEN strftime({t}, '%Y-%m-%dT%H:%M:%S+00:00')"
    " ELSE strftime({t}, '%Y-%m-%dT%H:%M:%S.%f+00:00') END)"
)
_ARRIVAL_TEXT = _ISO_UTC.format(t="arrival_ts")
_EVENT_TEXT = _ISO_UTC.format(t="event_time")

_LAST_168_HOURS = (
    "SELECT strftime(h, '%Y-%m-%d') AS dt, strftime(h, '%H') AS hour FROM (SELECT unnest(generate_series("
    "TIMESTAMP '2024-01-24 00:00:00', TIMESTAMP '2024-01-30 23:00:00', INTERVAL '1' HOUR)) AS h)"
)


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes}\n{select}"


def _transition(alarm: str, state: str) -> str:
    return f"""SELECT minute, before AS from_state, {state} AS to_state, '{alarm}' AS alarm
  FROM (SELECT minute, {state}, lag({state}, 1, 'OK') OVER (ORDER BY minute) AS before FROM states)
  WHERE {state} <> before"""


CHECK_SQL: dict[str, str] = {
    "gold_hourly": _with(_GOLD, "SELECT * FROM gold"),
    "decode_payload": _with(_RAW, "SELECT payload, sequence_number FROM raw"),
    "bronze_envelope": _with(
        _RAW,
        f"SELECT payload, partition_key, sequence_number, shard_id, {_ARRIVAL_TEXT} AS arrival_time,"
        " strftime(arrival_ts, '%Y-%m-%d') AS dt, strftime(arrival_ts, '%H') AS hour FROM raw",
    ),
    "hour_partitions": _with(
        _RAW,
        "SELECT sequence_number, strftime(arrival_ts, '%Y-%m-%d') AS dt, strftime(arrival_ts, '%H') AS hour FROM raw",
    ),
    "parse_readings": _with(_MESSAGES, f"SELECT * EXCLUDE (json) FROM parsed WHERE {_COMPLETE}"),
    "malformed_readings": _with(_MESSAGES, f"SELECT json FROM parsed WHERE NOT {_COMPLETE}"),
    "bronze_lenient_parse": _with(_MESSAGES, "SELECT * EXCLUDE (json) FROM parsed"),
    "critical_alerts": _with(
        _MESSAGES, f"SELECT device_id AS key, json AS value FROM parsed WHERE {_COMPLETE} AND bpm < 40"
    ),
    "alert_notifications": _with(
        _READINGS,
        "SELECT device_id, timestamp, concat('[vitals] ALERTE BPM critique — device ', device_id) AS subject,"
        f" {_BODY} AS body FROM readings WHERE bpm < 40",
    ),
    "clean_silver": _with(_CLEAN, "SELECT * EXCLUDE (t) FROM clean"),
    "parse_event_time": """SELECT event_id, CASE WHEN event_id % 7 IN (0, 5) THEN date_trunc('millisecond', ts)
  WHEN event_id % 7 = 6 THEN NULL ELSE date_trunc('second', ts) END AS event_time FROM events""",
    "validate_events": _with(
        _CLASSIFIED, "SELECT sequence_number, errors = '' AS valid, errors FROM classified"
    ),
    "quarantine_reasons": _with(
        _CLASSIFIED,
        "SELECT reason, count(*) AS rejected FROM (SELECT unnest(string_split(errors, '; ')) AS reason"
        " FROM classified WHERE errors <> '') GROUP BY reason",
    ),
    "route_counts": _with(
        _CLASSIFIED,
        "SELECT count(*) AS received, count(*) FILTER (WHERE errors = '') AS valid,"
        " count(*) FILTER (WHERE errors <> '') AS invalid,"
        " count(*) FILTER (WHERE errors = '' AND (heart_rate < 40 OR heart_rate > 180)) AS abnormal FROM classified",
    ),
    "custom_thresholds": _with(
        _SILVER,
        "SELECT CASE WHEN heart_rate < 50 THEN 'bradycardia' WHEN heart_rate > 150 THEN 'tachycardia'"
        " WHEN heart_rate < 100 THEN 'resting' WHEN heart_rate < 130 THEN 'light' ELSE 'moderate' END"
        " AS heart_rate_zone, count(*) AS events FROM silver GROUP BY 1",
    ),
    "heart_rate_zone": _with(
        _SILVER, "SELECT kinesis_sequence_number AS sequence_number, heart_rate, heart_rate_zone FROM silver"
    ),
    "spo2_status": _with(
        _SILVER, "SELECT kinesis_sequence_number AS sequence_number, spo2, spo2_status FROM silver"
    ),
    "enrich_silver": _with(_SILVER, "SELECT * FROM silver"),
    "abnormal_event_log": _with(
        _SILVER,
        "SELECT event_time, device_id, heart_rate, heart_rate_zone AS zone,"
        " concat('{\"level\":\"WARN\",\"type\":\"ABNORMAL_HEART_RATE\",\"device_id\":\"', device_id,"
        " '\",\"heart_rate\":', heart_rate, ',\"zone\":\"', heart_rate_zone, '\",\"event_time\":\"',"
        f" {_EVENT_TEXT}, '\"}}') AS line FROM silver WHERE is_abnormal_hr ORDER BY event_time DESC",
    ),
    "silver_hour_scan": _with(_SILVER, "SELECT * FROM silver WHERE dt = '2024-01-15' AND hour = '12'"),
    "union_silver_versions": _with(
        _SILVER,
        "SELECT event_id, kinesis_sequence_number, battery_low, dt,"
        " CASE WHEN dt >= '2024-01-15' THEN heart_rate_zone END AS heart_rate_zone,"
        " CASE WHEN dt >= '2024-01-15' THEN spo2_status END AS spo2_status FROM silver",
    ),
    "batch_lineage": _with(
        _CLASSIFIED,
        """SELECT layer, strftime(written, '%Y-%m-%d') AS dt, strftime(written, '%H') AS hour,
  ltrim(min(lpad(sequence_number, 64, '0')), '0') AS first_sequence,
  ltrim(max(lpad(sequence_number, 64, '0')), '0') AS last_sequence, count(*) AS records
FROM (SELECT 'bronze' AS layer, arrival_ts AS written, sequence_number FROM classified
  UNION ALL SELECT 'silver', event_time, sequence_number FROM classified WHERE errors = ''
  UNION ALL SELECT 'quarantine', arrival_ts, sequence_number FROM classified WHERE errors <> '') GROUP BY ALL""",
    ),
    "hours_to_process": _with(
        _SILVER,
        f"SELECT dt, hour, count(*) AS events FROM silver SEMI JOIN ({_LAST_168_HOURS}) USING (dt, hour) GROUP BY ALL",
    ),
    "gold_run_report": _with(
        _GOLD,
        f"""SELECT h.dt, h.hour, count(device_id) AS devices, CAST(coalesce(sum(event_count), 0) AS BIGINT) AS events
FROM ({_LAST_168_HOURS}) h LEFT JOIN gold ON gold.dt = h.dt AND gold.hour = h.hour GROUP BY ALL""",
    ),
    "retained_partitions": _with(
        _SILVER, "SELECT dt, hour, count(*) AS events FROM silver WHERE dt >= '2024-01-20' GROUP BY ALL"
    ),
    "dedupe_events": _with(
        _DEDUPED, "SELECT dt, hour, event_id, device_id, event_time, kinesis_sequence_number FROM deduped"
    ),
    "bpm_per_hour": _with(_LOCAL_GOLD, "SELECT device_id, hour, avg_bpm, max_bpm, min_bpm FROM bpm"),
    "steps_per_device_day": _with(_LOCAL_GOLD, "SELECT device_id, day, total_steps FROM day_steps"),
    "local_gold": _with(_LOCAL_GOLD, "SELECT * FROM local_gold"),
    "gold_with_calendar": _with(_LOCAL_GOLD, "SELECT * FROM dashboard"),
    "device_list": _with(_LOCAL_GOLD, "SELECT DISTINCT device_id FROM dashboard ORDER BY device_id"),
    "device_filter": _with(_LOCAL_GOLD, "SELECT * FROM dashboard WHERE device_id = 'device_007'"),
    "kpis": _with(
        _LOCAL_GOLD,
        "SELECT CAST(printf('%.1f', avg(avg_bpm)) AS DOUBLE) AS avg_bpm, max(max_bpm) AS max_bpm, min(min_bpm) AS min_bpm,"
        " (SELECT CAST(sum(total_steps) AS BIGINT) FROM device_day) AS total_steps FROM dashboard",
    ),
    "bpm_history": _with(
        _LOCAL_GOLD, "SELECT datetime, avg_bpm, max_bpm, min_bpm FROM dashboard ORDER BY datetime"
    ),
    "steps_per_day": _with(
        _LOCAL_GOLD, "SELECT day, CAST(sum(total_steps) AS BIGINT) AS total_steps FROM device_day GROUP BY day ORDER BY day"
    ),
    "alerts_per_device": _with(
        _CLEAN, "SELECT device_id, count(*) AS alerts FROM clean WHERE bpm < 40 GROUP BY device_id"
    ),
    "bpm_by_hour_of_day": _with(
        _CLEAN, "SELECT CAST(hour(t) AS INTEGER) AS hour_of_day, avg(bpm) AS avg_bpm FROM clean GROUP BY 1"
    ),
    "steps_leaderboard": _with(
        _CLEAN, "SELECT device_id, max(steps) AS total_steps FROM clean GROUP BY device_id"
    ),
    "weekday_vs_weekend": _with(_CLEAN, _ANSWER_1),
    "device_most_alerts": _with(_CLEAN, _ANSWER_2),
    "peak_hour": _with(_CLEAN, _ANSWER_3),
    "most_active_device": _with(_CLEAN, _ANSWER_4),
    "answers": _with(
        _CLEAN, f"{_ANSWER_1}\nUNION ALL {_ANSWER_2}\nUNION ALL {_ANSWER_3}\nUNION ALL {_ANSWER_4}"
    ),
    "latest_events": _with(
        _SILVER,
        "SELECT event_time, device_id, heart_rate, heart_rate_zone, steps, spo2, spo2_status, battery,"
        " end_to_end_latency_ms FROM silver WHERE dt = '2024-01-30'"
        f" ORDER BY event_time DESC, event_id, {_SEQUENCE} LIMIT 20",
    ),
    "hourly_device_metrics": _with(
        _GOLD,
        "SELECT dt, hour, device_id, event_count, avg_heart_rate, min_heart_rate, max_heart_rate,"
        " abnormal_hr_count, total_steps, avg_spo2, last_battery FROM gold WHERE dt >= '2024-01-29'"
        " ORDER BY dt DESC, hour DESC, device_id LIMIT 100",
    ),
    "abnormal_heart_rate": _with(
        _SILVER,
        "SELECT event_time, device_id, heart_rate, heart_rate_zone, spo2, spo2_status FROM silver"
        " WHERE dt >= '2024-01-29' AND is_abnormal_hr"
        f" ORDER BY event_time DESC, event_id, {_SEQUENCE} LIMIT 50",
    ),
    "device_leaderboard": _with(
        _GOLD,
        "SELECT device_id, CAST(sum(total_steps) AS BIGINT) AS steps_today,"
        " round(sum(avg_heart_rate * event_count) / sum(event_count), 1) AS avg_heart_rate,"
        " max(max_heart_rate) AS peak_heart_rate, CAST(sum(abnormal_hr_count) AS BIGINT) AS abnormal_events,"
        " min(min_spo2) AS lowest_spo2 FROM gold WHERE dt = '2024-01-30' GROUP BY device_id ORDER BY steps_today DESC",
    ),
    "data_quality": _with(
        _CLASSIFIED,
        """SELECT strftime(arrival_ts, '%Y-%m-%d') AS dt, strftime(arrival_ts, '%H') AS hour, count(*) AS received,
  count(*) FILTER (WHERE errors <> '') AS rejected,
  round(CAST(100 AS DOUBLE) * count(*) FILTER (WHERE errors <> '') / count(*), 2) AS rejected_pct,
  array_to_string(list_sort(list_distinct(flatten(list(string_split(errors, '; ')) FILTER (WHERE errors <> '')))), '; ') AS reasons
FROM classified WHERE strftime(arrival_ts, '%Y-%m-%d') = '2024-01-30' GROUP BY ALL ORDER BY hour DESC""",
    ),
    "needs_attention": _with(
        _SILVER,
        f"""SELECT device_id, event_time, battery, battery_low, spo2, spo2_status FROM (
  SELECT *, row_number() OVER (PARTITION BY device_id ORDER BY event_time DESC,
    lpad(kinesis_sequence_number, 64, '0') DESC) AS rn FROM silver WHERE dt = '2024-01-30')
WHERE rn = 1 AND (battery_low OR spo2_status <> 'normal') ORDER BY battery""",
    ),
    "metrics_per_minute": _with(
        _MEASURED,
        """SELECT minute, count(*) FILTER (WHERE is_valid) AS valid_events,
  count(*) FILTER (WHERE NOT is_valid) AS invalid_events,
  count(*) FILTER (WHERE is_abnormal_hr) AS abnormal_heart_rate,
  max(lag_ms) AS max_lag_ms,
  (SELECT string_agg(latency_ms || 'x' || n, ',' ORDER BY latency_ms) FROM (
    SELECT latency_ms, count(*) AS n FROM measured i WHERE i.is_valid AND i.minute = measured.minute GROUP BY latency_ms)) AS latencies
FROM measured GROUP BY minute""",
    ),
    "latency_percentiles": _with(
        _MEASURED,
        "SELECT minute, quantile_disc(latency_ms, 0.5) AS p50_ms, quantile_disc(latency_ms, 0.99) AS p99_ms"
        " FROM measured WHERE is_valid GROUP BY minute",
    ),
    "throughput_per_minute": _with(
        _MEASURED,
        """SELECT minute, CAST(sum(arrived) AS BIGINT) AS records_in, CAST(sum(done) AS BIGINT) AS records_processed,
  max(lag_ms) AS max_lag_ms
FROM (SELECT arrival_minute AS minute, 1 AS arrived, 0 AS done, CAST(NULL AS BIGINT) AS lag_ms FROM measured
  UNION ALL SELECT minute, 0, 1, lag_ms FROM measured) GROUP BY minute""",
    ),
    "alarm_abnormal_hr": _with(_MEASURED, "SELECT minute, abnormal_state AS state FROM states"),
    "alarm_lagging": _with(_MEASURED, "SELECT minute, breaches, lagging_state AS state FROM states"),
    "alarm_transitions": _with(
        _MEASURED,
        f"{_transition('abnormal_heart_rate', 'abnormal_state')}\nUNION ALL {_transition('lagging', 'lagging_state')}",
    ),
    "stream_alerts": _with(
        _MESSAGES, f"SELECT device_id AS key, json AS value FROM parsed WHERE {_COMPLETE} AND bpm < 40"
    ),
    "stream_gold": _with(_GOLD, "SELECT * FROM gold"),
    "stream_metrics": _with(
        _MEASURED,
        """SELECT minute, count(*) FILTER (WHERE is_valid) AS valid_events,
  count(*) FILTER (WHERE NOT is_valid) AS invalid_events,
  count(*) FILTER (WHERE is_abnormal_hr) AS abnormal_heart_rate, max(lag_ms) AS max_lag_ms,
  quantile_disc(latency_ms, 0.5) FILTER (WHERE is_valid) AS p50_ms,
  quantile_disc(latency_ms, 0.99) FILTER (WHERE is_valid) AS p99_ms,
  minute + INTERVAL '1' MINUTE <= (SELECT max(processed) FROM timed) - INTERVAL '1' MINUTE AS is_closed
FROM measured GROUP BY minute""",
    ),
    "stream_route": _with(
        _SILVER,
        """SELECT layer, strftime(written, '%Y-%m-%d') AS dt, strftime(written, '%H') AS hour, sequence_number, content
FROM (SELECT 'bronze' AS layer, arrival_ts AS written, sequence_number, payload AS content FROM classified
  UNION ALL SELECT 'silver', event_time, kinesis_sequence_number,
    concat_ws('|', event_id, device_id, heart_rate, steps, battery, heart_rate_zone) FROM silver
  UNION ALL SELECT 'quarantine', arrival_ts, sequence_number, errors FROM classified WHERE errors <> '')""",
    ),
    "stream_late_events": _with(
        _SILVER,
        f"""SELECT dt, hour, CASE WHEN closed THEN on_time ELSE 0 END AS emitted, late_events,
  CASE WHEN closed THEN 0 ELSE on_time END AS open
FROM (
  SELECT dt, hour, any_value(closed) AS closed, count(*) FILTER (WHERE on_time) AS on_time,
    count(*) FILTER (WHERE NOT on_time) AS late_events
  FROM (
    SELECT dt, hour, event_id, bool_or(hour_end > before) AS on_time, any_value(hour_end <= final) AS closed
    FROM (
      SELECT *, date_trunc('hour', event_time) + INTERVAL '1' HOUR AS hour_end,
        (arrival_time >= TIMESTAMP '{DELIVERIES[0]}')::INT + (arrival_time >= TIMESTAMP '{DELIVERIES[1]}')::INT AS delivery
      FROM silver) JOIN (
      SELECT delivery, coalesce(max(mark) OVER (ORDER BY delivery ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
          TIMESTAMP '0001-01-01') AS before, max(mark) OVER () AS final
      FROM (
        SELECT (arrival_time >= TIMESTAMP '{DELIVERIES[0]}')::INT + (arrival_time >= TIMESTAMP '{DELIVERIES[1]}')::INT AS delivery,
          max(event_time) - INTERVAL '1' HOUR AS mark FROM silver GROUP BY 1)) USING (delivery)
    GROUP BY dt, hour, event_id)
  GROUP BY dt, hour)""",
    ),
    "stored_metrics": _with(
        _MEASURED,
        """SELECT minute, count(*) FILTER (WHERE is_valid) AS valid_events,
  count(*) FILTER (WHERE NOT is_valid) AS invalid_events,
  count(*) FILTER (WHERE is_abnormal_hr) AS abnormal_heart_rate, max(lag_ms) AS max_lag_ms,
  quantile_disc(latency_ms, 0.5) FILTER (WHERE is_valid) AS p50_ms,
  quantile_disc(latency_ms, 0.99) FILTER (WHERE is_valid) AS p99_ms
FROM measured GROUP BY minute""",
    ),
    "alarm_refresh": _with(
        _MEASURED,
        """SELECT alarm, minute, breached, breaches, state,
  CASE WHEN state <> before THEN before END AS changed_from
FROM (
  SELECT *, lag(state, 1, 'OK') OVER (PARTITION BY alarm ORDER BY minute) AS before
  FROM (
    SELECT 'abnormal_heart_rate' AS alarm, minute, abnormal >= 1 AS breached, CAST(abnormal >= 1 AS BIGINT) AS breaches,
      abnormal_state AS state FROM states
    UNION ALL
    SELECT 'lagging', minute, worst > 60000, breaches, lagging_state FROM states JOIN per_minute USING (minute)))""",
    ),
    "compacted_events": _with(
        _RAW,
        """SELECT strftime(arrival_ts, '%Y-%m-%d') AS dt, strftime(arrival_ts, '%H') AS hour, sequence_number, payload,
  CAST(1 AS BIGINT) AS files FROM raw""",
    ),
}

# What stored tables hold is what the operators make that fill them.
CHECK_SQL |= {
    "stored_readings": CHECK_SQL["bronze_lenient_parse"],
    "stored_reading_gold": CHECK_SQL["gold_with_calendar"],
    "stored_answers": CHECK_SQL["answers"],
}
