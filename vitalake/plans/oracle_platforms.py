"""DuckDB oracle SQL for the Garmin, watch and Health Connect queries.

Straight on ``events``: the normaliser rules are written out per category
with the binding's values, with no JSON and no variant in between.
"""

from __future__ import annotations

from ..functions.dims import HC_EXERCISE_NAMES, HC_SAMPLE_TYPES
from ..sources.platform_bindings import HC_CLASSES, HC_EXERCISE_CODES, HC_INSTANT_CLASSES, HC_ZONES, HRV_STATUS_TEXT


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values) + "]"


PBASE = """
WITH pev AS (
  SELECT event_id, ts, user_id, event_type, value, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k,
         CAST(regexp_extract(props, '[0-9]+') AS INTEGER) // 10 AS j, date_trunc('second', ts) AS t0
  FROM events
)
"""

_G = """
g AS (
  SELECT 'garmin-' || CAST(user_id AS VARCHAR) AS device_id, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS day_ts,
         CAST(CAST(ts AS DATE) AS TIMESTAMP) + INTERVAL 31 HOUR AS ingested_at, epoch_ms(t0) AS ms,
         k % 10 AS cat, k, j, value, event_id, t0, ts
  FROM pev
),
m (cat, metric_type, unit) AS (VALUES
  (0, 'heart_rate_resting', 'bpm'), (0, 'steps_daily', 'count'), (0, 'calories_active', 'kcal'),
  (0, 'calories_total', 'kcal'), (0, 'vo2_max', 'ml/kg/min'), (0, 'floors_climbed', 'count'),
  (0, 'stress_avg', 'score'), (0, 'intensity_minutes', 'minutes'),
  (1, 'heart_rate_intraday', 'bpm'), (1, 'heart_rate_intraday_2', 'bpm'),
  (2, 'sleep_duration', 'minutes'), (2, 'sleep_deep', 'minutes'), (2, 'sleep_light', 'minutes'),
  (2, 'sleep_rem', 'minutes'), (2, 'sleep_awake', 'minutes'), (2, 'spo2_avg', 'pct'),
  (2, 'respiration_avg', 'brpm'), (2, 'sleep_score', 'score'),
  (3, 'stress_level', 'score'), (3, 'stress_level_2', 'score'),
  (4, 'hrv_weekly_avg', 'ms'), (4, 'hrv_last_night', 'ms'), (4, 'hrv_status', 'score'),
  (5, 'spo2', 'pct'), (6, 'body_battery_high', 'score'), (6, 'body_battery_low', 'score'),
  (8, 'respiration_rate', 'brpm'),
  (9, 'workout_duration', 'seconds'), (9, 'workout_distance', 'meters'), (9, 'workout_calories', 'kcal'),
  (9, 'workout_avg_hr', 'bpm'), (9, 'workout_max_hr', 'bpm'), (9, 'walk_duration', 'seconds')
),
gx AS (
  SELECT g.*, m.metric_type AS mt, m.unit FROM g JOIN m ON g.cat = m.cat
),
gv AS (
  SELECT device_id, ingested_at, unit, replace(replace(mt, '_2', ''), 'walk_duration', 'workout_duration') AS metric_type,
    CASE mt
      WHEN 'heart_rate_resting' THEN 50.0 + j WHEN 'steps_daily' THEN k * 100.0 WHEN 'calories_active' THEN value
      WHEN 'calories_total' THEN value + 1500 WHEN 'vo2_max' THEN CASE WHEN j % 3 <> 0 THEN 40.0 + j END
      WHEN 'floors_climbed' THEN j * 1.0 WHEN 'stress_avg' THEN (k % 50) * 1.0
      WHEN 'intensity_minutes' THEN CASE WHEN j % 2 = 0 THEN 0 ELSE j * 3 END + CASE WHEN j % 3 = 0 THEN 0 ELSE j END
      WHEN 'heart_rate_intraday' THEN 60.0 + j WHEN 'heart_rate_intraday_2' THEN CASE WHEN j % 2 = 1 THEN 70.0 + j END
      WHEN 'sleep_duration' THEN (25200 + k * 60) / 60.0 WHEN 'sleep_deep' THEN (3600 + j * 60) / 60.0
      WHEN 'sleep_light' THEN 180.0 WHEN 'sleep_rem' THEN (5400 + j * 30) / 60.0 WHEN 'sleep_awake' THEN j * 1.0
      WHEN 'spo2_avg' THEN 95.0 + j % 4 WHEN 'respiration_avg' THEN 14.5
      WHEN 'sleep_score' THEN CASE WHEN j % 5 <> 0 THEN 60.0 + j END
      WHEN 'stress_level' THEN 20.0 + j WHEN 'stress_level_2' THEN 40.0 + j
      WHEN 'hrv_weekly_avg' THEN 40.0 + j WHEN 'hrv_last_night' THEN 50.0 + j
      WHEN 'hrv_status' THEN CASE upper(""" + _list(HRV_STATUS_TEXT) + """[j % 4 + 1]) WHEN 'BALANCED' THEN 2.0
                                  WHEN 'UNBALANCED' THEN 1.0 WHEN 'LOW' THEN 0.0 ELSE -1.0 END
      WHEN 'spo2' THEN CASE WHEN j % 3 = 0 THEN 97.0 ELSE 90.0 + j END
      WHEN 'body_battery_high' THEN CASE WHEN j % 2 = 0 THEN 80.0 - j ELSE 90.0 - j END
      WHEN 'body_battery_low' THEN CASE WHEN j % 2 = 0 THEN 30.0 + j ELSE 10.0 + j END
      WHEN 'respiration_rate' THEN CASE WHEN j % 2 = 0 THEN 13.0 ELSE 15.0 + j END
      WHEN 'workout_duration' THEN k * 60.0 WHEN 'workout_distance' THEN k * 100.0 WHEN 'workout_calories' THEN value
      WHEN 'workout_avg_hr' THEN 120.0 + j WHEN 'workout_max_hr' THEN 160.0 + j
      WHEN 'walk_duration' THEN CASE WHEN j % 2 = 1 THEN 600.0 END
    END AS value,
    CASE WHEN mt IN ('heart_rate_intraday', 'stress_level') THEN t0
         WHEN mt = 'heart_rate_intraday_2' THEN t0 + INTERVAL 60 SECOND
         WHEN mt = 'stress_level_2' THEN t0 + INTERVAL 540 SECOND
         WHEN cat = 9 THEN t0 ELSE day_ts END AS recorded_at,
    CASE WHEN mt = 'intensity_minutes' THEN
           '{"moderate":"' || CAST(CASE WHEN j % 2 = 0 THEN 0 ELSE j * 3 END AS VARCHAR) || '","vigorous":"'
           || CAST(CASE WHEN j % 3 = 0 THEN 0 ELSE j END AS VARCHAR) || '"}'
         WHEN mt = 'hrv_status' THEN '{"status_label":"' || """ + _list(HRV_STATUS_TEXT) + """[j % 4 + 1] || '"}'
         WHEN mt = 'walk_duration' THEN '{"activity_type":"unknown","activity_name":"","activity_id":"'
           || CAST(event_id * 10 AS VARCHAR) || '"}'
         WHEN cat = 9 THEN '{"activity_type":"running","activity_name":"Run","activity_id":"'
           || CAST(event_id AS VARCHAR) || '"}'
    END AS metadata_json
  FROM gx
)
"""

GARMIN_EVENTS = PBASE + "," + _G + """
SELECT 'garmin_connect' AS source, device_id, metric_type, value, unit, recorded_at, ingested_at, metadata_json
FROM gv WHERE value IS NOT NULL
  AND NOT (metric_type = 'intensity_minutes' AND value = 0)"""

_CATS = _list(["daily_stats", "heart_rates", "sleep", "stress", "hrv", "spo2", "body_battery", "steps",
               "respiration", "activities"])

GARMIN_BRONZE_ROWS = PBASE + f"""
SELECT 'g' || CAST(event_id AS VARCHAR) || '-' || {_CATS}[k % 10 + 1] AS record_id,
       CAST(CAST(ts AS DATE) AS TIMESTAMP) + INTERVAL 31 HOUR AS ingested_at, {_CATS}[k % 10 + 1] AS record_type,
       CAST(NULL AS VARCHAR) AS source_platform, CAST(NULL AS VARCHAR) AS user_id, 'garmin_connect' AS platform,
       'garmin-' || CAST(user_id AS VARCHAR) AS device_id, strftime(ts, '%Y-%m-%d') AS day
FROM pev"""

GARMIN_DAILY_VIEW = PBASE + """
SELECT strftime(ts, '%Y-%m-%d') AS day, CAST(50 + j AS INTEGER) AS resting_hr, CAST(k * 100 AS INTEGER) AS steps,
       CAST(trunc(value + 1500) AS INTEGER) AS total_calories, CAST(trunc(value) AS INTEGER) AS active_calories,
       CAST(j AS INTEGER) AS floors, CAST(k % 50 AS INTEGER) AS avg_stress,
       CASE WHEN j % 3 <> 0 THEN CAST(40 + j AS DOUBLE) END AS vo2_max
FROM pev WHERE k % 10 = 0"""

GARMIN_SLEEP_VIEW = PBASE + """
SELECT strftime(ts, '%Y-%m-%d') AS day, CAST(round(CAST((25200 + k * 60) / 3600.0 AS DECIMAL(38,10)), 1) AS DOUBLE) AS sleep_hours,
       CAST(round(CAST((3600 + j * 60) / 60.0 AS DECIMAL(38,10)), 0) AS DOUBLE) AS deep_min, 180.0::DOUBLE AS light_min,
       CAST(round(CAST((5400 + j * 30) / 60.0 AS DECIMAL(38,10)), 0) AS DOUBLE) AS rem_min,
       CASE WHEN j % 5 <> 0 THEN CAST(60 + j AS INTEGER) END AS sleep_score
FROM pev WHERE k % 10 = 2"""

GARMIN_HRV_VIEW = PBASE + f"""
SELECT strftime(ts, '%Y-%m-%d') AS day, CAST(40 + j AS DOUBLE) AS hrv_weekly_avg_ms, CAST(50 + j AS DOUBLE) AS hrv_last_night_ms,
       {_list(HRV_STATUS_TEXT)}[j % 4 + 1] AS hrv_status
FROM pev WHERE k % 10 = 4"""

_W = """
w AS (
  SELECT 'garmin_connect_iq' AS source, 'watch-' || CAST(user_id AS VARCHAR) AS device_id, r.metric_type,
         r.value, r.unit, r.recorded_at, ts + INTERVAL 5 MINUTE AS ingested_at, CAST(NULL AS VARCHAR) AS metadata_json
  FROM pev, LATERAL (VALUES
      ('heart_rate_intraday', CAST(60 + j AS DOUBLE), 'bpm', t0),
      ('stress_level', CAST(CASE WHEN k % 3 = 0 THEN 127 ELSE j * 5 END AS DOUBLE), 'score', t0 - INTERVAL 1 MINUTE),
      ('body_battery_current', CAST(50 + j AS DOUBLE), 'score', t0 - INTERVAL 2 MINUTE),
      ('steps_intraday', CAST(k * 10 AS DOUBLE), 'count', t0)) AS r(metric_type, value, unit, recorded_at)
  WHERE NOT (r.metric_type = 'stress_level' AND r.value = 127)
)
"""

WATCH_EVENTS = PBASE + "," + _W + "SELECT * FROM w"
WATCH_INCREMENTAL = PBASE + "," + _W + """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY device_id, metric_type ORDER BY recorded_at DESC, value DESC) AS rn
  FROM w WHERE recorded_at > TIMESTAMP '2024-01-15 00:00:00') WHERE rn <= {cap}"""

_UNITS = dict((c, u) for c, _t, u in HC_SAMPLE_TYPES)
_HC = f"""
h AS (
  SELECT 'a' || CAST(event_id AS VARCHAR) AS record_id, ts + to_hours(CAST(event_id % 5 AS BIGINT)) AS ingested_at,
         'u' || CAST(user_id AS VARCHAR) AS user_id, 'h' || CAST(event_id AS VARCHAR) AS hid, event_type, k, j, t0,
         value, event_id, ts,
         {_list(HC_CLASSES)}[k % {len(HC_CLASSES)} + 1] AS cls,
         CASE WHEN k % 2 = 1 THEN '-08:00' ELSE '+00:00' END AS zone_offset
  FROM pev
)
"""

HC_SAMPLES = PBASE + "," + _HC + f"""
, hs AS (
  SELECT record_id, ingested_at, user_id, hid AS hk_uuid, cls AS hk_type, value, t0 AS start_at,
         CASE WHEN cls IN {tuple(HC_INSTANT_CLASSES)} THEN t0 ELSE t0 + to_minutes(CAST(k AS BIGINT)) END AS end_at,
         'com.google.android.apps.fitness' AS source_name, zone_offset
  FROM h WHERE event_type = 'view' AND cls NOT IN ('HeartRateRecord', 'NutritionRecord')
  UNION ALL
  SELECT record_id, ingested_at, user_id, hid || '-' || CAST(i AS VARCHAR), cls, CAST(60 + i + j AS DOUBLE),
         t0 + to_minutes(CAST(i AS BIGINT)), t0 + to_minutes(CAST(i AS BIGINT)),
         'com.google.android.apps.fitness', zone_offset
  FROM h, range(0, 3) AS r(i) WHERE event_type = 'view' AND cls = 'HeartRateRecord' AND i <= k % 3
),
hk AS (
  SELECT record_id, ingested_at, user_id, hk_uuid, hk_type,
         CASE hk_type {' '.join(f"WHEN '{c}' THEN '{u}'" for c, u in _UNITS.items())} END AS hk_unit,
         value, start_at, end_at, source_name, zone_offset FROM hs
)
"""

_HC_NAMES = "CASE code " + " ".join(f"WHEN {c} THEN '{n}'" for c, n in HC_EXERCISE_NAMES) + \
            " ELSE 'unknown_' || CAST(code AS VARCHAR) END"

HC_WORKOUTS = PBASE + "," + _HC + f"""
, hw AS (SELECT *, CAST({_list(HC_EXERCISE_CODES)}[k % {len(HC_EXERCISE_CODES)} + 1] AS BIGINT) AS code
         FROM h WHERE event_type = 'click')
SELECT record_id, ingested_at, user_id, hid AS workout_uuid, {_HC_NAMES} AS activity_type, code AS activity_type_raw,
       t0 AS start_at, t0 + to_minutes(CAST(k AS BIGINT)) AS end_at, CAST(k * 60.0 AS DOUBLE) AS duration_seconds,
       CAST(NULL AS DOUBLE) AS total_energy_burned_kcal, CAST(NULL AS DOUBLE) AS total_distance_meters,
       'com.google.android.apps.fitness' AS source_name
FROM hw"""

HC_SLEEP_STAGES = PBASE + "," + _HC + """
SELECT record_id AS sleep_record_id, ingested_at, user_id, t0 AS session_start_at,
       t0 + to_minutes(CAST(260 + k % 20 AS BIGINT)) AS session_end_at,
       sha256(record_id || '|' || p.stage || '|' || strftime(t0 + to_minutes(CAST(p.a AS BIGINT)), '%Y-%m-%dT%H:%M:%SZ'))
         AS stage_uuid,
       p.stage AS sleep_stage, t0 + to_minutes(CAST(p.a AS BIGINT)) AS stage_start_at,
       t0 + to_minutes(CAST(COALESCE(p.b, 260 + k % 20) AS BIGINT)) AS stage_end_at
FROM h, (VALUES ('light', 0, 120), ('deep', 120, 200), ('rem', 200, 260), ('awake', 260, NULL)) AS p(stage, a, b)
WHERE event_type = 'signup'"""

HC_DAILY = PBASE + "," + _HC + f"""
SELECT record_id, ingested_at, user_id, CAST(ts AS DATE) AS summary_date, {_list(HC_ZONES)}[k % 3 + 1] AS timezone,
       CAST(k * 100 AS BIGINT) AS total_steps, value AS active_calories_burned_kcal,
       CAST(k * 50.0 AS DOUBLE) AS total_distance_meters, CASE WHEN k % 2 = 0 THEN k / 2.0 END AS exercise_duration_minutes
FROM h WHERE event_type = 'purchase'"""

HC_DELETES = PBASE + "," + _HC + """
SELECT record_id, ingested_at, user_id, 'h' || CAST(event_id - 1 AS VARCHAR) AS deleted_uuid, cls AS deleted_sample_type
FROM h WHERE event_type = 'error'"""

HC_DAILY_FROM_SAMPLES = HC_SAMPLES + """
, hz AS (
  SELECT user_id, zone_offset AS zone,
         CAST(CASE WHEN zone_offset = '-08:00' THEN start_at - INTERVAL 8 HOUR ELSE start_at END AS DATE) AS day,
         hk_type, value
  FROM hk WHERE hk_type IN ('StepsRecord', 'ActiveCaloriesBurnedRecord', 'DistanceRecord')
),
sums AS (
  SELECT user_id, zone, day,
         sum(CASE WHEN hk_type = 'StepsRecord' THEN value ELSE 0.0 END) AS total_steps,
         sum(CASE WHEN hk_type = 'ActiveCaloriesBurnedRecord' THEN value ELSE 0.0 END) AS active_calories_burned_kcal,
         sum(CASE WHEN hk_type = 'DistanceRecord' THEN value ELSE 0.0 END) AS total_distance_meters
  FROM hz GROUP BY 1, 2, 3
),
span AS (
  SELECT user_id, zone, CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day
  FROM sums GROUP BY 1, 2
)
SELECT s.user_id, s.zone, s.day, coalesce(x.total_steps, 0.0) AS total_steps,
       coalesce(x.active_calories_burned_kcal, 0.0) AS active_calories_burned_kcal,
       coalesce(x.total_distance_meters, 0.0) AS total_distance_meters
FROM span s LEFT JOIN sums x ON s.user_id = x.user_id AND s.zone = x.zone AND s.day = x.day"""


def _cross_platform() -> str:
    from .oracle import BASE
    hc_ctes = HC_SAMPLES.strip()[len("WITH "):]
    return (BASE + "," + hc_ctes + """
SELECT *, 'apple_healthkit' AS platform FROM samples
UNION ALL
SELECT * EXCLUDE (zone_offset), 'android_health_connect' AS platform FROM hk""")


GARMIN_RECORD_SPANS = PBASE + f"""
SELECT {_CATS}[k % 10 + 1] AS record_type, count(*) AS cnt, min(strftime(ts, '%Y-%m-%d')) AS earliest,
       max(strftime(ts, '%Y-%m-%d')) AS latest
FROM pev GROUP BY 1"""


def platform_oracles() -> dict[str, str]:
    return {
        "garmin_record_spans": GARMIN_RECORD_SPANS,
        "samples_all_platforms": _cross_platform(),
        "garmin_events": GARMIN_EVENTS,
        "garmin_bronze_rows": GARMIN_BRONZE_ROWS,
        "garmin_daily_view": GARMIN_DAILY_VIEW,
        "watch_events": WATCH_EVENTS,
        "watch_incremental": WATCH_INCREMENTAL.format(cap=10**9),
        "watch_incremental_capped": WATCH_INCREMENTAL.format(cap=5),
        "garmin_sleep_view": GARMIN_SLEEP_VIEW,
        "garmin_hrv_view": GARMIN_HRV_VIEW,
        "hc_samples": HC_SAMPLES + "SELECT * FROM hk",
        "hc_workouts": HC_WORKOUTS,
        "hc_sleep_stages": HC_SLEEP_STAGES,
        "hc_daily_summaries": HC_DAILY,
        "hc_deletes": HC_DELETES,
        "hc_daily_from_samples": HC_DAILY_FROM_SAMPLES,
    }
