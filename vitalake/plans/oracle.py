"""DuckDB oracle SQL for the registered queries.

Written straight on the driver's ``events`` table -- no JSON, no variant --
so it checks the Spark path (binding -> variant bronze -> silver ->
gold) against an independent derivation of the same rows.  The shared CTE
block derives bronze keys and the six silver tables; each query appends
its own final SELECT.

Rounding: Spark rounds a DOUBLE half-up on its decimal text, DuckDB on the
binary value; ``rnd()`` casts to DECIMAL first so both agree.
"""

from __future__ import annotations

import datetime as _dt

from ..sources.bindings import SAMPLE_TYPES, WORKOUT_CODES
from ..functions.dims import HK_CANONICAL_UNITS, HK_WORKOUT_NAMES

AS_OF = "2024-01-31"
AS_OF_TS = "2024-02-01 00:00:00"


def as_of(days: int) -> str:
    """A day whose window of ``days`` days begins on 2024-01-15, inside the data: the filter has rows to drop."""
    return str(_dt.date(2024, 1, 15) + _dt.timedelta(days=days))


APP_START, APP_END = "2024-01-08", "2024-01-28"


def rnd(expr: str, digits: int) -> str:
    return f"CAST(round(CAST({expr} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values) + "]"


_TYPES = _list([t for t, _ in SAMPLE_TYPES])
_UNITS = _list([u for _, u in SAMPLE_TYPES])
_WNAMES = _list([dict(HK_WORKOUT_NAMES)[c] for c in WORKOUT_CODES])
_WCODES = _list(WORKOUT_CODES)

BASE = f"""
WITH ev AS (
  SELECT event_id, ts, user_id, event_type, value, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k
  FROM events WHERE event_type IN ('view', 'click', 'signup', 'purchase', 'error')
),
landed AS (
  SELECT *, 0 AS copy_no FROM ev
  UNION ALL
  SELECT *, 1 AS copy_no FROM ev WHERE event_id % 20 = 0
),
bronze AS (
  SELECT 'r' || CAST(event_id AS VARCHAR) || CASE WHEN copy_no = 1 THEN '-d' ELSE '' END AS record_id,
         ts + to_hours(CAST(event_id % 7 + copy_no AS BIGINT)) AS ingested_at,
         CASE event_type WHEN 'view' THEN 'samples' WHEN 'click' THEN 'workouts' WHEN 'signup' THEN 'sleep'
              WHEN 'purchase' THEN 'activity_summaries' ELSE 'deletes' END AS record_type,
         'apple_healthkit' AS source_platform,
         'u' || CAST(user_id AS VARCHAR) AS user_id,
         CASE WHEN k < 10 THEN 'demo-notebook-seed' ELSE 'dev' || CAST(user_id AS VARCHAR) END AS device_id,
         CASE WHEN k >= 20 THEN CASE WHEN k % 2 = 0 THEN 'notebook_simulator' ELSE 'rest_app' END END AS channel,
         event_id, ts, value, k
  FROM landed
),
s_raw AS (
  SELECT record_id, ingested_at, user_id, 'e' || CAST(event_id AS VARCHAR) AS hk_uuid,
         {_TYPES}[k % 12 + 1] AS hk_type, {_UNITS}[k % 12 + 1] AS hk_unit, value,
         CASE WHEN k % 3 = 1 THEN date_trunc('millisecond', ts) ELSE date_trunc('second', ts) END AS start_at,
         CASE WHEN k % 3 = 1 THEN date_trunc('millisecond', ts) ELSE date_trunc('second', ts) END
           + to_minutes(CAST(k AS BIGINT)) AS end_at,
         'Apple Watch' AS source_name
  FROM bronze WHERE record_type = 'samples'
),
samples AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY hk_uuid ORDER BY ingested_at, record_id) AS rn FROM s_raw) WHERE rn = 1
),
w_raw AS (
  SELECT record_id, ingested_at, user_id, 'e' || CAST(event_id AS VARCHAR) AS workout_uuid,
         {_WNAMES}[k % 4 + 1] AS activity_type, CAST({_WCODES}[k % 4 + 1] AS BIGINT) AS activity_type_raw,
         date_trunc('second', ts) AS start_at, date_trunc('second', ts) + to_seconds(CAST(k * 60 AS BIGINT)) AS end_at,
         CAST(k * 60 AS DOUBLE) AS duration_seconds, value AS total_energy_burned_kcal,
         CASE WHEN k % 5 <> 0 THEN CAST(k * 100 AS DOUBLE) END AS total_distance_meters,
         'Apple Watch' AS source_name
  FROM bronze WHERE record_type = 'workouts'
),
workouts AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY workout_uuid ORDER BY ingested_at, record_id) AS rn FROM w_raw)
  WHERE rn = 1
),
sl AS (
  SELECT record_id AS sleep_record_id, ingested_at, user_id, date_trunc('second', ts) AS t0, k, event_id
  FROM bronze WHERE record_type = 'sleep'
),
st_raw AS (
  SELECT sleep_record_id, ingested_at, user_id, t0 AS session_start_at,
         t0 + to_minutes(CAST(200 + k % 30 AS BIGINT)) AS session_end_at,
         p.i, p.stage, t0 + to_minutes(CAST(p.a AS BIGINT)) AS stage_start_at,
         t0 + to_minutes(CAST(COALESCE(p.b, 200 + k % 30) AS BIGINT)) AS stage_end_at, k, event_id
  FROM sl, (VALUES (0, 'asleepCore', 0, 90), (1, 'asleepDeep', 90, 150), (2, 'asleepREM', 150, 200),
                   (3, 'awake', 200, NULL)) AS p(i, stage, a, b)
),
st_keyed AS (
  SELECT sleep_record_id, ingested_at, user_id, session_start_at, session_end_at,
         CASE WHEN k % 10 = 0
              THEN sha256(sleep_record_id || '|' || stage || '|' || strftime(stage_start_at, '%Y-%m-%dT%H:%M:%SZ'))
              ELSE 's' || CAST(event_id AS VARCHAR) || '-' || CAST(i AS VARCHAR) END AS stage_uuid,
         stage AS sleep_stage, stage_start_at, stage_end_at
  FROM st_raw
),
sleep_stages AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY stage_uuid ORDER BY ingested_at, sleep_record_id) AS rn FROM st_keyed)
  WHERE rn = 1
),
rings AS (
  SELECT record_id, ingested_at, user_id, CAST(ts AS DATE) AS summary_date, value AS active_energy_burned_kcal,
         CASE WHEN k % 8 = 0 THEN 0.0 ELSE 500.0 END::DOUBLE AS active_energy_burned_goal_kcal,
         CAST(k AS DOUBLE) AS exercise_minutes, 30.0::DOUBLE AS exercise_minutes_goal,
         CAST(k % 16 AS BIGINT) AS stand_hours, CAST(12 AS BIGINT) AS stand_hours_goal
  FROM bronze WHERE record_type = 'activity_summaries'
),
deletes AS (
  SELECT record_id, ingested_at, user_id, 'e' || CAST(event_id - 1 AS VARCHAR) AS deleted_uuid,
         {_TYPES}[k % 12 + 1] AS deleted_sample_type
  FROM bronze WHERE record_type = 'deletes'
),
ev_raw AS (
  SELECT record_id, ingested_at, 'samples' AS record_type, user_id, hk_uuid AS event_id, hk_type AS metric_type,
         start_at AS effective_time, value AS value_number FROM s_raw
  UNION ALL
  SELECT record_id, ingested_at, 'workouts', user_id, workout_uuid, activity_type, start_at, duration_seconds FROM w_raw
  UNION ALL
  SELECT sleep_record_id, ingested_at, 'sleep', user_id, sleep_record_id, 'sleep', t0, CAST(NULL AS DOUBLE) FROM sl
  UNION ALL
  SELECT record_id, ingested_at, 'activity_summaries', user_id, record_id, 'activity_summary', ingested_at,
         active_energy_burned_kcal FROM rings
  UNION ALL
  SELECT record_id, ingested_at, 'deletes', user_id, deleted_uuid, deleted_sample_type, ingested_at,
         CAST(NULL AS DOUBLE) FROM deletes
),
events_silver AS (
  SELECT record_id, ingested_at, record_type, 'apple_healthkit' AS source_platform, user_id, event_id,
         user_id AS subject_id, metric_type, effective_time, value_number
  FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ingested_at, record_id) AS rn FROM ev_raw)
  WHERE rn = 1
),
hk_daily AS (
  SELECT user_id, hk_type, CAST(start_at AS DATE) AS day, avg(value) AS avg_value, min(value) AS min_value,
         max(value) AS max_value, count(*) AS sample_rows
  FROM samples WHERE hk_type IS NOT NULL AND value IS NOT NULL GROUP BY 1, 2, 3
),
subject_daily AS (
  SELECT subject_id, metric_type, CAST(effective_time AS DATE) AS day, avg(value_number) AS avg_value_number,
         min(value_number) AS min_value_number, max(value_number) AS max_value_number, count(*) AS event_count
  FROM events_silver WHERE value_number IS NOT NULL GROUP BY 1, 2, 3
),
daily_steps AS (
  SELECT user_id, CAST(start_at AS DATE) AS day, sum(value) AS total_steps, count(*) AS sample_intervals
  FROM samples WHERE hk_type LIKE '%StepCount%' AND value IS NOT NULL GROUP BY 1, 2
),
enriched AS (
  SELECT r.user_id, r.summary_date AS day, r.active_energy_burned_kcal, r.active_energy_burned_goal_kcal,
         {rnd("r.active_energy_burned_kcal / nullif(r.active_energy_burned_goal_kcal, 0)", 3)} AS move_ring_ratio,
         r.exercise_minutes, r.exercise_minutes_goal,
         {rnd("r.exercise_minutes / nullif(r.exercise_minutes_goal, 0)", 3)} AS exercise_ring_ratio,
         CAST(r.stand_hours AS DOUBLE) AS stand_hours, CAST(r.stand_hours_goal AS DOUBLE) AS stand_hours_goal,
         {rnd("CAST(r.stand_hours AS DOUBLE) / nullif(r.stand_hours_goal, 0)", 3)} AS stand_ring_ratio,
         s.total_steps, s.sample_intervals
  FROM rings r LEFT JOIN daily_steps s ON r.user_id = s.user_id AND r.summary_date = s.day
),
sleep_nightly AS (
  SELECT user_id, CAST(session_start_at AS DATE) AS sleep_night,
         sum(CASE WHEN sleep_stage = 'asleepDeep' THEN m ELSE 0.0 END) AS deep_sleep_min,
         sum(CASE WHEN sleep_stage = 'asleepREM' THEN m ELSE 0.0 END) AS rem_sleep_min,
         sum(CASE WHEN sleep_stage = 'asleepCore' THEN m ELSE 0.0 END) AS core_sleep_min,
         sum(CASE WHEN sleep_stage = 'awake' THEN m ELSE 0.0 END) AS awake_min,
         sum(CASE WHEN sleep_stage = 'inBed' THEN m ELSE 0.0 END) AS in_bed_min,
         sum(m) AS total_tracked_min, count(DISTINCT sleep_record_id) AS sleep_sessions
  FROM (SELECT *, CAST(date_diff('second', stage_start_at, stage_end_at) AS DOUBLE) / 60.0 AS m FROM sleep_stages
        WHERE stage_start_at IS NOT NULL AND stage_end_at IS NOT NULL)
  GROUP BY 1, 2
),
weekly AS (
  SELECT user_id, date_trunc('week', start_at) AS week_start, count(*) AS workout_count,
         sum(duration_seconds / 60.0) AS total_duration_min, sum(total_energy_burned_kcal) AS total_energy_kcal,
         sum(total_distance_meters) AS total_distance_m,
         sum(total_distance_meters) / nullif(sum(duration_seconds), 0.0) AS avg_speed_m_per_s,
         count(DISTINCT activity_type) AS distinct_activity_types
  FROM workouts WHERE start_at IS NOT NULL GROUP BY 1, 2
),
cardio AS (
  SELECT user_id, CAST(start_at AS DATE) AS day,
         avg(CASE WHEN hk_type LIKE '%RestingHeartRate%' THEN value END) AS resting_hr_avg,
         avg(CASE WHEN hk_type LIKE '%HeartRateVariability%' THEN value END) AS hrv_sdnn_avg,
         avg(CASE WHEN hk_type LIKE '%OxygenSaturation%' THEN value END) AS spo2_avg,
         avg(CASE WHEN hk_type LIKE '%HeartRate%' AND hk_type NOT LIKE '%Resting%' THEN value END) AS heart_rate_avg,
         max(CASE WHEN hk_type LIKE '%HeartRate%' AND hk_type NOT LIKE '%Resting%' THEN value END) AS heart_rate_max
  FROM samples
  WHERE start_at IS NOT NULL AND (hk_type LIKE '%RestingHeartRate%' OR hk_type LIKE '%HeartRateVariability%'
        OR hk_type LIKE '%OxygenSaturation%' OR (hk_type LIKE '%HeartRate%' AND hk_type NOT LIKE '%Resting%'))
  GROUP BY 1, 2
),
hr_intraday AS (
  SELECT user_id, CAST(start_at AS DATE) AS day, avg(value) AS avg_hr, min(value) AS min_hr, max(value) AS max_hr,
         count(*) AS reading_count
  FROM samples WHERE hk_type LIKE '%HeartRate%' AND hk_type NOT LIKE '%Resting%' AND value IS NOT NULL
  GROUP BY 1, 2
),
ingest_daily AS (
  SELECT CAST(ingested_at AS DATE) AS ingest_day, user_id, record_type, count(*) AS row_count FROM bronze GROUP BY 1, 2, 3
),
family_weekly AS (
  SELECT user_id, date_trunc('week', start_at) AS week_start,
         CASE WHEN hk_type LIKE '%StepCount%' THEN 'steps' WHEN hk_type LIKE '%ActiveEnergy%' THEN 'active_energy'
              WHEN hk_type LIKE '%DistanceWalking%' THEN 'distance' WHEN hk_type LIKE '%HeartRate%' THEN 'heart_rate'
              WHEN hk_type LIKE '%OxygenSaturation%' THEN 'spo2' WHEN hk_type LIKE '%FlightsClimbed%' THEN 'flights'
              ELSE 'other' END AS metric_family,
         avg(value) AS avg_value, sum(value) AS sum_value, count(*) AS readings
  FROM samples WHERE value IS NOT NULL GROUP BY 1, 2, 3
)
"""


def _win(col: str) -> str:
    return f"{col} BETWEEN DATE '{APP_START}' AND DATE '{APP_END}' AND user_id LIKE '%'"


FINAL = {
    "silver_events": "SELECT * FROM events_silver",
    "silver_samples": "SELECT * FROM samples",
    "silver_workouts": "SELECT * FROM workouts",
    "silver_sleep_stages": "SELECT * FROM sleep_stages",
    "silver_rings": "SELECT * FROM rings",
    "silver_deletes": "SELECT * FROM deletes",
    "g_hk_daily": "SELECT * FROM hk_daily",
    "g_subject_daily": "SELECT * FROM subject_daily",
    "g_daily_steps": "SELECT * FROM daily_steps",
    "g_activity_enriched": "SELECT * FROM enriched",
    "g_sleep_nightly": "SELECT * FROM sleep_nightly",
    "g_weekly_workouts": "SELECT * FROM weekly",
    "g_cardio_vitals": "SELECT * FROM cardio",
    "g_hr_intraday": "SELECT * FROM hr_intraday",
    "g_ingest_daily": "SELECT * FROM ingest_daily",
    "g_family_weekly": "SELECT * FROM family_weekly",
    "vw_activity_45d": f"SELECT * FROM enriched WHERE day >= DATE '{as_of(45)}' - INTERVAL 45 DAY",
    "vw_sleep_30": """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY user_id
                      ORDER BY sleep_night DESC) AS rn FROM sleep_nightly) WHERE rn <= 30""",
    "vw_sleep_5": """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY user_id
                      ORDER BY sleep_night DESC) AS rn FROM sleep_nightly) WHERE rn <= 5""",
    "vw_workouts_12w": f"SELECT * FROM weekly WHERE week_start >= DATE '{as_of(84)}' - INTERVAL 84 DAY",
    "dash_01_ingest_overview": """SELECT CAST(ingested_at AS DATE) AS ingest_day, record_type, source_platform,
                                  count(*) AS row_count FROM bronze GROUP BY 1, 2, 3""",
    "dash_02_hk_quantity_30d": f"""SELECT day, user_id, replace(hk_type, 'HKQuantityTypeIdentifier', '') AS metric_short,
                                   avg_value, min_value, max_value, sample_rows FROM hk_daily
                                   WHERE day >= DATE '{as_of(30)}' - INTERVAL 30 DAY""",
    "dash_03_recent_workouts": f"""SELECT start_at, user_id, activity_type, {rnd('duration_seconds / 60', 1)} AS duration_min,
                                   total_energy_burned_kcal, {rnd('total_distance_meters / 1000', 2)} AS distance_km,
                                   ingested_at FROM workouts
                                   WHERE start_at >= TIMESTAMP '{AS_OF_TS}' - INTERVAL 14 DAY
                                   ORDER BY start_at DESC, user_id, activity_type, duration_min,
                                            total_energy_burned_kcal, distance_km NULLS LAST, ingested_at
                                   LIMIT 200""",
    "dash_04_sleep_stage_minutes": f"""SELECT user_id, CAST(session_start_at AS DATE) AS sleep_night, sleep_stage,
                                       {rnd("sum(CAST(date_diff('second', stage_start_at, stage_end_at) AS DOUBLE) / 60.0)", 1)}
                                       AS stage_minutes FROM sleep_stages
                                       WHERE stage_start_at IS NOT NULL AND stage_end_at IS NOT NULL GROUP BY 1, 2, 3""",
    "dash_05_ring_adherence": f"""SELECT summary_date, user_id, active_energy_burned_kcal, active_energy_burned_goal_kcal,
                                  {rnd('active_energy_burned_kcal / nullif(active_energy_burned_goal_kcal, 0)', 2)}
                                  AS move_ring_ratio, exercise_minutes, exercise_minutes_goal, stand_hours,
                                  stand_hours_goal FROM rings WHERE summary_date >= DATE '{as_of(30)}' - INTERVAL 30 DAY""",
    "dash_06_silver_gold_volumes": """
        SELECT 'silver_events' AS dataset, count(*) AS row_count FROM events_silver
        UNION ALL SELECT 'silver_samples', count(*) FROM samples
        UNION ALL SELECT 'silver_workouts', count(*) FROM workouts
        UNION ALL SELECT 'silver_sleep_stages', count(*) FROM sleep_stages
        UNION ALL SELECT 'silver_rings', count(*) FROM rings
        UNION ALL SELECT 'gold_hk_quantity_daily', count(*) FROM hk_daily
        UNION ALL SELECT 'gold_subject_daily', count(*) FROM subject_daily""",
    "dash_07_seed_footprint": """SELECT CAST(ingested_at AS DATE) AS day, record_type, count(*) AS rows FROM bronze
                                 WHERE device_id = 'demo-notebook-seed' GROUP BY 1, 2""",
    "dash_08_bronze_freshness": f"""SELECT max(ingested_at) AS last_ingested_at,
                                    CAST(date_diff('day', CAST(max(ingested_at) AS DATE), DATE '{AS_OF_TS[:10]}') AS INTEGER)
                                    AS days_since_last_row,
                                    CAST(epoch(TIMESTAMP '{AS_OF_TS}') - epoch(date_trunc('second', max(ingested_at))) AS DOUBLE)
                                    / 3600.0 AS hours_since_last_row FROM bronze""",
    "dash_09_gold_volumes": """
        SELECT 'gold_daily_steps' AS dataset, count(*) AS row_count FROM daily_steps
        UNION ALL SELECT 'gold_activity_enriched_daily', count(*) FROM enriched
        UNION ALL SELECT 'gold_sleep_nightly', count(*) FROM sleep_nightly
        UNION ALL SELECT 'gold_weekly_workout_summary', count(*) FROM weekly
        UNION ALL SELECT 'gold_cardio_vitals_daily', count(*) FROM cardio
        UNION ALL SELECT 'gold_heart_rate_intraday_daily', count(*) FROM hr_intraday
        UNION ALL SELECT 'gold_bronze_ingest_daily', count(*) FROM ingest_daily
        UNION ALL SELECT 'gold_hk_family_weekly', count(*) FROM family_weekly""",
    "dash_10_activity_60d": f"""SELECT day, user_id, move_ring_ratio, exercise_ring_ratio, stand_ring_ratio, total_steps
                                FROM enriched WHERE day >= DATE '{as_of(60)}' - INTERVAL 60 DAY""",
    "dash_11_sleep_90d": f"""SELECT sleep_night, user_id, deep_sleep_min, rem_sleep_min, core_sleep_min, awake_min,
                             in_bed_min, total_tracked_min, sleep_sessions FROM sleep_nightly
                             WHERE sleep_night >= DATE '{as_of(90)}' - INTERVAL 90 DAY""",
    "dash_12_ingest_by_type_90d": f"""SELECT ingest_day, user_id, record_type, row_count FROM ingest_daily
                                      WHERE ingest_day >= DATE '{as_of(90)}' - INTERVAL 90 DAY""",
    "app_activity_trend": f"""SELECT day, count(DISTINCT user_id) AS active_users,
                              {rnd('avg(CAST(move_ring_ratio AS DECIMAL(18,3)))', 3)} AS avg_move_ratio, {rnd('avg(CAST(total_steps AS DECIMAL(38,6)))', 0)} AS avg_steps
                              FROM enriched WHERE {_win('day')} GROUP BY day""",
    "app_ingest_daily_trend": f"""SELECT CAST(ingested_at AS DATE) AS ingest_day, count(*) AS row_count FROM bronze
                                  WHERE {_win('CAST(ingested_at AS DATE)')} GROUP BY 1""",
    "app_ingest_mix": f"""SELECT record_type, row_count,
                          CAST(floor(row_count * 100.0 / max(row_count) OVER () + 0.5) AS BIGINT) AS pct_of_max
                          FROM (SELECT record_type, CAST(sum(row_count) AS BIGINT) AS row_count FROM ingest_daily
                                WHERE {_win('ingest_day')} GROUP BY record_type)""",
    "app_activity_trend_search": f"""SELECT day, count(DISTINCT user_id) AS active_users,
                              {rnd('avg(CAST(move_ring_ratio AS DECIMAL(18,3)))', 3)} AS avg_move_ratio,
                              {rnd('avg(CAST(total_steps AS DECIMAL(38,6)))', 0)} AS avg_steps
                              FROM enriched WHERE day BETWEEN DATE '{APP_START}' AND DATE '{APP_END}'
                              AND user_id LIKE '%1%' GROUP BY day""",
    "app_ingest_mix_samples": f"""SELECT record_type, row_count,
                          CAST(floor(row_count * 100.0 / max(row_count) OVER () + 0.5) AS BIGINT) AS pct_of_max
                          FROM (SELECT record_type, CAST(sum(row_count) AS BIGINT) AS row_count FROM ingest_daily
                                WHERE {_win('ingest_day')} AND record_type = 'samples' GROUP BY record_type)""",
    "app_dashboard_kpis": f"""SELECT
        (SELECT count(*) FROM bronze WHERE {_win('CAST(ingested_at AS DATE)')}) AS bronze_rows_in_window,
        (SELECT count(*) FROM bronze) AS bronze_rows_all_time,
        (SELECT count(DISTINCT user_id) FROM enriched WHERE {_win('day')}) AS active_users_in_window,
        (SELECT count(DISTINCT user_id) FROM daily_steps WHERE {_win('day')}) AS users_with_steps_in_window,
        (SELECT max(ingested_at) FROM bronze WHERE {_win('CAST(ingested_at AS DATE)')}) AS last_bronze_ingest_in_window""",
    "app_sleep_summary": f"""SELECT user_id, {rnd('avg(CAST(deep_sleep_min AS DECIMAL(38,10)))', 1)} AS avg_deep_min,
                             {rnd('avg(CAST(rem_sleep_min AS DECIMAL(38,10)))', 1)} AS avg_rem_min, {rnd('avg(CAST(total_tracked_min AS DECIMAL(38,10)))', 0)} AS avg_tracked_min,
                             count(*) AS nights FROM sleep_nightly WHERE {_win('sleep_night')}
                             GROUP BY user_id ORDER BY nights DESC NULLS LAST, user_id LIMIT 50""",
    "app_steps_leaderboard": f"""SELECT user_id, {rnd('avg(CAST(total_steps AS DECIMAL(38,6)))', 0)} AS avg_steps, max(total_steps) AS peak_steps,
                                 {rnd('sum(CAST(total_steps AS DECIMAL(38,6)))', 0)} AS sum_steps FROM daily_steps WHERE {_win('day')}
                                 GROUP BY user_id ORDER BY avg_steps DESC NULLS LAST, user_id LIMIT 50""",
    "app_rhr_trend": f"""SELECT day, {rnd('avg(CAST(resting_hr_avg AS DECIMAL(38,10)))', 1)} AS avg_resting_hr,
                         count(DISTINCT user_id) AS users_reporting FROM cardio
                         WHERE {_win('day')} AND resting_hr_avg IS NOT NULL GROUP BY day""",
    "app_workout_volume": f"""SELECT user_id, CAST(sum(workout_count) AS BIGINT) AS workouts, {rnd('sum(CAST(total_duration_min AS DECIMAL(38,6)))', 0)} AS total_minutes,
                              {rnd('sum(CAST(total_energy_kcal AS DECIMAL(38,6)))', 0)} AS total_kcal FROM weekly
                              WHERE {_win('CAST(week_start AS DATE)')}
                              GROUP BY user_id ORDER BY workouts DESC NULLS LAST, user_id LIMIT 50""",
    "seed_counts": """SELECT user_id, record_type, count(*) AS rows FROM bronze WHERE device_id = 'demo-notebook-seed'
                      GROUP BY 1, 2""",
    "platform_types": """SELECT 'apple_healthkit' AS platform, record_type, count(*) AS cnt FROM bronze GROUP BY 1, 2""",
    "record_spans": """SELECT record_type, count(*) AS cnt, min(ingested_at) AS earliest, max(ingested_at) AS latest
                       FROM bronze GROUP BY 1""",
}


_CHANNEL = "CASE WHEN channel IS NOT NULL THEN channel WHEN device_id = 'demo-notebook-seed' THEN 'notebook_simulator' ELSE 'rest_app' END"

FINAL.update({
    "ingest_channels": f"SELECT {_CHANNEL} AS channel, record_type, count(*) AS rows FROM bronze GROUP BY 1, 2",
    "samples_simulator_channel": f"""SELECT * EXCLUDE (rn) FROM (
        SELECT s.*, row_number() OVER (PARTITION BY s.hk_uuid ORDER BY s.ingested_at, s.record_id) AS rn
        FROM s_raw s JOIN bronze b ON s.record_id = b.record_id
        WHERE {_CHANNEL.replace('channel IS', 'b.channel IS').replace('THEN channel', 'THEN b.channel').replace('device_id', 'b.device_id')} = 'notebook_simulator')
      WHERE rn = 1""",
    "sleep_sessions": """,
        x AS (SELECT user_id, stage_uuid, stage_start_at, stage_end_at,
                     lag(stage_end_at) OVER (PARTITION BY user_id ORDER BY stage_start_at, stage_end_at, stage_uuid)
                     AS prev_end
              FROM sleep_stages WHERE stage_start_at IS NOT NULL AND stage_end_at IS NOT NULL),
        y AS (SELECT *, sum(CASE WHEN prev_end IS NULL OR stage_start_at - prev_end > INTERVAL 30 MINUTE
                                 THEN 1 ELSE 0 END)
                     OVER (PARTITION BY user_id ORDER BY stage_start_at, stage_end_at, stage_uuid
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS session_seq FROM x)
        SELECT user_id, CAST(session_seq AS BIGINT) AS session_seq, min(stage_start_at) AS session_start_at,
               max(stage_end_at) AS session_end_at, count(*) AS stage_count FROM y GROUP BY 1, 2""",
    "sleep_session_stages": """,
        x AS (SELECT user_id, stage_uuid, sleep_stage, stage_start_at, stage_end_at,
                     lag(stage_end_at) OVER (PARTITION BY user_id ORDER BY stage_start_at, stage_end_at, stage_uuid) AS prev_end
              FROM sleep_stages WHERE stage_start_at IS NOT NULL AND stage_end_at IS NOT NULL),
        y AS (SELECT *, CAST(sum(CASE WHEN prev_end IS NULL OR stage_start_at - prev_end > INTERVAL 30 MINUTE THEN 1 ELSE 0 END)
                     OVER (PARTITION BY user_id ORDER BY stage_start_at, stage_end_at, stage_uuid
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS session_seq FROM x)
        SELECT user_id, session_seq, row_number() OVER (PARTITION BY user_id, session_seq ORDER BY stage_start_at, stage_end_at, stage_uuid) AS stage_no,
               sleep_stage AS stage, stage_start_at, stage_end_at FROM y""",
    "samples_live": """SELECT * FROM samples s WHERE NOT EXISTS (
                         SELECT 1 FROM deletes d WHERE d.deleted_uuid = s.hk_uuid)""",
    "workouts_live": """SELECT * FROM workouts w WHERE NOT EXISTS (
                          SELECT 1 FROM deletes d WHERE d.deleted_uuid = w.workout_uuid)""",
    "samples_flagged": """SELECT hk_uuid, user_id, hk_type,
                            EXISTS (SELECT 1 FROM deletes d WHERE d.deleted_uuid = s.hk_uuid) AS is_deleted
                          FROM samples s""",
    "verify_inserted": """SELECT count(*) AS verified_rows FROM bronze
                          WHERE record_id IN (SELECT record_id FROM bronze WHERE device_id = 'demo-notebook-seed')""",
    "user_by_device": """,
        dev AS (SELECT device_id, user_id AS device_user_id FROM (
                  SELECT device_id, user_id, row_number() OVER (PARTITION BY device_id
                         ORDER BY ingested_at DESC, user_id DESC) AS rn
                  FROM bronze WHERE device_id <> 'demo-notebook-seed') WHERE rn = 1)
        SELECT b.record_id, b.user_id, b.device_id, coalesce(d.device_user_id, b.user_id) AS resolved_user_id
        FROM bronze b LEFT JOIN dev d ON b.device_id = d.device_id""",
    "stream_change_feed": """SELECT * EXCLUDE (rn) FROM (
                            SELECT *, row_number() OVER (PARTITION BY hk_uuid ORDER BY ingested_at DESC, record_id DESC)
                            AS rn FROM s_raw) s
                          WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM deletes d WHERE d.deleted_uuid = s.hk_uuid)""",
    "samples_current": """SELECT * EXCLUDE (rn) FROM (
                            SELECT *, row_number() OVER (PARTITION BY hk_uuid ORDER BY ingested_at DESC, record_id DESC)
                            AS rn FROM s_raw) s
                          WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM deletes d WHERE d.deleted_uuid = s.hk_uuid)""",
})

FINAL.update({
    "stream_samples": "SELECT * EXCLUDE (record_id, ingested_at) FROM samples",
    "stream_samples_bounded": "SELECT * EXCLUDE (record_id, ingested_at) FROM samples",
    "stream_event_keys": "SELECT event_id FROM events_silver",
    "stream_bronze_mirror": "SELECT record_id, record_type, user_id, ingested_at FROM bronze",
    "stream_gold_hk_daily": "SELECT * FROM hk_daily",
    "stream_gold_sleep_nightly": "SELECT * EXCLUDE (sleep_sessions) FROM sleep_nightly",
})

_UNITS_OF = "CASE hk_type " + " ".join(f"WHEN '{t}' THEN '{u}'" for t, u in HK_CANONICAL_UNITS) + " ELSE 'count' END"
_BODY_ID = """CASE record_type WHEN 'sleep' THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ') WHEN 'activity_summaries' THEN strftime(ts, '%Y-%m-%d')
            WHEN 'deletes' THEN 'e' || CAST(event_id - 1 AS VARCHAR) ELSE 'e' || CAST(event_id AS VARCHAR) END"""
FINAL.update({
    "sample_labels": f"""SELECT hk_uuid, substr(l, 1, 1) || regexp_replace(substr(l, 2), '([A-Z])', ' \\1', 'g') AS label, {_UNITS_OF} AS canonical_unit,
        'category' AS category_unit, CAST(floor(value) AS DOUBLE) AS value FROM (SELECT *, regexp_replace(hk_type,
        '^(HKQuantityTypeIdentifier|HKCategoryTypeIdentifier|HKCorrelationTypeIdentifier)', '') AS l FROM samples)""",
    "workout_spans": "SELECT workout_uuid, date_diff('millisecond', start_at, end_at) / 1000.0::DOUBLE AS seconds FROM workouts",
    "header_maps": """SELECT record_id, 'content-type=application/x-ndjson;x-device-id=' || device_id
        || CASE WHEN channel IS NULL THEN '' ELSE ';x-ingest-channel=' || channel END || ';x-platform=apple_healthkit;x-record-type=' || record_type
        || ';x-upload-timestamp=' || strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS headers FROM bronze""",
    "staged_rows": f"SELECT record_id, record_type, user_id, ingested_at, device_id, {_BODY_ID} AS body_id FROM bronze",
    "evolved_rows": "SELECT record_id, record_type, user_id, CASE WHEN record_type <> 'deletes' THEN device_id END AS device_id FROM bronze",
    "ndjson_lines": """SELECT record_id, '{' || CASE WHEN channel IS NULL THEN '' ELSE '"channel":"' || channel || '",' END || '"record_id":"' || record_id
        || '","record_type":"' || record_type || '","user_id":"' || user_id || '"}' AS line FROM bronze""",
})

# tables maintained in steps: the same rows as one batch run
FINAL.update({
    "bronze_reseeded": """SELECT record_id, record_type, user_id, ingested_at FROM bronze WHERE device_id <> 'demo-notebook-seed'
        UNION ALL SELECT record_id || '-again', record_type, user_id, ingested_at + INTERVAL 1 DAY FROM bronze
        WHERE device_id = 'demo-notebook-seed' AND record_type = 'samples'""",
    "change_feed_synced": FINAL["samples_current"],
    "stream_sleep_sessions": FINAL["sleep_sessions"],
    "active_users_rolling": """,
        d AS (SELECT DISTINCT summary_date AS day, user_id FROM rings WHERE summary_date IS NOT NULL AND user_id IS NOT NULL),
        e AS (SELECT DISTINCT day AS window_end FROM d)
        SELECT window_end, count(DISTINCT user_id) AS users FROM e JOIN d ON day BETWEEN window_end - INTERVAL 6 DAY AND window_end GROUP BY 1""",
    "quality_gated_landing": """,
        c AS (SELECT epoch_us(min(ingested_at)) + (epoch_us(max(ingested_at)) - epoch_us(min(ingested_at))) // 2 AS cut FROM bronze),
        h AS (SELECT CASE WHEN epoch_us(ingested_at) <= cut THEN 0 ELSE 1 END AS batch, device_id, record_type, user_id FROM bronze, c),
        m AS (SELECT batch, count(*) AS found, count(*) FILTER (record_type = 'samples') AS samples, count(DISTINCT record_type) AS types,
                     CASE WHEN batch = 0 THEN 0 ELSE count(*) FILTER (device_id = 'demo-notebook-seed') END AS off, min(user_id) = max(user_id) AS alone FROM h GROUP BY batch)
        SELECT CAST(batch AS INTEGER) AS batch, t."check", t.passed, t.detail, batch = 0 AS published, (SELECT found FROM m WHERE batch = 0) AS rows_published
        FROM m, LATERAL (VALUES ('rows_present', true, printf('found=%d expected=%d', found, found)), ('keys_present', true, 'rows_failing=0'),
          ('single_platform', off = 0, printf('off_platform=%d', off)), ('header_blocklist', true, 'rows_failing=0'),
          ('sample_body_keys', true, printf('sample_rows=%d rows_missing_keys=0', samples)),
          ('record_types_present', types = 5, printf('present=%d expected=5', types)),
          ('single_user', alone, CASE WHEN alone THEN 'users=one' ELSE 'users=several' END)) AS t("check", passed, detail)""",
    "samples_late_split": """,
        w AS (SELECT *, CAST(floor((epoch(date_trunc('second', ingested_at)) + CASE WHEN CAST(regexp_extract(record_id, '[0-9]+') AS BIGINT) % 17 = 0
                             THEN 6 * 86400 ELSE 0 END) / (4 * 86400)) AS BIGINT) AS arrival FROM s_raw),
        high AS (SELECT arrival, max(max(ingested_at)) OVER (ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                        - INTERVAL 36 HOUR AS mark FROM w GROUP BY arrival),
        d AS (SELECT w.*, mark, coalesce(ingested_at < mark, false) AS late FROM w JOIN high USING (arrival)),
        o AS (SELECT *, row_number() OVER (PARTITION BY hk_uuid, arrival ORDER BY ingested_at, record_id) AS rn FROM d WHERE NOT late),
        f AS (SELECT *, lag(ingested_at) OVER (PARTITION BY hk_uuid ORDER BY arrival) AS prior FROM o WHERE rn = 1)
        SELECT 'kept' AS kind, record_id, hk_uuid, ingested_at, arrival FROM f WHERE prior IS NULL OR prior < mark
        UNION ALL SELECT 'late', record_id, hk_uuid, ingested_at, arrival FROM d WHERE late""",
    "backfill_ledger": """,
        days AS (SELECT CAST(unnest(generate_series(DATE '2024-01-01', DATE '2024-01-31', INTERVAL 1 DAY)) AS DATE) AS day),
        n AS (SELECT CAST(ingested_at AS DATE) AS day, count(*) AS rows FROM bronze GROUP BY 1)
        SELECT day, 'landed' AS status, CASE WHEN extract(day FROM day) % 5 = 0 AND rows IS NOT NULL THEN 2 ELSE 1 END AS attempts,
               coalesce(rows, 0) AS rows, coalesce(rows, 0) AS held FROM days LEFT JOIN n USING (day)""",
    "stream_gold_incremental": FINAL["g_hk_daily"],
    "g_activity_enriched_bucketed": FINAL["g_activity_enriched"],
    "samples_live_bucketed": FINAL["samples_live"],
    "clustered_bronze_window": """SELECT record_id, record_type, user_id, ingested_at FROM bronze WHERE user_id BETWEEN 'u10' AND 'u19'
        AND ingested_at >= TIMESTAMP '2024-01-08' AND ingested_at < TIMESTAMP '2024-01-15'""",
    "inc_subject_daily": FINAL["g_subject_daily"],
    "inc_sleep_nightly": FINAL["g_sleep_nightly"],
    "inc_weekly_workouts": FINAL["g_weekly_workouts"],
    "inc_family_weekly": FINAL["g_family_weekly"],
    "inc_ingest_daily": FINAL["g_ingest_daily"],
})

#: the request files derived from bronze: lines (kind 0: document, 1 and 3: malformed) and requests
_REQUESTS = """,
raw_lines AS (
  SELECT *, event_id // 200 AS b, 0 AS kind FROM bronze
  UNION ALL SELECT *, event_id // 200, 1 FROM bronze WHERE event_id % 25 = 0
  UNION ALL SELECT *, event_id // 200, 2 FROM bronze WHERE event_id % 30 = 0
  UNION ALL SELECT *, event_id // 200, 3 FROM bronze WHERE event_id % 200 = 199
),
keyed AS (
  SELECT *, record_type || '-' || CAST(b AS VARCHAR) || CASE WHEN kind = 3 THEN '-x' ELSE '' END AS request_id,
         TIMESTAMP '2024-02-01 00:00:00' + to_seconds(b * 60 + CASE WHEN kind = 3 THEN 30 ELSE 0 END) AS received
  FROM raw_lines
),
lines AS (
  SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY event_id, record_id, kind) AS line_no FROM keyed WHERE kind <> 2
),
reqs AS (
  SELECT request_id, record_type, received, count(*) FILTER (kind = 0) AS records, count(*) AS all_lines
  FROM keyed GROUP BY ALL
)"""

FINAL.update({
    "ndjson_landing": _REQUESTS + """
        SELECT sha256(request_id || ':' || CAST(line_no AS VARCHAR)) AS record_id, received AS ingested_at, record_type, source_platform,
          CASE WHEN event_id % 40 <> 0 THEN user_id WHEN b % 3 = 1 THEN 'sender@example.org' ELSE 'anonymous' END AS user_id,
          CASE record_type WHEN 'sleep' THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ') WHEN 'activity_summaries' THEN strftime(ts, '%Y-%m-%d')
            WHEN 'deletes' THEN 'e' || CAST(event_id - 1 AS VARCHAR) ELSE 'e' || CAST(event_id AS VARCHAR) END AS body_id,
          CASE WHEN record_type IN ('samples', 'activity_summaries') THEN value END AS body_value, event_id % 40 = 0 AS has_override,
          CASE WHEN b % 3 = 1 THEN 'content-type,x-forwarded-email,x-ingest-channel,x-platform,x-record-type'
               ELSE 'content-type,x-ingest-channel,x-platform,x-record-type' END AS header_names
        FROM lines WHERE kind = 0""",
    "ndjson_errors": _REQUESTS + """
        SELECT request_id, CAST(line_no AS INTEGER) AS line_no, printf('Line %d: invalid JSON', line_no) AS message FROM lines WHERE kind <> 0""",
    "ingest_metrics": _REQUESTS + """
        SELECT count(*) FILTER (records > 0) AS successful_ingests, count(*) FILTER (records = 0) AS failed_ingests,
          CAST(sum(records) AS BIGINT) AS total_records_ingested, max(received) FILTER (records > 0) AS last_ingest_at,
          max(received) FILTER (records = 0) AS last_error_at,
          max(CASE WHEN records = 0 THEN 'No valid records found. Parse errors: Line 1: invalid JSON' END) AS last_error_message
        FROM reqs""",
    "ingest_by_type": _REQUESTS + """
        SELECT record_type, count(*) AS requests, CAST(sum(records) AS BIGINT) AS records FROM reqs WHERE records > 0 GROUP BY 1""",
    "last_payload_per_type": _REQUESTS + """,
        newest AS (SELECT *, row_number() OVER (PARTITION BY record_type ORDER BY received DESC, request_id DESC) AS rn FROM reqs)
        SELECT n.record_type, n.received AS last_timestamp, CAST(n.all_lines AS INTEGER) AS payload_lines,
          coalesce((SELECT CASE WHEN l.event_id % 40 = 0 THEN '  ' ELSE l.user_id END FROM lines l
                    WHERE l.request_id = n.request_id AND l.line_no = 1 AND l.kind = 0), '') AS first_user
        FROM newest n WHERE rn = 1""",
    "recent_requests": _REQUESTS + """
        SELECT request_id, record_type, received AS "timestamp", CAST(records AS INTEGER) AS record_count,
          CASE WHEN records > 0 THEN 200 ELSE 400 END AS http_status_code, records > 0 AS success
        FROM reqs ORDER BY received DESC, request_id DESC LIMIT 20""",
    "quality_checks": """,
        sd AS (SELECT * FROM bronze WHERE device_id = 'demo-notebook-seed'),
        a AS (SELECT count(*) AS found, count(DISTINCT source_platform) AS n_platforms,
                     count(*) FILTER (WHERE source_platform <> 'apple_healthkit') AS off_platform,
                     count(*) FILTER (WHERE record_type = 'samples') AS sample_rows,
                     count(DISTINCT user_id) AS n_users, count(*) AS off_user FROM sd)
        SELECT * FROM (VALUES
          ('ids_present', true, printf('found=%d expected=%d', (SELECT found FROM a), (SELECT found FROM a))),
          ('single_platform', (SELECT n_platforms = 1 AND off_platform = 0 FROM a),
             printf('platforms=%d off_platform=%d', (SELECT n_platforms FROM a), (SELECT off_platform FROM a))),
          ('header_blocklist', (SELECT found > 0 FROM a), 'rows_failing=0'),
          ('sample_body_keys', (SELECT sample_rows > 0 FROM a), printf('sample_rows=%d rows_missing_keys=0', (SELECT sample_rows FROM a))),
          ('record_types_present', (SELECT count(DISTINCT record_type) = 5 FROM bronze),
             printf('present=%d expected=5', (SELECT count(DISTINCT record_type) FROM bronze))),
          ('single_user', (SELECT n_users = 1 AND off_user = 0 FROM a),
             printf('users=%d off_user=%d', (SELECT n_users FROM a), (SELECT off_user FROM a)))
        ) AS t("check", passed, detail)""",
    "sync_stats": """,
        sb AS (
          SELECT 'samples' AS record_type, hk_type AS breakdown, ingested_at FROM s_raw
          UNION ALL SELECT 'workouts', activity_type, ingested_at FROM w_raw
          UNION ALL SELECT 'sleep', 'sleep', ingested_at FROM sl
          UNION ALL SELECT 'activity_summaries', 'activity_summaries', ingested_at FROM rings
          UNION ALL SELECT 'deletes', deleted_sample_type, ingested_at FROM deletes)
        SELECT record_type, breakdown, count(*) AS records, max(ingested_at) AS last_sync_at FROM sb GROUP BY 1, 2""",
    "sync_stats_client": _REQUESTS + """
        SELECT record_type, CAST(sum(records) AS BIGINT) AS records, max(received) AS last_sync_at FROM reqs WHERE records > 0 GROUP BY 1""",
    "batch_chunks": """SELECT record_type, CAST(floor((rn - 1) / 2000) AS BIGINT) AS batch_no, count(*) AS records FROM (
                         SELECT record_type, row_number() OVER (PARTITION BY record_type ORDER BY ingested_at, record_id) AS rn
                         FROM bronze) GROUP BY 1, 2""",
})


def oracle_sql() -> dict[str, str]:
    from .oracle_platforms import platform_oracles
    platforms = platform_oracles()
    return {**{name: BASE + final for name, final in FINAL.items()}, **platforms, "watch_delivered": platforms["watch_events"]}
