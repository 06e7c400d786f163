"""SQL that gives the expected result of the driver queries on the same tables.

Written apart from the operators, for a single-node SQL engine: nearest matches by joining all
pairs, decayed load by a self join, merges as a plain union. Rounded values go through DECIMAL, which
rounds half up on the written digits.
"""

from __future__ import annotations

from paceforge.operators.quality import GRAIN, NOT_NULL, UNIQUE


def _round(value: str, digits: int) -> str:
    return f"CAST(round(CAST({value} AS DECIMAL(30,9)), {digits}) AS DOUBLE)"


def _with(*parts: str, select: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n" + select


def _show(source: str, dates: str = "", times: str = "", flags: str = "") -> str:
    shown = [f"CAST({c} AS VARCHAR) AS {c}" for c in (dates + " " + flags).split()]
    shown += [f"epoch_us({c}) AS {c}" for c in times.split()]
    return f"SELECT * REPLACE ({', '.join(shown)}) FROM {source}" if shown else f"SELECT * FROM {source}"


EV = """ev AS (
  SELECT event_id, ts, CAST(ts AS DATE) AS d, user_id, event_type,
         CAST(round(value * 100) AS BIGINT) AS cents,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         user_id * 1000000 + date_diff('day', DATE '2000-01-01', CAST(ts AS DATE)) AS cycle
  FROM events)"""

CYCLES = """cyc_versions AS (
  SELECT cycle, user_id, d, event_type, CAST(sum(cents) AS BIGINT) AS cents,
         CAST(sum(k) AS BIGINT) AS k, max(ts) AS seen
  FROM ev GROUP BY cycle, user_id, d, event_type),
cycles AS (
  SELECT cycle AS cycle_id, user_id, CAST(d AS TIMESTAMP) AS cycle_start, seen AS cycle_end,
         '+00:00' AS timezone_offset,
         CASE WHEN event_type = 'error' THEN 'PENDING_SCORE' ELSE 'SCORED' END AS score_state,
         CASE WHEN event_type <> 'error' THEN (cents % 2101) / 100.0 END AS strain_score,
         CASE WHEN event_type <> 'error' THEN cents / 10.0 END AS kilojoule,
         CASE WHEN event_type <> 'error' THEN k % 50 + 50 END AS avg_heart_rate,
         CASE WHEN event_type <> 'error' THEN k % 90 + 100 END AS max_heart_rate,
         seen AS loaded_at, d AS cycle_date
  FROM cyc_versions v
  WHERE seen = (SELECT max(seen) FROM cyc_versions w WHERE w.cycle = v.cycle))"""

RECOVERIES = """rec_versions AS (
  SELECT cycle, user_id, event_type, CAST(sum(cents) AS BIGINT) AS cents,
         CAST(sum(k) AS BIGINT) AS k, min(ts) AS first_at, max(ts) AS seen
  FROM ev WHERE event_type <> 'error' GROUP BY cycle, user_id, event_type),
rec_last AS (
  SELECT *, event_type <> 'signup' AS ok FROM rec_versions v
  WHERE seen = (SELECT max(seen) FROM rec_versions w WHERE w.cycle = v.cycle)),
recoveries AS (
  SELECT cycle AS cycle_id, concat(cycle, '-', event_type) AS sleep_id, user_id,
         CASE WHEN ok THEN 'SCORED' ELSE 'UNSCORABLE' END AS score_state,
         CASE WHEN ok THEN event_type = 'view' END AS is_calibrating,
         CASE WHEN ok THEN (k % 101) / 1.0 END AS recovery_score,
         CASE WHEN ok THEN (k % 25 + 40) / 1.0 END AS resting_heart_rate,
         CASE WHEN ok THEN (cents % 12000) / 100.0 END AS hrv_rmssd_milli,
         CASE WHEN ok THEN (cents % 100 + 900) / 10.0 END AS spo2_pct,
         CASE WHEN ok THEN (cents % 40 + 320) / 10.0 END AS skin_temp_celsius,
         first_at AS created_at, seen AS updated_at, seen AS loaded_at,
         CAST(first_at AS DATE) AS recovery_date
  FROM rec_last)"""

SLEEPS = """sleep_last AS (
  SELECT *, cents * 977 AS ms FROM ev
  QUALIFY row_number() OVER (PARTITION BY cycle, event_type ORDER BY ts DESC) = 1),
sleeps AS (
  SELECT concat(cycle, '-', event_type) AS sleep_id, cycle AS cycle_id, user_id,
         CASE event_type WHEN 'click' THEN true WHEN 'signup' THEN NULL ELSE false END AS is_nap,
         CAST(d AS TIMESTAMP) AS sleep_start, ts AS sleep_end, '+00:00' AS timezone_offset,
         'SCORED' AS score_state,
         (ms % 18000000 + 18000000) / 3600000.0 AS in_bed_hours,
         CASE WHEN k >= 10 THEN k * 60000 / 3600000.0 END AS awake_hours,
         (ms % 9000000) / 3600000.0 AS light_sleep_hours,
         (ms % 7000000) / 3600000.0 AS sws_hours,
         (ms % 5000000) / 3600000.0 AS rem_hours,
         k % 7 AS sleep_cycle_count, k % 11 AS disturbance_count,
         k * 1000 / 3600000.0 AS no_data_hours,
         k * 360000 / 3600000.0 AS sleep_needed_baseline_hours,
         k * 3600 / 3600000.0 AS sleep_need_from_debt_hours,
         k * 1800 / 3600000.0 AS sleep_need_from_strain_hours,
         k * -900 / 3600000.0 AS sleep_need_from_nap_hours,
         (k % 8 + 12) / 1.0 AS respiratory_rate,
         (cents % 101) / 1.0 AS sleep_performance_pct,
         k / 1.0 AS sleep_consistency_pct,
         (cents % 1000) / 10.0 AS sleep_efficiency_pct,
         ts AS loaded_at, d AS sleep_date
  FROM sleep_last)"""

WORKOUTS = """workout_last AS (
  SELECT *, event_type <> 'error' AS ok, event_type <> 'error' AND k >= 20 AS zoned FROM ev
  QUALIFY row_number() OVER (PARTITION BY user_id, event_id // 2 ORDER BY ts DESC) = 1),
workouts AS (
  SELECT concat(user_id, '-', event_id // 2) AS workout_id, user_id, k % 5 AS sport_id,
         CASE event_type WHEN 'click' THEN 'Running' WHEN 'view' THEN 'trail run'
              WHEN 'purchase' THEN 'Cycling' WHEN 'signup' THEN 'RUNNING' END AS sport_name,
         ts AS workout_start, ts + to_minutes(k) AS workout_end, '+00:00' AS timezone_offset,
         CASE WHEN ok THEN 'SCORED' ELSE 'PENDING_SCORE' END AS score_state,
         CASE WHEN ok THEN (cents % 2101) / 100.0 END AS strain_score,
         CASE WHEN ok THEN k + 90 END AS avg_heart_rate,
         CASE WHEN ok THEN k + 120 END AS max_heart_rate,
         CASE WHEN ok THEN cents / 10.0 END AS kilojoule,
         CASE WHEN ok THEN k / 1.0 / 100.0 END AS pct_recorded,
         CASE WHEN ok THEN cents * 3 / 1.0 END AS distance_meter,
         CASE WHEN ok THEN k / 2.0 END AS altitude_gain_meter,
         CASE WHEN ok THEN (k - 50) / 2.0 END AS altitude_change_meter,
         CASE WHEN zoned THEN k * 1000 / 60000.0 END AS zone_0_min,
         CASE WHEN zoned THEN k * 2000 / 60000.0 END AS zone_1_min,
         CASE WHEN zoned THEN k * 3000 / 60000.0 END AS zone_2_min,
         CASE WHEN zoned THEN k * 4000 / 60000.0 END AS zone_3_min,
         CASE WHEN zoned THEN k * 5000 / 60000.0 END AS zone_4_min,
         CASE WHEN zoned THEN k * 6000 / 60000.0 END AS zone_5_min,
         ts AS loaded_at, d AS workout_date
  FROM workout_last)"""

USERS = """users AS (
  SELECT user_id, concat('user', user_id, '@example.org') AS email, event_type AS first_name,
         concat('U', k) AS last_name, ts AS loaded_at
  FROM ev QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1)"""

# The made route of an event: point i of 2 + k % 7. Its encoded line is checked by its points.
POINTS = """points AS (
  SELECT event_id AS run_id, d, i AS point_idx,
         (4000000 + (cents * (i + 1) * 31) % 2000 - 1000) / 100000.0 AS lat,
         (-7000000 + (k * (i + 1) * 37) % 3000 - 1500) / 100000.0 AS lng
  FROM (SELECT *, unnest(generate_series(0, k % 7 + 1)) AS i FROM ev
        WHERE event_type NOT IN ('signup', 'error')) e)"""

def _encoded(zigzag: str) -> str:
    digits = f"greatest(1, CAST(ceil(log2({zigzag} + 1) / 5) AS BIGINT))"
    digit = f"CAST(floor({zigzag} / pow(32, j)) AS BIGINT) % 32 + CASE WHEN j < {digits} - 1 THEN 32 ELSE 0 END + 63"
    return f"array_to_string(list_transform(generate_series(0, {digits} - 1), lambda j: chr(CAST({digit} AS INTEGER))), '')"


LINES = f"""{POINTS},
line_steps AS (
  SELECT run_id, point_idx, lat5 - coalesce(lag(lat5) OVER w, 0) AS a, lng5 - coalesce(lag(lng5) OVER w, 0) AS b
  FROM (SELECT *, CAST(round(lat * 100000) AS BIGINT) AS lat5, CAST(round(lng * 100000) AS BIGINT) AS lng5 FROM points)
  WINDOW w AS (PARTITION BY run_id ORDER BY point_idx)),
line_codes AS (
  SELECT run_id, point_idx, CASE WHEN a < 0 THEN -2 * a - 1 ELSE 2 * a END AS za,
         CASE WHEN b < 0 THEN -2 * b - 1 ELSE 2 * b END AS zb FROM line_steps),
lines AS (
  SELECT run_id AS line_id, string_agg(concat({_encoded("za")}, {_encoded("zb")}), '' ORDER BY point_idx) AS line
  FROM line_codes GROUP BY run_id)"""

RUNS = f"""{LINES},
runs AS (
  SELECT event_id AS run_id, concat('Run ', event_id) AS run_name,
         CASE event_type WHEN 'click' THEN 'TrailRun' WHEN 'view' THEN 'VirtualRun' ELSE 'Run' END
           AS sport_type,
         ts AS run_start, d AS run_date, (cents % 500) * 10 / 1.0 AS distance_meter,
         (cents % 500) * 10 / 1.0 / 1000.0 AS distance_km, k * 60 AS moving_time_sec,
         k * 66 AS elapsed_time_sec, k * 60 / 60.0 AS moving_time_min,
         CASE WHEN cents % 500 > 0
              THEN (k * 60 / 60.0) / ((cents % 500) * 10 / 1.0 / 1000.0) END AS pace_min_per_km,
         (cents % 6000) / 1000.0 AS average_speed_ms, (cents % 9000) / 1000.0 AS max_speed_ms,
         {_round("(cents % 6000) * 36 / CAST(10000 AS DECIMAL(30,9))", 2)} AS avg_speed_kmh,
         {_round("(cents % 9000) * 36 / CAST(10000 AS DECIMAL(30,9))", 2)} AS max_speed_kmh,
         k / 2.0 AS total_elevation_gain_meter,
         CASE WHEN k >= 10 THEN (k + 80) / 1.0 END AS average_heartrate,
         CASE WHEN k >= 10 THEN (k + 110) / 1.0 END AS max_heartrate,
         (k + 60) / 1.0 AS average_cadence, k / 4.0 AS suffer_score,
         CASE WHEN event_type = 'error' THEN '' ELSE line END AS summary_polyline,
         ts AS loaded_at, user_id,
         CASE WHEN event_type IN ('error', 'click') THEN NULL
              ELSE concat('https://photos.example/', event_id, '/1') END AS primary_photo_url,
         CASE WHEN event_type = 'click' THEN 0 WHEN event_type <> 'error' THEN k % 4 + 1 END
           AS photo_count
  FROM ev LEFT JOIN lines ON line_id = event_id)"""

DAILY = f"""main_sleep AS (
  SELECT * FROM sleeps WHERE is_nap = false
  QUALIFY row_number() OVER (PARTITION BY cycle_id ORDER BY in_bed_hours DESC, sleep_id) = 1),
daily AS (
  SELECT c.cycle_id, c.user_id, c.cycle_date, c.cycle_start, c.cycle_end,
         c.score_state AS cycle_score_state, c.strain_score, c.kilojoule AS cycle_kilojoule,
         c.avg_heart_rate AS cycle_avg_heart_rate, c.max_heart_rate AS cycle_max_heart_rate,
         r.recovery_score, r.resting_heart_rate, r.hrv_rmssd_milli, r.spo2_pct,
         r.skin_temp_celsius, r.is_calibrating, r.score_state AS recovery_score_state,
         s.sleep_id, s.sleep_start, s.sleep_end, s.in_bed_hours, s.awake_hours,
         s.light_sleep_hours, s.sws_hours, s.rem_hours, s.sleep_cycle_count, s.disturbance_count,
         s.sleep_needed_baseline_hours, s.respiratory_rate, s.sleep_performance_pct,
         s.sleep_consistency_pct, s.sleep_efficiency_pct, s.score_state AS sleep_score_state,
         {_round("s.in_bed_hours - coalesce(s.awake_hours, 0.0)", 2)} AS total_sleep_hours,
         CASE WHEN r.recovery_score >= 67 THEN 'peak' WHEN r.recovery_score >= 34 THEN 'optimal'
              WHEN r.recovery_score < 34 THEN 'poor' END AS recovery_bucket,
         CASE WHEN s.sleep_performance_pct >= 85 THEN 'excellent'
              WHEN s.sleep_performance_pct >= 70 THEN 'good'
              WHEN s.sleep_performance_pct >= 50 THEN 'fair'
              WHEN s.sleep_performance_pct < 50 THEN 'poor' END AS sleep_quality_label,
         c.loaded_at
  FROM cycles c
  LEFT JOIN recoveries r ON r.cycle_id = c.cycle_id
  LEFT JOIN main_sleep s ON s.cycle_id = c.cycle_id)"""

_STG_DAILY = (EV, CYCLES, RECOVERIES, SLEEPS, DAILY)

_NEXT_DAY = """
         n.cycle_id AS next_day_cycle_id, n.recovery_score AS next_day_recovery,
         n.recovery_bucket AS next_day_recovery_bucket, n.hrv_rmssd_milli AS next_day_hrv,
         n.resting_heart_rate AS next_day_resting_hr,
         n.sleep_performance_pct AS next_day_sleep_performance,
         n.total_sleep_hours AS next_day_sleep_hours,
         n.sleep_quality_label AS next_day_sleep_quality"""

_GAP = """date_sub('minute', least({l}, {r}), greatest({l}, {r})),
           abs(epoch_us({l}) - epoch_us({r})), {r} > {l}"""

RUN_RECOVERY = f"""pairs AS (
  SELECT r.run_id, w.*,
         coalesce(w.zone_3_min, 0) + coalesce(w.zone_4_min, 0) + coalesce(w.zone_5_min, 0) AS hard
  FROM runs r JOIN workouts w
    ON w.user_id = r.user_id AND w.workout_date = r.run_date AND w.sport_name ILIKE '%run%'
  QUALIFY row_number() OVER (PARTITION BY r.run_id ORDER BY
           {_GAP.format(l="r.run_start", r="w.workout_start")}, w.workout_id) = 1),
run_recovery AS (
  SELECT r.run_id, r.run_name, r.sport_type, r.run_start, r.run_date, r.distance_km,
         r.moving_time_min, r.pace_min_per_km, r.avg_speed_kmh, r.total_elevation_gain_meter,
         r.average_heartrate AS run_avg_hr, r.max_heartrate AS run_max_hr, r.average_cadence,
         r.suffer_score, r.summary_polyline, r.primary_photo_url,
         s.cycle_id AS same_day_cycle_id, s.strain_score AS same_day_strain,
         s.cycle_avg_heart_rate AS same_day_avg_hr, s.recovery_score AS same_day_recovery,
         s.recovery_bucket AS same_day_recovery_bucket, s.hrv_rmssd_milli AS same_day_hrv,
         s.sleep_performance_pct AS same_day_sleep_performance,
         s.total_sleep_hours AS same_day_sleep_hours,
         s.sleep_quality_label AS same_day_sleep_quality, {_NEXT_DAY},
         n.recovery_score - s.recovery_score AS recovery_delta,
         p.workout_id AS matched_workout_id, p.sport_name AS matched_sport_name,
         p.strain_score AS matched_workout_strain, p.avg_heart_rate AS matched_workout_avg_hr,
         p.max_heart_rate AS matched_workout_max_hr,
         p.distance_meter AS matched_workout_distance_meter,
         coalesce(p.hard, 0.0) AS matched_high_intensity_min, r.loaded_at, r.user_id
  FROM runs r
  LEFT JOIN daily s ON s.user_id = r.user_id AND s.cycle_date = r.run_date
  LEFT JOIN daily n ON n.user_id = r.user_id AND n.cycle_date - 1 = r.run_date
  LEFT JOIN pairs p ON p.run_id = r.run_id)"""

_RUN_RECOVERY_ALL = (*_STG_DAILY, WORKOUTS, RUNS, RUN_RECOVERY)

LOAD = f"""loads AS (
  SELECT cycle_date, user_id,
         {_round("coalesce(strain_score, 0.0) * (100.0 / 21.0)", 2)} AS daily_tss,
         strain_score, recovery_score, hrv_rmssd_milli, resting_heart_rate
  FROM daily),
decayed AS (
  SELECT t.user_id, t.cycle_date,
         {_round("sum(h.daily_tss * (1 - exp(-1.0/42)) * exp(-(t.cycle_date - h.cycle_date) / 42.0))", 1)} AS ctl,
         {_round("sum(h.daily_tss * (1 - exp(-1.0/7)) * exp(-(t.cycle_date - h.cycle_date) / 7.0))", 1)} AS atl
  FROM loads t JOIN loads h
    ON h.user_id = t.user_id AND h.cycle_date BETWEEN t.cycle_date - 180 AND t.cycle_date
  GROUP BY t.user_id, t.cycle_date),
load AS (
  SELECT l.*, ctl, atl, {_round("ctl - atl", 1)} AS tsb,
         CASE WHEN ctl - atl > 25 THEN 'very_fresh' WHEN ctl - atl > 5 THEN 'peak_form'
              WHEN ctl - atl >= -10 THEN 'neutral' WHEN ctl - atl >= -30 THEN 'fatigued'
              ELSE 'overtrained' END AS form_label,
         CASE sign(ctl - lag(ctl, 7) OVER w) WHEN 1 THEN 'building' WHEN -1 THEN 'declining'
              ELSE 'maintaining' END AS fitness_phase,
         {_round("ctl - lag(ctl, 7) OVER w", 1)} AS ctl_7d_delta,
         {_round("avg(daily_tss) OVER w7 / nullif(stddev_samp(daily_tss) OVER w7, 0)", 2)} AS training_monotony_7d
  FROM loads l JOIN decayed USING (user_id, cycle_date)
  WINDOW w AS (PARTITION BY l.user_id ORDER BY l.cycle_date),
         w7 AS (PARTITION BY l.user_id ORDER BY l.cycle_date ROWS 6 PRECEDING))"""


def _weekly(run_user: str, run_join: str) -> str:
    """Weekly summary, with the runs summed by ``run_user`` and joined on ``run_join``."""
    return f"""week_load AS (
  SELECT CAST(date_trunc('week', cycle_date) AS DATE) AS week_start, user_id,
         count(*) AS tracked_days, {_round("sum(daily_tss)", 1)} AS total_weekly_tss,
         {_round("avg(daily_tss)", 1)} AS avg_daily_tss,
         arg_max_null(ctl, cycle_date) AS week_end_ctl, arg_max_null(atl, cycle_date) AS week_end_atl,
         arg_max_null(tsb, cycle_date) AS week_end_tsb,
         arg_max_null(form_label, cycle_date) AS week_end_form,
         arg_max_null(fitness_phase, cycle_date) AS fitness_phase,
         {_round("avg(recovery_score)", 1)} AS avg_recovery,
         {_round("avg(hrv_rmssd_milli)", 1)} AS avg_hrv_rmssd,
         {_round("avg(resting_heart_rate)", 1)} AS avg_rhr,
         {_round("avg(training_monotony_7d)", 2)} AS avg_monotony,
         count(*) FILTER (strain_score >= 10) AS hard_days,
         count(*) FILTER (coalesce(strain_score, 0) < 5) AS easy_or_rest_days
  FROM load GROUP BY 1, 2),
week_runs AS (
  SELECT CAST(date_trunc('week', run_date) AS DATE) AS week_start{run_user},
         count(*) AS run_count, {_round("sum(distance_km)", 2)} AS total_distance_km,
         {_round("sum(moving_time_min)", 1)} AS total_run_minutes,
         {_round("avg(pace_min_per_km)", 2)} AS avg_pace_min_per_km,
         {_round("avg(average_heartrate)", 1)} AS avg_run_hr
  FROM runs GROUP BY ALL),
weekly AS (
  SELECT l.week_start, l.week_start + 6 AS week_end, l.user_id, l.* EXCLUDE (week_start, user_id),
         coalesce(r.run_count, 0) AS run_count, r.total_distance_km, r.total_run_minutes,
         r.avg_pace_min_per_km, r.avg_run_hr,
         {_round("l.week_end_ctl - lag(l.week_end_ctl) OVER w", 1)} AS ctl_wow_delta,
         {_round("l.total_weekly_tss - lag(l.total_weekly_tss) OVER w", 1)} AS tss_wow_delta,
         {_round("coalesce(r.total_distance_km, 0) - coalesce(lag(r.total_distance_km) OVER w, 0)", 2)} AS distance_wow_delta_km,
         coalesce(l.week_end_atl > 1.5 * nullif(l.week_end_ctl, 0), false) AS load_spike_flag
  FROM week_load l LEFT JOIN week_runs r ON r.week_start = l.week_start{run_join}
  WINDOW w AS (PARTITION BY l.user_id ORDER BY l.week_start))"""


WEEKLY = _weekly(", user_id", " AND r.user_id = l.user_id")
WEEKLY_ALL = _weekly("", "")


def _averages() -> str:
    columns = [("recovery_score", "recovery_score_7d_avg", "w7", 1), ("strain_score", "strain_score_7d_avg", "w7", 1)]
    columns += [("sleep_performance_pct", "sleep_performance_7d_avg", "w7", 1), ("total_sleep_hours", "sleep_hours_7d_avg", "w7", 2)]
    columns += [("hrv_rmssd_milli", "hrv_7d_avg", "w7", 1), ("resting_heart_rate", "resting_hr_7d_avg", "w7", 1)]
    columns += [("recovery_score", "recovery_score_28d_avg", "w28", 1), ("strain_score", "strain_score_28d_avg", "w28", 1)]
    columns += [("sleep_performance_pct", "sleep_performance_28d_avg", "w28", 1), ("hrv_rmssd_milli", "hrv_28d_avg", "w28", 1)]
    return ", ".join(f"{_round(f'avg({c}) OVER {w}', digits)} AS {out}" for c, out, w, digits in columns)


_TRENDS = f"""SELECT CAST(cycle_date AS VARCHAR) AS cycle_date, user_id, strain_score, recovery_score,
       sleep_performance_pct, total_sleep_hours, hrv_rmssd_milli, resting_heart_rate, sws_hours,
       rem_hours, recovery_bucket, sleep_quality_label, {_averages()},
       recovery_score - lag(recovery_score) OVER w AS recovery_score_dod,
       strain_score - lag(strain_score) OVER w AS strain_score_dod,
       hrv_rmssd_milli - lag(hrv_rmssd_milli) OVER w AS hrv_dod
FROM daily
WINDOW w AS (PARTITION BY user_id ORDER BY cycle_date),
       w7 AS (PARTITION BY user_id ORDER BY cycle_date ROWS 6 PRECEDING),
       w28 AS (PARTITION BY user_id ORDER BY cycle_date ROWS 27 PRECEDING)"""

_STREAMED = f"""scored AS (
  SELECT *, CAST(date_trunc('week', ts) AS DATE) AS week_start,
         CASE WHEN event_type <> 'error' THEN (cents % 2101) / 100.0 END AS strain FROM ev),
loads AS (SELECT *, {_round("coalesce(strain, 0.0) * (100.0 / 21.0)", 2)} AS tss FROM scored)
SELECT CAST(week_start AS VARCHAR) AS week_start, CAST(week_start + 6 AS VARCHAR) AS week_end, user_id, count(*) AS tracked_days,
       {_round("sum(tss)", 1)} AS total_weekly_tss, {_round("avg(tss)", 1)} AS avg_daily_tss,
       arg_max_null((cents % 700) / 10.0, (ts, event_id)) AS week_end_ctl,
       arg_max_null((cents % 1100) / 10.0, (ts, event_id)) AS week_end_atl,
       arg_max_null((cents % 300) / 10.0, (ts, event_id)) AS week_end_tsb,
       arg_max_null(concat('form', k % 5), (ts, event_id)) AS week_end_form,
       arg_max_null(CASE WHEN k >= 10 THEN event_type END, (ts, event_id)) AS fitness_phase,
       {_round("avg(CASE WHEN event_type <> 'signup' THEN (k % 101) / 1.0 END)", 1)} AS avg_recovery,
       {_round("avg((cents % 12000) / 100.0)", 1)} AS avg_hrv_rmssd, {_round("avg((k % 25 + 40) / 1.0)", 1)} AS avg_rhr,
       {_round("avg((k % 30) / 10.0)", 2)} AS avg_monotony, count(*) FILTER (strain >= 10) AS hard_days,
       count(*) FILTER (coalesce(strain, 0) < 5) AS easy_or_rest_days
FROM loads GROUP BY week_start, user_id"""

_LIFETIME = f"""SELECT d.user_id, count(DISTINCT cycle_date) AS total_tracked_days,
       CAST(min(cycle_date) AS VARCHAR) AS first_tracked_date,
       CAST(max(cycle_date) AS VARCHAR) AS latest_tracked_date,
       {_round("avg(recovery_score)", 1)} AS avg_recovery_score,
       {_round("max(recovery_score)", 1)} AS peak_recovery_score,
       {_round("avg(strain_score)", 1)} AS avg_strain_score,
       {_round("max(strain_score)", 1)} AS peak_strain_score,
       {_round("avg(sleep_performance_pct)", 1)} AS avg_sleep_performance_pct,
       {_round("avg(total_sleep_hours)", 2)} AS avg_sleep_hours,
       {_round("avg(hrv_rmssd_milli)", 1)} AS avg_hrv_rmssd_milli,
       {_round("max(hrv_rmssd_milli)", 1)} AS peak_hrv_rmssd_milli,
       any_value(u.first_name) AS first_name, any_value(u.last_name) AS last_name,
       any_value(u.email) AS email, epoch_us(TIMESTAMP '2024-02-01') AS dbt_updated_at
FROM daily d LEFT JOIN users u ON u.user_id = d.user_id
WHERE recovery_score IS NOT NULL GROUP BY d.user_id"""

_WORKOUT_RECOVERY = f"""workout_recovery AS (
  SELECT w.* EXCLUDE (loaded_at),
         coalesce(w.zone_3_min, 0) + coalesce(w.zone_4_min, 0) + coalesce(w.zone_5_min, 0)
           AS high_intensity_min, {_NEXT_DAY}, w.loaded_at
  FROM workouts w LEFT JOIN daily n ON n.user_id = w.user_id AND n.cycle_date - 1 = w.workout_date)"""

_CAPPED = f"""WITH days AS (
  SELECT o_custkey AS user_id, CAST(o_orderdate AS DATE) AS d,
         CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) / 1000000.0 AS x
  FROM orders GROUP BY 1, 2)
SELECT t.user_id, CAST(t.d AS VARCHAR) AS cycle_date, any_value(t.x) AS day_load,
       {_round("sum(h.x * (1 - exp(-1.0/42)) * exp(-(t.d - h.d) / 42.0))", 4)} AS ctl,
       {_round("sum(h.x * (1 - exp(-1.0/7)) * exp(-(t.d - h.d) / 7.0))", 4)} AS atl
FROM days t JOIN days h ON h.user_id = t.user_id AND h.d BETWEEN t.d - 180 AND t.d
GROUP BY t.user_id, t.d"""

_NEXT_DAY_JOIN = """WITH o AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS o_date, o_totalprice FROM orders),
days AS (SELECT o_date AS d, count(*) AS n,
                CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) / 100.0 AS total
         FROM o GROUP BY 1)
SELECT o_orderkey, o_custkey, CAST(o_date AS VARCHAR) AS o_date, o_totalprice,
       s.n AS same_day_n, s.total AS same_day_total, x.n AS next_day_n, x.total AS next_day_total,
       x.n - s.n AS delta
FROM o LEFT JOIN days s ON s.d = o_date LEFT JOIN days x ON x.d = o_date + 1"""

_NEAREST_CLICK = f"""SELECT l.event_id, epoch_us(l.ts) AS ts, CAST(l.d AS VARCHAR) AS d, l.user_id, l.event_type,
       l.cents, r.event_id AS click_id, epoch_us(r.ts) AS click_ts, r.cents AS click_cents
FROM ev l LEFT JOIN ev r ON r.user_id = l.user_id AND r.d = l.d AND r.event_type = 'click'
WHERE l.event_type = 'purchase'
QUALIFY row_number() OVER (PARTITION BY l.event_id ORDER BY {_GAP.format(l="l.ts", r="r.ts")}, r.event_id) = 1"""

_NEAREST_ANY = f"""SELECT l.event_id, epoch_us(l.ts) AS ts, CAST(l.d AS VARCHAR) AS d, l.event_type,
       r.event_id AS signup_id
FROM ev l LEFT JOIN ev r ON r.d = l.d AND r.event_type = 'signup'
WHERE l.event_type = 'purchase'
QUALIFY row_number() OVER (PARTITION BY l.event_id ORDER BY {_GAP.format(l="l.ts", r="r.ts")}, r.event_id) = 1"""

_MERGE = """WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, o_totalprice, lower(o_orderstatus) AS s FROM orders),
bound AS (SELECT max(d) - 7 AS b FROM o WHERE d < DATE '2001-06-01')
SELECT o_orderkey, CAST(d AS VARCHAR) AS o_date,
       CASE WHEN d >= b THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice,
       CASE WHEN d >= b THEN s END AS o_note
FROM o, bound"""

_MERGED = """WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, o_totalprice, lower(o_orderstatus) AS s FROM orders),
bound AS (SELECT max(d) FILTER (d < DATE '2001-06-01') - 7 AS b, max(d) - 7 AS c FROM o)
SELECT o_orderkey, CAST(d AS VARCHAR) AS o_date,
       CASE WHEN d >= c THEN o_totalprice * 4 WHEN d >= b THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice,
       CASE WHEN d >= b THEN s END AS o_note
FROM o, bound"""

def _counted(names: str, start: int = 0, kind: str = "BIGINT", when: str = "full_score") -> str:
    """Each name as the count of the event plus its own number, in rows that have it."""
    return ", ".join(f"CASE WHEN {when} THEN CAST(k + {start + i} AS {kind}) END AS {name}" for i, name in enumerate(names.split()))


_LAND = """land AS (
  SELECT *, epoch_us(ts) AS t, event_type IN ('signup', 'purchase') AS full_score,
         CAST(event_type NOT IN ('click', 'view') AS VARCHAR) AS has_score FROM ev)"""
_SHARED = """user_id, t AS start, t AS "end", '+01:00' AS timezone_offset, 'SCORED' AS score_state, t AS loaded_at, has_score"""
_CONFORM = {
    "conform_cycles": f"""SELECT event_id AS id, {_SHARED}, {_counted("strain kilojoule", kind="DOUBLE")},
       {_counted("average_heart_rate max_heart_rate", 2)} FROM land""",
    "conform_sleeps": f"""SELECT CAST(event_id AS VARCHAR) AS id, k AS cycle_id, cents AS v1_id, CAST(k > 50 AS VARCHAR) AS nap, {_SHARED},
       has_score AS has_stage_summary, has_score AS has_sleep_needed,
       {_counted("total_in_bed_time_milli total_awake_time_milli total_no_data_time_milli total_light_sleep_time_milli "
                 "total_slow_wave_sleep_time_milli total_rem_sleep_time_milli sleep_cycle_count disturbance_count")},
       {_counted("baseline_milli need_from_sleep_debt_milli need_from_recent_strain_milli need_from_recent_nap_milli", 10)},
       {_counted("respiratory_rate sleep_performance_percentage sleep_consistency_percentage sleep_efficiency_percentage", 20, "DOUBLE")}
FROM land""",
    "conform_recoveries": f"""SELECT event_id AS cycle_id, CAST(k AS VARCHAR) AS sleep_id, t AS created_at, t AS updated_at,
       {_SHARED.replace('t AS start, t AS "end", ', "").replace("'+01:00' AS timezone_offset, ", "")},
       CASE WHEN full_score THEN CAST(k > 50 AS VARCHAR) END AS user_calibrating,
       {_counted("recovery_score resting_heart_rate hrv_rmssd_milli spo2_percentage skin_temp_celsius", kind="DOUBLE")} FROM land""",
    "conform_workouts": f"""SELECT CAST(event_id AS VARCHAR) AS id, cents AS v1_id, k AS sport_id, event_type AS sport_name, {_SHARED},
       {_counted("strain", kind="DOUBLE")}, {_counted("average_heart_rate max_heart_rate", 1)},
       {_counted("kilojoule percent_recorded distance_meter altitude_gain_meter altitude_change_meter", 3, "DOUBLE")},
       CAST(full_score AND k < 80 AS VARCHAR) AS has_zone_duration,
       {_counted("zone_zero_milli zone_one_milli zone_two_milli zone_three_milli zone_four_milli zone_five_milli", 10, when="full_score AND k < 80")}
FROM land""",
    "conform_runs": f"""SELECT event_id AS id, concat('Run ', k) AS name, t AS start_date, t AS loaded_at,
       CASE event_type WHEN 'click' THEN 'Run' WHEN 'view' THEN 'TrailRun' ELSE 'VirtualRun' END AS sport_type,
       {_counted("distance_meter", kind="DOUBLE", when="true")}, {_counted("moving_time_sec elapsed_time_sec", 1, when="true")},
       {_counted("total_elevation_gain_meter average_speed_ms max_speed_ms average_heartrate max_heartrate average_cadence suffer_score",
                 3, "DOUBLE", "true")},
       CASE WHEN event_type <> 'click' THEN concat('p', k) END AS summary_polyline
FROM land WHERE event_type IN ('click', 'view', 'signup')""",
    "conform_photos": """SELECT event_id AS id,
       CASE WHEN event_type = 'view' THEN concat('u', event_id)
            WHEN event_type IN ('error', 'purchase') THEN concat('Lu', event_id) END AS primary_photo_url,
       CASE event_type WHEN 'click' THEN 0 WHEN 'view' THEN 2 ELSE 1 END AS photo_count,
       epoch_us(ts) AS loaded_at
FROM ev""",
}

_AUDIT = """audit AS (
  SELECT concat('source', k % 10) AS endpoint, event_type = 'error' AND k % 10 < 7 AS failed,
         CASE WHEN event_type = 'error' THEN 0 ELSE cents END AS n FROM ev),
summary AS (
  SELECT endpoint, count(*) AS loads, CAST(sum(n) AS BIGINT) AS rows_fetched,
         CAST(sum(n) AS BIGINT) AS rows_inserted, count(*) FILTER (failed) AS failed_loads
  FROM audit GROUP BY endpoint)"""

_FRESHNESS = """newest AS (
  SELECT 'raw_cycles' AS name, max(ts) AS seen, 25 AS warn, 49 AS err FROM ev
  UNION ALL SELECT 'raw_sleeps', max(ts), 25, 49 FROM ev WHERE ts < DATE '2024-01-30'
  UNION ALL SELECT 'raw_recoveries', max(ts), 25, 49 FROM ev WHERE event_type <> 'error' AND ts < DATE '2024-01-29'
  UNION ALL SELECT 'raw_workouts', NULL, 25, 49
  UNION ALL SELECT 'raw_users', max(ts), 25, 49 FROM ev
  UNION ALL SELECT 'raw_strava_runs', max(ts), 49, 97 FROM ev WHERE ts < DATE '2024-01-28'),
aged AS (SELECT *, date_sub('second', seen, TIMESTAMP '2024-01-30 23:30:00') AS age FROM newest)"""

_QUALITY = """checks AS (
  SELECT 'int_daily_metrics' AS model, 'not_null' AS "check", unnest(['cycle_id', 'user_id', 'cycle_date']) AS "columns", 0 AS failures
  UNION ALL SELECT 'int_daily_metrics', 'unique', 'cycle_id', count(*) - count(DISTINCT cycle_id) FROM daily
  UNION ALL SELECT 'int_training_load', 'not_null', unnest(['cycle_date', 'user_id']), 0
  UNION ALL SELECT 'int_training_load', 'unique', 'user_id, cycle_date', count(*) - count(DISTINCT (user_id, cycle_date)) FROM daily
  UNION ALL SELECT 'orders', 'unique', 'o_custkey, o_day', count(*) FROM
    (SELECT 1 FROM orders GROUP BY o_custkey, CAST(o_orderdate AS DATE) HAVING count(*) > 1)
  UNION ALL SELECT 'raw_workouts', 'not_null', 'id', 0
  UNION ALL SELECT 'raw_workouts', 'not_null', 'sport_name', count(*) FROM ev WHERE event_type = 'error'
  UNION ALL SELECT 'raw_workouts', 'not_null', 'score', count(*) FROM ev WHERE event_type = 'error'
  UNION ALL SELECT 'raw_workouts', 'unique', 'id', count(*) FROM
    (SELECT 1 FROM ev GROUP BY user_id, event_id // 2 HAVING count(*) > 1))"""

SPEEDED = f"""speeded AS (
  SELECT *, {_round("nullif(avg_speed_kmh, 0) * CAST(0.621371 AS DECIMAL(10,6))", 2)} AS speed_mph FROM runs)"""

_HIGHLIGHTS = """c AS (SELECT run_id, run_date, distance_km, speed_mph FROM speeded
      WHERE summary_polyline <> '' AND speed_mph <> 0),
picked AS (
  SELECT 'longest' AS highlight, * FROM (SELECT * FROM c ORDER BY distance_km DESC, run_id LIMIT 1)
  UNION ALL SELECT 'fastest', * FROM (SELECT * FROM c ORDER BY speed_mph DESC, run_id LIMIT 1)
  UNION ALL SELECT 'latest', * FROM (SELECT * FROM c ORDER BY run_date DESC, run_id LIMIT 1))"""

_PERIODS = """SELECT period, count(*) AS run_count, grain FROM (
  SELECT unnest([{'grain': 'year', 'period': strftime(d, '%Y')},
                 {'grain': 'month', 'period': strftime(d, '%Y-%m')},
                 {'grain': 'week', 'period': concat(lpad(CAST(isoyear(d) AS VARCHAR), 4, '0'), '-W', lpad(CAST(week(d) AS VARCHAR), 2, '0'))},
                 {'grain': 'day', 'period': strftime(d, '%Y-%m-%d')}], recursive := true)
  FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders))
GROUP BY period, grain"""


def _slots(period: str, keys: str) -> str:
    group = ", ".join(keys.split())
    return f"""minutes AS (
  SELECT run_id, user_id, run_date, {period},
         CASE WHEN moving_time_min = 0 THEN 1.0 ELSE moving_time_min END AS m FROM runs)
SELECT run_id, {group}, (sum(m) OVER w - m) / sum(m) OVER g AS slot_start,
       sum(m) OVER w / sum(m) OVER g AS slot_end
FROM minutes
WINDOW w AS (PARTITION BY {group} ORDER BY run_date, run_id ROWS UNBOUNDED PRECEDING),
       g AS (PARTITION BY {group})"""


def _haversine(lat1: str, lng1: str, lat2: str, lng2: str) -> str:
    a = (
        f"(pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2}))"
        f" * pow(sin(radians({lng2} - {lng1}) / 2), 2))"
    )
    return f"2 * 6371000.0 * atan2(sqrt{a}, sqrt(1 - {a}))"


STEPS = f"""steps AS (
  SELECT *, coalesce({_haversine("plat", "plng", "lat", "lng")}, 0.0) AS step
  FROM (SELECT *, lag(lat) OVER w AS plat, lag(lng) OVER w AS plng FROM points
        WINDOW w AS (PARTITION BY run_id ORDER BY point_idx))),
lengths AS (
  SELECT *, sum(step) OVER (PARTITION BY run_id ORDER BY point_idx ROWS UNBOUNDED PRECEDING) AS dist,
         count(*) OVER (PARTITION BY run_id) AS n
  FROM steps)"""

# Position at p: the segment after the last point, but one at most, that lies within the target.
_POSITIONS = f"""totals AS (SELECT run_id, n, max(dist) AS total FROM lengths GROUP BY run_id, n),
targets AS (SELECT *, p * total AS target FROM totals, (SELECT unnest([0.0, 0.1, 0.25, 0.5, 0.75, 1.0]::DOUBLE[]) AS p)),
low AS (
  SELECT t.run_id, t.p, t.target, t.n, max(l.point_idx) AS lo
  FROM targets t JOIN lengths l ON l.run_id = t.run_id AND l.dist <= t.target AND l.point_idx <= t.n - 2
  GROUP BY ALL),
ends AS (
  SELECT o.run_id, o.p, o.n, a.lat AS alat, a.lng AS alng, b.lat AS blat, b.lng AS blng,
         CASE WHEN o.p <= 0 THEN 0.0 WHEN b.dist = a.dist THEN 0.0
              ELSE (o.target - a.dist) / (b.dist - a.dist) END AS f
  FROM low o JOIN lengths a ON a.run_id = o.run_id AND a.point_idx = o.lo
  JOIN lengths b ON b.run_id = o.run_id AND b.point_idx = o.lo + 1),
placed AS (
  SELECT e.run_id, e.p,
         CASE WHEN p <= 0 THEN s.lat WHEN p >= 1 THEN z.lat ELSE alat + f * (blat - alat) END AS lat,
         CASE WHEN p <= 0 THEN s.lng WHEN p >= 1 THEN z.lng ELSE alng + f * (blng - alng) END AS lng
  FROM ends e JOIN points s ON s.run_id = e.run_id AND s.point_idx = 0
  JOIN points z ON z.run_id = e.run_id AND z.point_idx = e.n - 1)"""

_ROUTE_SUMMARY = """SELECT run_id, count(*) AS n_points,
       any_value(lat) FILTER (point_idx = 0) AS start_lat, any_value(lng) FILTER (point_idx = 0) AS start_lng,
       any_value(lat) FILTER (point_idx = n // 2) AS middle_lat, any_value(lng) FILTER (point_idx = n // 2) AS middle_lng,
       any_value(lat) FILTER (point_idx = n - 1) AS end_lat, any_value(lng) FILTER (point_idx = n - 1) AS end_lng,
       min(lat) AS min_lat, min(lng) AS min_lng, max(lat) AS max_lat, max(lng) AS max_lng
FROM (SELECT *, count(*) OVER (PARTITION BY run_id) AS n FROM points) GROUP BY run_id"""

_TRACKS = f"""track AS (
  SELECT user_id, event_id, ts, (cents % 1000 + 4000000) / 100000.0 AS lat, (k * 7 - 7000000) / 100000.0 AS lng FROM ev),
steps AS (
  SELECT *, coalesce({_haversine("plat", "plng", "lat", "lng")}, 0.0) AS step
  FROM (SELECT *, lag(lat) OVER w AS plat, lag(lng) OVER w AS plng FROM track
        WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)))
SELECT user_id, event_id,
       {_round("sum(step) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)", 3)} AS distance_m,
       {_round("sum(step) OVER (PARTITION BY user_id)", 3)} AS route_m
FROM steps"""


def _text_time(c: str) -> str:
    return (
        f"concat(strftime({c}, '%Y-%m-%d %H:%M:%S'), CASE WHEN microsecond({c}) % 1000000 = 0 THEN ''"
        f" WHEN microsecond({c}) % 1000 = 0 THEN strftime({c}, '.%g') ELSE strftime({c}, '.%f') END, '+00')"
    )


_DAILY_TIMES = "cycle_start cycle_end sleep_start sleep_end loaded_at"

ORACLES: dict[str, str] = {
    "stg_cycles": _with(EV, CYCLES, select=_show("cycles", "cycle_date", "cycle_start cycle_end loaded_at")),
    "stg_recoveries": _with(
        EV, RECOVERIES,
        select=_show("recoveries", "recovery_date", "created_at updated_at loaded_at", "is_calibrating"),
    ),
    "stg_sleeps": _with(EV, SLEEPS, select=_show("sleeps", "sleep_date", "sleep_start sleep_end loaded_at", "is_nap")),
    "stg_workouts": _with(EV, WORKOUTS, select=_show("workouts", "workout_date", "workout_start workout_end loaded_at")),
    "stg_users": _with(EV, USERS, select=_show("users", "", "loaded_at")),
    "stg_runs": _with(EV, RUNS, select=_show("runs", "run_date", "run_start loaded_at")),
    "latest_events": "SELECT * REPLACE (epoch_us(ts) AS ts) FROM events e WHERE NOT EXISTS (SELECT 1 FROM events f"
    " WHERE f.user_id = e.user_id AND f.event_type = e.event_type AND f.ts > e.ts)",
    "daily_metrics": _with(*_STG_DAILY, select=_show("daily", "cycle_date", _DAILY_TIMES, "is_calibrating")),
    "run_recovery": _with(
        *_RUN_RECOVERY_ALL, select=_show("run_recovery", "run_date", "run_start loaded_at")
    ),
    "workout_recovery": _with(
        *_STG_DAILY, WORKOUTS, _WORKOUT_RECOVERY,
        select=_show("workout_recovery", "workout_date", "workout_start workout_end loaded_at"),
    ),
    "training_load": _with(*_STG_DAILY, LOAD, select=_show("load", "cycle_date")),
    "carried_load": _with(*_STG_DAILY, LOAD, select=_show("load", "cycle_date")),
    "weekly_summary": _with(*_STG_DAILY, LOAD, RUNS, WEEKLY, select=_show("weekly", "week_start week_end load_spike_flag")),
    "weekly_summary_all_users": _with(
        *_STG_DAILY, LOAD, RUNS, WEEKLY_ALL, select=_show("weekly", "week_start week_end load_spike_flag")
    ),
    "rolling_trends": _with(*_STG_DAILY, select=_TRENDS),
    "user_lifetime": _with(*_STG_DAILY, USERS, select=_LIFETIME),
    "capped_load": _CAPPED,
    "next_day_join": _NEXT_DAY_JOIN,
    "nearest_click": _with(EV, select=_NEAREST_CLICK),
    "nearest_any_user": _with(EV, select=_NEAREST_ANY),
    "missing_photos": _with(EV, select="SELECT event_id AS id, row_number() OVER (ORDER BY event_id) AS position FROM ev WHERE event_type = 'error'"),
    "customers_without_orders": "SELECT c_custkey AS o_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders"
    " WHERE o_custkey = c_custkey AND year(o_orderdate) = 1997)",
    "incremental_merge": _MERGE,
    "merged_mart": _MERGED,
    "streamed_weeks": _with(EV, select="").rstrip() + ",\n" + _STREAMED,
    **{name: _with(EV, _LAND, select=select) for name, select in _CONFORM.items()},
    "conform_users": "SELECT c_custkey AS user_id, CAST(NULL AS VARCHAR) AS email, c_name AS first_name,"
    " c_mktsegment AS last_name, epoch_us(TIMESTAMP '2024-02-01') AS loaded_at FROM customer",
    "high_water_marks": "SELECT epoch_us(max(ts)) AS watermark,"
    " count(*) FILTER (ts >= TIMESTAMP '2024-01-15 12:00:00') AS late_rows FROM events",
    "audit_summary": _with(EV, _AUDIT, select="SELECT * FROM summary"),
    "audit_totals": _with(
        EV, _AUDIT,
        select="SELECT CAST(sum(rows_inserted) AS BIGINT) AS total_inserted,"
        " coalesce(string_agg(endpoint, ',' ORDER BY endpoint) FILTER (failed_loads > 0), '') AS failed_endpoints"
        " FROM summary",
    ),
    "source_freshness": _with(
        EV, _FRESHNESS,
        select="SELECT epoch_us(seen) AS max_loaded_at, age AS age_seconds,"
        " CASE WHEN age IS NULL OR age > err * 3600 THEN 'error' WHEN age > warn * 3600 THEN 'warn' ELSE 'pass' END AS status,"
        " name FROM aged",
    ),
    "quality_checks": _with(*_STG_DAILY, _QUALITY, select="SELECT * FROM checks"),
    "period_counts": _PERIODS,
    "highlights": _with(EV, RUNS, SPEEDED, _HIGHLIGHTS, select=_show("picked", "run_date")),
    "speed_scale": _with(
        EV, RUNS, SPEEDED,
        "lim AS (SELECT min(speed_mph) AS lo, max(speed_mph) AS hi FROM speeded WHERE speed_mph <> 0)",
        select="SELECT run_id, avg_speed_kmh, speed_mph, CASE WHEN speed_mph IS NOT NULL THEN"
        " greatest(0.0, least(1.0, (speed_mph - lo) / greatest(hi - lo, 0.1))) END AS speed_position FROM speeded, lim",
    ),
    "speed_range": _with(
        EV, RUNS, SPEEDED,
        select="SELECT coalesce(min(speed_mph), 5.0) AS min_speed, coalesce(max(speed_mph), 10.0) AS max_speed"
        " FROM speeded WHERE speed_mph <> 0",
    ),
    "period_slots": "WITH " + ",\n".join((EV, RUNS, _slots("strftime(run_date, '%Y-%m') AS month", "user_id month"))),
    "period_slots_all_users": "WITH "
    + ",\n".join(
        (EV, RUNS, _slots("concat(isoyear(run_date), '-W', lpad(CAST(week(run_date) AS VARCHAR), 2, '0')) AS week", "week"))
    ),
    "newest_runs": _with(
        EV, RUNS,
        select="SELECT run_id, CAST(run_date AS VARCHAR) AS run_date, distance_km, row_number() OVER (ORDER BY runs.run_date DESC, run_id DESC) AS position FROM runs"
        " ORDER BY runs.run_date DESC, run_id DESC LIMIT 25",
    ),
    "mapped_runs": _with(
        EV, RUNS,
        select="SELECT run_id, CAST(run_date AS VARCHAR) AS run_date, distance_km, row_number() OVER (ORDER BY runs.run_date DESC, run_id DESC) AS position FROM runs WHERE summary_polyline <> ''",
    ),
    "runs_of_a_week": _with(
        EV, RUNS, SPEEDED,
        select="SELECT run_id, CAST(run_date AS VARCHAR) AS run_date, speed_mph, row_number() OVER (ORDER BY coalesce(speed_mph, 0) DESC, run_id) AS rank FROM speeded"
        " WHERE run_date BETWEEN DATE '2024-01-08' AND DATE '2024-01-14'",
    ),
    "polyline_decode": _with(EV, POINTS, select="SELECT run_id, point_idx, lat, lng FROM points"),
    "route_failures": _with(
        EV,
        select="SELECT count(*) FILTER (k % 2 = 0) AS decoded, count(*) FILTER (k % 2 = 1) AS skipped"
        " FROM ev WHERE event_type NOT IN ('signup', 'error')",
    ),
    "route_lengths": _with(
        EV, POINTS, STEPS,
        select=f"SELECT run_id, point_idx, {_round('step', 3)} AS segment_m, {_round('dist', 3)} AS distance_m FROM lengths",
    ),
    "user_tracks": "WITH " + ",\n".join((EV, _TRACKS)),
    "route_positions": _with(
        EV, POINTS, STEPS, _POSITIONS,
        select=f"SELECT run_id, p, {_round('lat', 6)} AS lat, {_round('lng', 6)} AS lng FROM placed",
    ),
    "route_summary": _with(EV, POINTS, select=_ROUTE_SUMMARY),
    "route_bounds": _with(
        EV, POINTS,
        select="SELECT CAST(d AS VARCHAR) AS d, min(lat) AS min_lat, min(lng) AS min_lng, max(lat) AS max_lat,"
        " max(lng) AS max_lng FROM points GROUP BY points.d",
    ),
    "route_centroid": _with(
        EV, POINTS, select=f"SELECT {_round('avg(lat)', 6)} AS lat, {_round('avg(lng)', 6)} AS lng FROM points"
    ),
    "export_runs": _with(
        *_RUN_RECOVERY_ALL,
        select="SELECT * EXCLUDE (same_day_cycle_id, next_day_cycle_id, user_id, matched_workout_id,"
        " matched_sport_name, matched_workout_strain, matched_workout_avg_hr, matched_workout_max_hr,"
        " matched_workout_distance_meter, matched_high_intensity_min)"
        " REPLACE (CAST(run_id AS VARCHAR) AS run_id, CAST(run_date AS VARCHAR) AS run_date,"
        f" {_text_time('run_start')} AS run_start,"
        f" {_text_time('loaded_at')} AS loaded_at) FROM run_recovery",
    ),
    "export_daily_load": _with(
        *_STG_DAILY, LOAD,
        select="SELECT * REPLACE (CAST(cycle_date AS VARCHAR) AS cycle_date, CAST(user_id AS VARCHAR) AS user_id) FROM load",
    ),
    "export_weekly": _with(
        *_STG_DAILY, LOAD, RUNS, WEEKLY,
        select="SELECT * REPLACE (CAST(week_start AS VARCHAR) AS week_start, CAST(week_end AS VARCHAR) AS week_end,"
        " CAST(user_id AS VARCHAR) AS user_id, CAST(load_spike_flag AS VARCHAR) AS load_spike_flag) FROM weekly",
    ),
}
ORACLES["route_point_lengths"] = ORACLES["route_lengths"]
ORACLES["route_point_summary"] = ORACLES["route_summary"]


def _document(rows: str, count: str, order: str) -> str:
    """Rows of an export with their place and the head's time and count, as the document of NOW has them."""
    place = f"row_number() OVER (ORDER BY {order}) AS position"
    return f"SELECT d.*, {place}, '2024-02-01T00:00:00+00:00' AS generated_at, count(*) OVER () AS {count} FROM ({rows}) d"


ORACLES["export_document"] = _document(ORACLES["export_daily_load"], "row_count", "cycle_date, CAST(user_id AS BIGINT)")
# The flag comes back as a JSON truth value.
ORACLES["export_weekly_document"] = _document(ORACLES["export_weekly"], "row_count", "week_start, CAST(user_id AS BIGINT)")
ORACLES["export_runs_document"] = _document(ORACLES["export_runs"], "run_count", "run_date DESC, CAST(run_id AS BIGINT)")
ORACLES["late_and_running"] = _with(
    EV, CYCLES,
    """late AS (
  SELECT *, event_type <> 'error' AND user_id % 2 = 0 AS again, event_type <> 'error' AND user_id % 2 = 0 AND user_id % 3 = 0 AS running
  FROM cyc_versions),
versions AS (
  SELECT cycle, seen AS cycle_end, CASE WHEN event_type <> 'error' THEN cents % 2101 / 100.0 END AS strain,
         seen AS loaded_at, CASE WHEN event_type = 'error' THEN 'PENDING_SCORE' ELSE 'SCORED' END AS state FROM late
  UNION ALL
  SELECT cycle, CASE WHEN NOT running THEN seen END, cents % 2101 / 100.0 + 1, TIMESTAMP '2024-02-01', 'SCORED' FROM late WHERE again),
best AS (
  SELECT *, row_number() OVER (PARTITION BY cycle ORDER BY loaded_at DESC, strain DESC NULLS LAST, state DESC, cycle_end DESC NULLS LAST) AS n FROM versions)""",
    select="SELECT cycle AS cycle_id, epoch_us(cycle_end) AS cycle_end, strain AS strain_score, epoch_us(loaded_at) AS loaded_at,"
    " (SELECT count(*) FROM late WHERE again AND (running OR seen >= (SELECT max(seen) FROM late))) AS rows_from_mark"
    " FROM best WHERE n = 1",
)

_MARKS = """marks AS (
  SELECT 'cycles' AS source, max(ts) AS w, (SELECT count(*) FROM (SELECT 1 FROM ev GROUP BY cycle, user_id, d, event_type)) AS n FROM ev
  UNION ALL SELECT 'sleeps', max(ts), count(*) FROM ev
  UNION ALL SELECT 'recoveries', max(ts), (SELECT count(*) FROM (SELECT 1 FROM ev WHERE event_type <> 'error' GROUP BY cycle, user_id, event_type))
    FROM ev WHERE event_type <> 'error'
  UNION ALL SELECT 'workouts', max(ts + to_minutes(k)), count(*) FROM ev
  UNION ALL SELECT 'runs', max(ts), count(*) FROM ev)"""
ORACLES["source_watermarks"] = _with(EV, _MARKS, select="SELECT source, epoch_us(w) AS watermark FROM marks")
_NIGHTS = """n AS (
  SELECT count(*) AS total, count(*) FILTER (early) AS early, count(*) FILTER (event_type = 'click') AS clicks,
         count(*) FILTER (event_type <> 'view') AS runs, count(*) FILTER (event_type <> 'view' AND early) AS early_runs,
         max(ts) FILTER (event_type <> 'error') AS ended, max(ts) FILTER (event_type <> 'error' AND early) AS early_ended,
         max(ts) AS seen, max(ts) FILTER (early) AS early_seen,
         max(ts) FILTER (event_type <> 'view') AS ran, max(ts) FILTER (event_type <> 'view' AND early) AS early_ran
  FROM (SELECT *, ts < TIMESTAMP '2024-01-16' AS early FROM ev)),
sources AS (
  SELECT unnest([
    {'endpoint': 'cycles', 'a': early, 'b': total, 'x': early_ended, 'y': ended},
    {'endpoint': 'sleeps', 'a': early, 'b': total, 'x': early_ended, 'y': ended},
    {'endpoint': 'recoveries', 'a': early, 'b': total, 'x': early_seen, 'y': seen},
    {'endpoint': 'workouts', 'a': early, 'b': total, 'x': early_ended, 'y': early_ended},
    {'endpoint': 'strava_runs', 'a': early_runs, 'b': runs, 'x': early_ran, 'y': ran}], recursive := true), clicks FROM n),
nights AS (
  SELECT *, TIMESTAMP '2024-02-01' + to_days(night) AS t, night = 1 AND endpoint = 'workouts' AS failed
  FROM sources, (SELECT unnest([0, 1, 2]) AS night))"""
ORACLES["audit_records"] = _with(
    EV, _NIGHTS,
    select="""SELECT endpoint, epoch_us(t) AS started_at, epoch_us(t) AS ended_at,
       CASE WHEN failed THEN 0 WHEN night = 0 THEN a ELSE b END AS rows_fetched,
       CASE WHEN failed OR night = 2 THEN 0 WHEN night = 0 THEN a ELSE b END AS rows_inserted,
       epoch_us(CASE night WHEN 1 THEN x WHEN 2 THEN y END) AS watermark_start,
       CASE WHEN NOT failed THEN epoch_us(t) END AS watermark_end,
       CASE WHEN failed THEN 'failed' ELSE 'success' END AS status,
       CASE WHEN failed THEN concat('raw_workouts.user_id is missing in ', clicks, ' rows') END AS error_msg,
       CAST(night < 2 AS VARCHAR) AS kept
FROM nights""",
)
ORACLES["loaded_rows"] = _with(
    EV,
    """e AS (SELECT *, ts < TIMESTAMP '2024-01-16' AS early, event_type = 'error' AS open FROM ev),
times AS (SELECT epoch_us(TIMESTAMP '2024-02-01') AS one, epoch_us(TIMESTAMP '2024-02-02') AS two)""",
    select="""SELECT unnest(['raw_cycles', 'raw_sleeps']) AS name, count(*) + count(*) FILTER (early) AS n, count(*) AS keys,
       count(*) FILTER (open) + count(*) FILTER (open AND early) AS running, any_value(two) AS newest FROM e, times
UNION ALL SELECT 'raw_recoveries', count(*) + count(*) FILTER (early), count(*), 0, any_value(two) FROM e, times
UNION ALL SELECT 'raw_workouts', count(*), count(*), count(*) FILTER (open), any_value(one) FROM e, times WHERE early
UNION ALL SELECT 'raw_strava_runs', count(*) + count(*) FILTER (early), count(*), 0, any_value(two) FROM e, times WHERE event_type <> 'view'
UNION ALL SELECT 'raw_users', count(*) + count(*) FILTER (early), count(DISTINCT user_id), 0, any_value(two) FROM e, times
UNION ALL SELECT 'raw_strava_photos', 0, 0, 0, NULL""",
)


def _checks() -> str:
    """Every declared check, on the models as written in SQL."""
    held = {
        "stg_raw_cycles": "cycles", "stg_raw_sleeps": "sleeps", "stg_raw_recoveries": "recoveries", "stg_raw_workouts": "workouts",
        "stg_strava_runs": "runs", "stg_raw_users": "users", "int_daily_metrics": "daily", "int_run_recovery": "run_recovery",
        "int_workout_recovery": "workout_recovery", "int_training_load": "load", "fct_daily": "daily", "dim_user": "lifetime",
        "fct_runs": "run_recovery", "fct_workouts": "workout_recovery", "my_trends": "trends", "fct_weekly_training_summary": "weekly",
    }
    parts = []
    for model, columns in NOT_NULL.items():
        key = UNIQUE.get(model) or GRAIN[model]
        parts += [f"""SELECT '{model}' AS model, 'not_null' AS "check", '{c}' AS "columns", count(*) - count({c}) AS failures FROM {held[model]}""" for c in columns]
        parts.append(f"SELECT '{model}', 'unique', '{', '.join(key)}', count(*) - count(DISTINCT ({', '.join(key)})) FROM {held[model]}")
    return "\nUNION ALL ".join(parts)


ORACLES["build_checks"] = _with(
    *_RUN_RECOVERY_ALL, USERS, _WORKOUT_RECOVERY, LOAD, WEEKLY, f"lifetime AS ({_LIFETIME})", f"trends AS ({_TRENDS})",
    select=_checks(),
)
ORACLES["required_gaps"] = _with(
    EV,
    "gaps AS (SELECT count(*) FILTER (event_type = 'error') AS n FROM ev)",
    select="""SELECT 'raw_sleeps' AS "table", unnest(['id', 'user_id', 'loaded_at']) AS "column", unnest([0, n, n]) AS missing FROM gaps
UNION ALL SELECT 'raw_workouts', unnest(['id', 'user_id', 'loaded_at']), unnest([0, n, n]) FROM gaps
UNION ALL SELECT 'raw_users', unnest(['user_id', 'loaded_at']), unnest([n, n]) FROM gaps
UNION ALL SELECT 'raw_strava_runs', unnest(['id', 'loaded_at']), unnest([0, n]) FROM gaps""",
)
