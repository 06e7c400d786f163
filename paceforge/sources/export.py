"""JSON exports of the modelled tables.

An export is one JSON document, written by many tasks: a text line for the head, one per row and
one for the foot, globally sorted. The part files, read in name order, are the document. No task
holds more than its own range of rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paceforge.operators.running import positions

# Columns of each export in order; "text" columns are written as strings.
RUN_COLUMNS = """
    run_id run_name sport_type run_date run_start distance_km moving_time_min pace_min_per_km
    avg_speed_kmh total_elevation_gain_meter run_avg_hr run_max_hr average_cadence suffer_score
    summary_polyline same_day_strain same_day_avg_hr same_day_recovery same_day_recovery_bucket
    same_day_hrv same_day_sleep_performance same_day_sleep_hours same_day_sleep_quality
    next_day_recovery next_day_recovery_bucket next_day_hrv next_day_resting_hr
    next_day_sleep_performance next_day_sleep_hours next_day_sleep_quality recovery_delta
    primary_photo_url loaded_at
""".split()
DAILY_LOAD_COLUMNS = """
    cycle_date user_id daily_tss strain_score recovery_score hrv_rmssd_milli resting_heart_rate
    ctl atl tsb form_label fitness_phase ctl_7d_delta training_monotony_7d
""".split()
WEEKLY_COLUMNS = """
    week_start week_end user_id tracked_days total_weekly_tss avg_daily_tss week_end_ctl
    week_end_atl week_end_tsb week_end_form fitness_phase avg_recovery avg_hrv_rmssd avg_rhr
    avg_monotony hard_days easy_or_rest_days run_count total_distance_km total_run_minutes
    avg_pace_min_per_km avg_run_hr ctl_wow_delta tss_wow_delta distance_wow_delta_km load_spike_flag
""".split()
TEXT_COLUMNS = {"run_id", "run_date", "run_start", "loaded_at", "cycle_date", "user_id", "week_start", "week_end"}

DAILY_DESCRIPTION = (
    "Training load per day: CTL is fitness over 42 days, ATL fatigue over 7 days, TSB their "
    "difference, from strain scaled to 0-100."
)
WEEKLY_DESCRIPTION = (
    "Training load per week: load at the end of the week, runs, recovery and changes from the "
    "week before."
)


def as_text(df: DataFrame, name: str) -> Column:
    """A key, date or instant as a string; an instant has its fraction in groups of three."""
    c = F.col(name)
    if not isinstance(df.schema[name].dataType, (T.TimestampType, T.TimestampNTZType)):
        return c.cast("string")
    full = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return F.concat(F.regexp_replace(full, r"\.000000$|000$", ""), F.lit("+00"))


def export_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns of an export, keys and times as strings."""
    return df.select(*[as_text(df, c).alias(c) if c in TEXT_COLUMNS else F.col(c) for c in columns])


def json_document(
    df: DataFrame,
    columns: Sequence[str],
    order: Sequence[Column],
    now: datetime,
    count_name: str,
    rows_name: str,
    description: str | None = None,
) -> DataFrame:
    """Lines of one JSON document, (position, value), with all rows in order; the head is at 0 and the foot comes last.

    Rows are numbered by their place in the order, equal ones in the order of their texts. Commas stand in front of all but the first.
    """
    stamp = now if now.tzinfo else now.replace(tzinfo=timezone.utc)
    texts = [as_text(df, c).alias(c) if c in TEXT_COLUMNS else F.col(c) for c in columns]
    names = [f"__sort_{i}" for i in range(len(order))]
    lines = df.select(*texts, *[c.alias(name) for c, name in zip(order, names)])
    # rows move and are stored as columns, without a name in front of each value
    row = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    placed = positions(lines, [F.asc(name) for name in names], last=("__row", row))
    rows = placed.agg(F.count(F.lit(1))).scalar()
    comma = F.when(F.col("position") == 1, " ").otherwise(",")
    head = {"generated_at": F.lit(stamp.isoformat()), count_name: rows}
    if description is not None:
        head["description"] = F.lit(description)
    opened = F.to_json(F.struct(*[c.alias(name) for name, c in head.items()]))
    first = F.regexp_replace(opened, r"\}$", f',"{rows_name}":[')
    ends = F.array(_line(F.lit(0).cast("bigint"), first), _line(rows + 1, F.lit("]}")))
    body = placed.select("position", F.concat(comma, "__row").alias("value"))
    return body.unionByName(df.sparkSession.range(1).select(F.inline(ends))).orderBy("position")


def _line(position: Column, value: Column) -> Column:
    return F.struct(position.alias("position"), value.alias("value"))


def _newest_first(c: str) -> Column:
    """Sort key that puts the newest date first when sorted upwards, and unknown dates last."""
    return F.coalesce(-F.unix_date(F.col(c)), F.lit(2**31 - 1))


def runs_document(runs: DataFrame, now: datetime) -> DataFrame:
    order = [_newest_first("run_date"), F.col("run_id")]
    return json_document(runs, RUN_COLUMNS, order, now, "run_count", "runs")


def daily_load_document(load: DataFrame, now: datetime, description: str = DAILY_DESCRIPTION) -> DataFrame:
    order = [F.col("cycle_date"), F.col("user_id")]
    return json_document(load, DAILY_LOAD_COLUMNS, order, now, "row_count", "rows", description)


def weekly_document(weekly: DataFrame, now: datetime, description: str = WEEKLY_DESCRIPTION) -> DataFrame:
    order = [F.col("week_start"), F.col("user_id")]
    return json_document(weekly, WEEKLY_COLUMNS, order, now, "row_count", "rows", description)


def parsed_document(document: DataFrame, rows: T.StructType, count_name: str) -> DataFrame:
    """Rows of a document from its own lines, each with its position and the head's time and count."""
    line = F.col("value")
    head = document.where(line.startswith('{"generated_at"')).select(
        F.from_json(F.concat(line, F.lit("]}")), f"generated_at string, {count_name} bigint").alias("head")
    )
    known = head.scalar()
    body = document.where(line.startswith(",") | line.startswith(" "))
    return body.select("position", F.from_json(F.substring(line, F.lit(2), F.length(line)), rows).alias("row")).select(
        "row.*", "position", known["generated_at"].alias("generated_at"), known[count_name].alias(count_name)
    )


def write_document(document: DataFrame, path: str) -> None:
    document.select("value").write.mode("overwrite").text(path)


def export_runs(runs: DataFrame, path: str, now: datetime) -> None:
    write_document(runs_document(runs, now), path)


def export_daily_load(load: DataFrame, path: str, now: datetime) -> None:
    write_document(daily_load_document(load, now), path)


def export_weekly(weekly: DataFrame, path: str, now: datetime) -> None:
    write_document(weekly_document(weekly, now), path)
