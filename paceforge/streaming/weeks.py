"""Weekly load as a stateful event-time aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from paceforge.operators.aggregates import weekly_figures
from paceforge.operators.versions import latest_version

#: A week, and how far its Monday start is from the start of the epoch, a Thursday.
WEEK, MONDAY = "7 days", "4 days"
#: How long a week stays open after the newest row seen.
DELAY = "14 days"


def weekly_load_stream(load: DataFrame, time: str = "ts", user: str = "user_id", order: Column | None = None, delay: str = DELAY) -> DataFrame:
    """The columns of ``weekly_load`` for a stream of load rows with the instant ``time``; ``order`` finds the last row of a week.

    State is kept per user and week until the week lies ``delay`` behind the newest instant of an earlier batch. A row that
    comes for an open week changes it, one for a closed week is dropped, and one without an instant is in no week.
    """
    weeks = (
        load.withWatermark(time, delay)
        .groupBy(F.window(time, WEEK, startTime=MONDAY), user)
        .agg(*weekly_figures(F.col(time) if order is None else order))
    )
    start = F.to_date("window.start").alias("week_start")
    return weeks.select(start, user, *weeks.columns[2:]).withColumn("week_end", F.date_add("week_start", 6))


def write_weeks(weeks: DataFrame, place: str, checkpoint: str) -> StreamingQuery:
    """Write the weeks that each batch has changed to a folder of its own, for all that has landed, then stop.

    A batch that is replayed after a failure writes the same folder again.
    """
    spark = weeks.sparkSession
    spark.createDataFrame([], weeks.schema).write.mode("overwrite").parquet(f"{place}/batch=-1")

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{place}/batch={number}")

    return (
        weeks.writeStream.outputMode("update")
        .foreachBatch(keep)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_weeks(spark: SparkSession, place: str, user: str = "user_id") -> DataFrame:
    """The newest figures of every week that ``write_weeks`` has written to ``place``."""
    return latest_version(spark.read.parquet(place), ["week_start", user], "batch").drop("batch")
