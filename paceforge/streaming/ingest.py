"""The batch ingest and merge as Structured Streaming jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from paceforge.operators.upsert import merge_mart
from paceforge.operators.versions import latest_version
from paceforge.sources.landing import CONFORM, only_runs
from paceforge.sources.schemas import landing_schema


def checkpoint_location(spark: SparkSession, name: str) -> str:
    """Place for the state of a query in the folder that all machines share."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        raise ValueError("spark.checkpoint.dir is not set")
    return f"{shared.rstrip('/')}/{name}"


def stream_landing(spark: SparkSession, kind: str, path: str) -> DataFrame:
    """Landed JSON of one kind, as a stream of raw rows."""
    landed = spark.readStream.schema(landing_schema(kind)).json(path)
    if kind == "runs":
        landed = only_runs(landed)
    return CONFORM[kind](landed, F.current_timestamp())


def drop_repeats(stream: DataFrame, keys: Sequence[str], time: str, delay: str = "2 days") -> DataFrame:
    """Drop rows whose key came before; state is kept for ``delay`` of event time only."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))


def stream_to_table(stream: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Append everything that has landed to a table, then stop."""
    return (
        stream.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .toTable(table)
    )


def stream_to_mart(
    stream: DataFrame, table: str, key: str, date_col: str, checkpoint: str, order: str = "loaded_at"
) -> StreamingQuery:
    """Merge each batch into a mart. A batch that is replayed merges to the same rows.

    A stream shows a row once, so late rows are merged however old they are, and a version only takes the place of one
    that isn't newer.
    """

    def merge(batch: DataFrame, _: int) -> None:
        merge_mart(latest_version(batch, [key], order), table, key, date_col, days=None, version=order)

    return (
        stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
