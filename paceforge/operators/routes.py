"""Routes: points, distances, positions and bounds for all runs at once."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paceforge.functions.geo import NANOMETRES, decode_lines, haversine_m, line_distances
from paceforge.operators.running import previous_row, running_sum, sliced

#: Bytes of lines that are decoded together.
DECODED_BYTES = 1_000_000


def decoded_routes(
    runs: DataFrame, key: str = "run_id", line: str = "summary_polyline", keep: Sequence[str] = ()
) -> DataFrame:
    """Every run that has a line, with its points as arrays and a flag for a bad line; ``keep`` names other columns."""
    return _decoded(runs, key, line, {"lats": "array<double>", "lngs": "array<double>"}, keep)


def measured_routes(runs: DataFrame, key: str = "run_id", line: str = "summary_polyline") -> DataFrame:
    """One row per point of every run with the distances of ``cumulative_distance``.

    A line is one value, so its distances are found while it is decoded, and no point is shuffled.
    """
    arrays = dict.fromkeys(("lats", "lngs", "segments", "distances"), "array<double>")
    decoded = _decoded(runs, key, line, arrays)
    at = F.posexplode(F.arrays_zip(*arrays)).alias("point_idx", "at")
    points = decoded.select(key, at, F.element_at("distances", -1).alias("route_m"), *arrays)
    before = F.col("point_idx") - 1

    def earlier(name: str) -> Column:
        return F.get(F.col(name), before)

    return points.where(F.col("at").isNotNull()).select(
        key,
        "point_idx",
        F.col("at.lats").alias("lat"),
        F.col("at.lngs").alias("lng"),
        F.when(before >= 0, F.struct(earlier("lats").alias("lat"), earlier("lngs").alias("lng"))).alias("previous"),
        F.col("at.segments").alias("segment_m"),
        F.coalesce(earlier("distances"), F.lit(0.0)).alias("begun_m"),
        F.col("at.distances").alias("distance_m"),
        "route_m",
        (F.col("point_idx") == F.size("distances") - 1).alias("is_last"),
    )


def _decoded(runs: DataFrame, key: str, line: str, arrays: Mapping[str, str], keep: Sequence[str] = ()) -> DataFrame:
    lined = runs.where(F.col(line).isNotNull() & (F.col(line) != "")).select(key, line, *keep)
    names = [key, *arrays, "failed", *keep]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in _bounded(whole)):
            lats, lngs, failed = decode_lines(batch.column(1))
            columns = [lats, lngs]
            if "distances" in arrays:
                columns += line_distances(lats, lngs)
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns, failed, *batch.columns[2:]], names=names)

    fields = ", ".join(f"{name} {kind}" for name, kind in arrays.items())
    key_type = lined.schema[key].dataType.simpleString()
    kept = "".join(f", `{c}` {lined.schema[c].dataType.simpleString()}" for c in keep)
    return lined.mapInArrow(decode, f"`{key}` {key_type}, {fields}, failed boolean{kept}")


def _bounded(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows of a batch in parts of bounded text, one row at the least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + DECODED_BYTES, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def points_of(decoded: DataFrame, key: str = "run_id") -> DataFrame:
    """One row per point of the decoded routes; bad lines give none."""
    points = F.posexplode(F.arrays_zip("lats", "lngs")).alias("point_idx", "point")
    return decoded.select(key, points).select(
        key, "point_idx", F.col("point.lats").alias("lat"), F.col("point.lngs").alias("lng")
    )


def route_points(runs: DataFrame, key: str = "run_id", line: str = "summary_polyline") -> DataFrame:
    """One row per point of every run; no line, an empty one or a bad one gives none."""
    return points_of(decoded_routes(runs, key, line), key)


def decode_failures(decoded: DataFrame) -> DataFrame:
    """Number of decoded and of skipped routes, as one row."""
    return decoded.agg(
        F.count_if(~F.col("failed")).alias("decoded"), F.count_if("failed").alias("skipped")
    )


def cumulative_distance(
    points: DataFrame,
    keys: Sequence[str] = ("run_id",),
    order: Sequence[str] = ("point_idx",),
    slices: int | None = None,
) -> DataFrame:
    """Add, to every point, its distance from the point before and from the start of the route.

    For points that come as rows; ``measured_routes`` does the same for encoded lines. ``slices``: see ``running.sliced``.
    Distances are added up in whole nanometres. The result also has the previous point, the length of the whole route and a
    mark on its last point.
    """
    paired = previous_row(sliced(points, keys, order, slices), keys, order, ["lat", "lng"], "previous")
    step = haversine_m("previous.lat", "previous.lng", "lat", "lng")
    measured = paired.withColumn("segment_m", F.coalesce(step, F.lit(0.0)))
    measured = measured.withColumn("__nm", F.round(F.col("segment_m") * NANOMETRES).cast("bigint"))
    sums = ("begun_m", "distance_m", "route_m")
    summed = running_sum(measured, keys, order, "__nm", *sums, "is_last", placed=True)
    metres = {name: F.col(name) / NANOMETRES for name in sums}
    return summed.withColumns(metres).select(*points.columns, "previous", "segment_m", *sums, "is_last")


def position_at(
    measured: DataFrame, fractions: Sequence[float], keys: Sequence[str] = ("run_id",)
) -> DataFrame:
    """Position at each fraction of the length of every route, straight within a segment.

    ``measured`` comes from ``measured_routes`` or ``cumulative_distance``. Fractions up to 0 give
    the start and from 1 on the end. Each segment keeps the fractions that fall inside it, its start
    included, so the work is one pass over the segments without join or shuffle. A target that lies
    in no segment is at the very end of its route; there a last segment without length gives its
    start.
    """
    wanted = F.array(*[F.lit(float(p)) for p in fractions])
    is_first, is_last = F.col("previous").isNull(), F.col("is_last")
    here, reached = F.col("distance_m"), F.col("route_m")

    def falls_here(p: Column) -> Column:
        target = p * reached
        inside = ~is_first & (F.col("begun_m") <= target) & (target < here)
        at_end = is_last & ((p >= 1) | (target >= here))
        return F.when(p <= 0, is_first).otherwise(F.when(p < 1, inside).otherwise(False) | at_end)

    p = F.col("p")
    moved = F.try_divide(p * reached - F.col("begun_m"), F.col("segment_m"))
    at_place = (p <= 0) | (p >= 1)

    def placed(axis: str) -> Column:
        start = F.coalesce(F.col(f"previous.{axis}"), F.col(axis))
        along = start + F.coalesce(moved, F.lit(0.0)) * (F.col(axis) - start)
        return F.when(at_place, F.col(axis)).otherwise(along).alias(axis)

    return measured.withColumn("p", F.explode(F.filter(wanted, falls_here))).select(
        *keys, "p", placed("lat"), placed("lng")
    )


def summarize_decoded(decoded: DataFrame, key: str = "run_id") -> DataFrame:
    """Start, middle and end point and bounding box of every decoded route, without a shuffle."""
    n = F.size("lats")
    places = {"start": F.lit(0), "middle": F.floor(n / 2).cast("int"), "end": n - 1}
    return decoded.where(n > 0).select(
        key,
        n.cast("bigint").alias("n_points"),
        *[
            F.get(F.col(f"{axis}s"), at).alias(f"{place}_{axis}")
            for place, at in places.items()
            for axis in ("lat", "lng")
        ],
        *[
            pick(f"{axis}s").alias(f"{name}_{axis}")
            for name, pick in {"min": F.array_min, "max": F.array_max}.items()
            for axis in ("lat", "lng")
        ],
    )


def route_summary(points: DataFrame, keys: Sequence[str] = ("run_id",), order: str = "point_idx") -> DataFrame:
    """The same summary from points that come as rows.

    Point numbers are consecutive from 0, so the middle of n points is number n // 2, found by an
    equi-join on route and number.
    """
    point = F.struct("lat", "lng")
    counted = points.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_points"),
        F.min_by(point, order).alias("start"),
        F.max_by(point, order).alias("end"),
        *_box(),
    )
    middle = points.select(*keys, order, point.alias("middle"))
    return (
        counted.withColumn(order, F.floor(F.col("n_points") / 2).cast("int"))
        .join(middle, [*keys, order], "left")
        .select(
            *keys,
            "n_points",
            *[
                F.col(f"{place}.{axis}").alias(f"{place}_{axis}")
                for place in ("start", "middle", "end")
                for axis in ("lat", "lng")
            ],
            "min_lat",
            "min_lng",
            "max_lat",
            "max_lng",
        )
    )


def _box() -> list[Column]:
    return [
        F.min("lat").alias("min_lat"),
        F.min("lng").alias("min_lng"),
        F.max("lat").alias("max_lat"),
        F.max("lng").alias("max_lng"),
    ]


def bounds(points: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Bounding box of all points, or of each group of them."""
    return points.groupBy(*keys).agg(*_box())


def bounds_of_routes(decoded: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The same from decoded routes: each route gives its own box, and no point becomes a row."""
    boxes = decoded.where(F.size("lats") > 0).select(
        *keys,
        *[pick(f"{axis}s").alias(f"{name}_{axis}") for name, pick in {"min": F.array_min, "max": F.array_max}.items() for axis in ("lat", "lng")],
    )
    return boxes.groupBy(*keys).agg(
        F.min("min_lat").alias("min_lat"),
        F.min("min_lng").alias("min_lng"),
        F.max("max_lat").alias("max_lat"),
        F.max("max_lng").alias("max_lng"),
    )


def centroid(points: DataFrame) -> DataFrame:
    """Mean of all points, as one row."""
    return points.agg(F.avg("lat").alias("lat"), F.avg("lng").alias("lng"))
