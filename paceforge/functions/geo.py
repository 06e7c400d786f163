"""Great-circle distance as a column, and the decoder of encoded route lines."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from paceforge.functions.units import ColumnLike, column

# Fixed values.
EARTH_RADIUS_M = 6371000.0
NANOMETRES = 1e9
POINT_SCALE = 1e5
CHAR_OFFSET = 63
CHAR_BITS = 5
LONGEST_NUMBER = 12


def haversine_m(lat1: ColumnLike, lng1: ColumnLike, lat2: ColumnLike, lng2: ColumnLike) -> Column:
    """Metres between two points given in degrees."""
    phi1, phi2 = F.radians(column(lat1)), F.radians(column(lat2))
    half_dphi = F.radians(column(lat2) - column(lat1)) / 2
    half_dlng = F.radians(column(lng2) - column(lng1)) / 2
    sine_lat, sine_lng = F.sin(half_dphi), F.sin(half_dlng)
    chord = sine_lat * sine_lat + F.cos(phi1) * F.cos(phi2) * sine_lng * sine_lng
    chord = F.least(F.lit(1.0), F.greatest(F.lit(0.0), chord))  # rounding can leave the range at opposite points
    return F.lit(2 * EARTH_RADIUS_M) * F.atan2(F.sqrt(chord), F.sqrt(1 - chord))


def decode_lines(lines: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Latitudes and longitudes of each encoded line, and whether it could not be decoded.

    Works on a whole batch of lines at once, on the bytes of its Arrow buffer.

    A line is a row of numbers, each a run of 5-bit groups of which all but the last have bit 32
    set. The low bit of a number is its sign, and latitudes and longitudes alternate, each as the
    difference to the one before. A line is bad when it ends inside a number, has a latitude
    without its longitude, or holds something that is no ASCII character or no 64-bit number.
    """
    texts = lines.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, dtype=np.uint8)
    raw = raw[offsets[0] : offsets[-1]]
    starts, ends = offsets[:-1] - offsets[0], offsets[1:] - offsets[0]
    sizes = ends - starts
    n_lines = len(texts)

    groups = raw.astype(np.int64) - CHAR_OFFSET
    closing = groups < 32
    line_of = np.repeat(np.arange(n_lines), sizes)
    # The last byte of a line always closes a number, so that numbers never run into the next line.
    cut_short = np.zeros(n_lines, dtype=bool)
    filled = sizes > 0
    last = ends[filled] - 1
    cut_short[filled] = ~closing[last]
    closing[last] = True

    number_end = np.flatnonzero(closing)
    number_start = np.concatenate([[0], number_end[:-1] + 1]).astype(np.int64)[: len(number_end)]
    number_size = number_end - number_start + 1
    place = np.arange(len(groups)) - np.repeat(number_start, number_size)
    bits = (groups & 31) << (CHAR_BITS * np.minimum(place, LONGEST_NUMBER - 1))
    numbers = np.add.reduceat(bits, number_start) if len(number_start) else bits
    deltas = np.where(numbers & 1, ~(numbers >> 1), numbers >> 1)
    number_line = line_of[number_end]

    failed = cut_short.copy()
    per_line = np.bincount(number_line, minlength=n_lines)
    failed |= per_line % 2 == 1
    failed[number_line[number_size > LONGEST_NUMBER]] = True
    failed[line_of[raw > 127]] = True

    good = ~failed[number_line]
    deltas, per_line = deltas[good], np.where(failed, 0, per_line)
    point_counts = per_line // 2
    lats, lngs = deltas[0::2].cumsum(), deltas[1::2].cumsum()
    first = np.concatenate([[0], point_counts.cumsum()])
    # Running sums go on through the batch; take off what they had reached before each line.
    lats = lats - np.repeat(np.concatenate([[0], lats])[first[:-1]], point_counts)
    lngs = lngs - np.repeat(np.concatenate([[0], lngs])[first[:-1]], point_counts)

    def as_list(values: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(values / POINT_SCALE))

    return as_list(lats), as_list(lngs), pa.array(failed)


def line_distances(lats: pa.ListArray, lngs: pa.ListArray) -> tuple[pa.ListArray, pa.ListArray]:
    """Metres from the point before, and from the start, for every point of each line."""
    starts = np.asarray(lats.offsets)[:-1].astype(np.int64)
    sizes = np.diff(np.asarray(lats.offsets))
    phi, lam = np.radians(np.asarray(lats.values)), np.radians(np.asarray(lngs.values))
    steps = np.zeros(len(phi))
    if len(phi) > 1:
        half_dphi, half_dlam = np.diff(phi) / 2, np.diff(lam) / 2
        chord = np.sin(half_dphi) ** 2 + np.cos(phi[:-1]) * np.cos(phi[1:]) * np.sin(half_dlam) ** 2
        chord = np.clip(chord, 0.0, 1.0)  # rounding can leave the range at opposite points
        steps[1:] = 2 * EARTH_RADIUS_M * np.arctan2(np.sqrt(chord), np.sqrt(1 - chord))
    steps[starts[sizes > 0]] = 0.0
    # Whole nanometres: the sums go on through the batch, and what they had reached before a line comes off exactly.
    totals = np.round(steps * NANOMETRES).astype(np.int64).cumsum()
    reached = np.concatenate([np.zeros(1, np.int64), totals])[starts]
    from_start = (totals - np.repeat(reached, sizes)) / NANOMETRES
    offsets = lats.offsets
    return (
        pa.ListArray.from_arrays(offsets, pa.array(steps)),
        pa.ListArray.from_arrays(offsets, pa.array(from_start)),
    )
