"""Largest-Triangle-Three-Buckets down-sampling, exact and distributed.

The point of a bucket with the largest triangle is meant exactly: times are whole microseconds, bucket means are correctly
rounded sums divided by the count, and areas are compared as real numbers, first as floats with a bound on their error,
then, between points that are too close for that, as whole numbers. Equal areas go to the first point. So the choice
does not depend on how a series was cut into pieces, also on ramps, steps and constants, where rounding would decide.

For a given previous point and next-bucket mean, the area is the absolute value of a linear function of the candidate
point, so its maximum over a bucket lies on the bucket's convex hull; of points on one edge of the hull the first is a
corner (or the first of its time, which is kept too). Chunks of a long series are reduced to such points (plus exact
bucket sums for the means) in parallel; the sequential walk over the buckets then sees only those few points.
"""

from collections.abc import Sequence
from fractions import Fraction
from math import fsum

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.layout import (
    HOT_ROWS,
    POSITION,
    TOTAL,
    key_starts,
    over_sorted,
    per_key_rows,
    sorted_positions,
    split_hot,
)
from millrace.schemas import DECIMATE_ABOVE, DECIMATE_TO, DEVICE, TIME, VALUE

_CHUNK = 65_536
_SMALL = 64
_BUNDLE = 16
_ERROR = 2.0**-49  # bounds the relative error of a difference of two products of differences
_LOW_BITS = 20
_LOW = (1 << _LOW_BITS) - 1


def _whole(y: np.ndarray, least: int | None = None) -> tuple[np.ndarray, int]:
    """``y`` as Python integers times a power of two, and its exponent (at most 0)."""
    part, exponent = np.frexp(y)
    number, exponent = (part * 2.0**53).astype(np.int64), exponent.astype(np.int64) - 53
    used = exponent[number != 0]
    low = min([0, *([int(used.min())] if len(used) else []), *([] if least is None else [least])])
    shift = np.where(number == 0, 0, exponent - low)
    return np.array([a << b for a, b in zip(number.tolist(), shift.tolist())], dtype=object), low


class _Points:
    """Points of one bucket, as floats and, once they are needed, as whole numbers."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.x, self.y, self._exact = x, y, None

    def exact(self) -> tuple[np.ndarray, np.ndarray, int]:
        if self._exact is None:
            self._exact = np.array([int(v) for v in self.x], dtype=object), *_whole(self.y)
        return self._exact

    def outside(self, rows: np.ndarray, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        """The rows strictly left of the line a -> b, and about how far."""
        x, y = self.x, self.y
        first, second = (x[b] - x[a]) * (y[rows] - y[a]), (y[b] - y[a]) * (x[rows] - x[a])
        side = first - second
        # Written so that an overflow counts as open too.
        open_ = np.flatnonzero(~(np.abs(side) > _ERROR * (np.abs(first) + np.abs(second))))
        if len(open_):
            x, y, low = self.exact()
            at = rows[open_]
            exact = (x[b] - x[a]) * (y[at] - y[a]) - (y[b] - y[a]) * (x[at] - x[a])
            # The sign survives: of a number too small for a float the smallest one is left.
            unit = 1 << max(-low, max(int(v).bit_length() for v in exact) - 900)
            side[open_] = [(v > 0) * max(v / unit, 5e-324) for v in exact]
        left = side > 0
        return rows[left], side[left]


def _extremes(points: _Points, keep: np.ndarray, rows: np.ndarray, a: int, b: int) -> None:
    """Mark the hull points left of the line a -> b (quickhull step on the row numbers ``rows``).

    A row is only left out if it is exactly on or inside the lines between kept rows, so no corner is lost.
    """
    stack = [(rows, a, b)]
    while stack:
        rows, a, b = stack.pop()
        if a == b:
            continue
        rows, side = points.outside(rows, a, b)
        if len(rows):
            far = rows[np.argmax(side)]
            keep[far] = True
            rows = rows[rows != far]
            stack += [(rows, a, far), (rows, far, b)]


def hull_rows(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Mask of the convex hull corners of points that are ordered by ``x`` (whole numbers below 2^53), of the first and
    the extreme points of the first and the last time, and of the first of equal points."""
    n = len(x)
    x = x.astype(np.float64)
    keep = np.zeros(n, dtype=bool)
    left = np.flatnonzero(x == x[0])
    right = np.flatnonzero(x == x[-1])
    for side in (left, right):
        keep[[side[0], side[np.argmin(y[side])], side[np.argmax(y[side])]]] = True
    rows = np.flatnonzero((x > x[0]) & (x < x[-1]))
    if (y == y[0]).all():
        return keep
    top = left[np.argmax(y[left])], right[np.argmax(y[right])]
    low = left[np.argmin(y[left])], right[np.argmin(y[right])]
    # Equal points: the first of them is met first, the others are then on a line that begins at it.
    points = _Points(x, y)
    _extremes(points, keep, rows, top[0], top[1])
    _extremes(points, keep, rows, low[1], low[0])
    return keep


def _exact_parts(values: list[float]) -> list[float]:
    """A few numbers with exactly the same sum."""
    parts, rest = [], values
    while True:
        top = fsum(rest)
        if top == 0:
            return parts
        parts.append(top)
        rest = [*values, *(-p for p in parts)]


def _reduce(table: pa.Table, part: Sequence[str]) -> pa.Table:
    """Hull points of every bucket in rows sorted by ``part`` and place; the bucket's sums move to its first point."""
    n = table.num_rows
    starts = key_starts(table, [*part, "_bucket"])
    ends = np.append(starts[1:], n)
    keep = np.ones(n, dtype=bool)
    x, y = table.column("_x").to_numpy(), table.column("_y").to_numpy()
    for start, end in zip(starts, ends):
        if end - start > _SMALL:
            keep[start:end] = hull_rows(x[start:end] - x[start], y[start:end])
    for c in ("_high", "_low", "_n"):
        sums = np.zeros(n, dtype=np.int64)
        sums[starts] = np.add.reduceat(table.column(c).to_numpy(), starts)
        table = table.set_column(table.column_names.index(c), c, pa.array(sums))
    sums, given = [[]] * n, table.column("_sy").to_pylist()
    for start, end in zip(starts.tolist(), ends.tolist()):
        sums[start] = _exact_parts([v for part in given[start:end] for v in part])
    table = table.set_column(table.column_names.index("_sy"), "_sy", pa.array(sums, pa.list_(pa.float64())))
    return table.filter(pa.array(keep))


def _largest(x: np.ndarray, y: np.ndarray, a: int, rows: slice, mean_x: float, mean_y: float) -> int:
    """The first row of ``rows`` with the largest triangle over row ``a`` and the mean, compared exactly."""
    ax, ay = int(x[a]), float(y[a])
    dx = (x[rows] - ax).astype(np.float64)
    first, second = (ax - mean_x) * (y[rows] - ay), dx * (mean_y - ay)
    area = np.abs(first + second)
    error = _ERROR * (np.abs(first) + np.abs(second))
    # A product may be too small or too large for a float.
    error[((first == 0) & (y[rows] != ay)) | ~np.isfinite(area)] = np.inf
    near = np.flatnonzero(~(area + error < np.fmax.reduce(area - error)))
    if len(near) > 1 and error[near].any():
        p, q = Fraction(ax) - Fraction(mean_x), Fraction(mean_y) - Fraction(ay)
        scale = max(p.denominator, q.denominator)
        numbers, low = _whole(np.append(y[rows][near], ay))
        to_x = np.array([int(v) for v in (x[rows][near] - ax)], dtype=object)
        exact = np.abs(int(p * scale) * (numbers[:-1] - numbers[-1]) + (int(q * scale) << -low) * to_x)
        near = near[exact == exact.max()]
    return rows.start + int(near[0])


def _choose(x: np.ndarray, y: np.ndarray, bucket: np.ndarray, high, low, n, sums: list[list[float]]) -> list[int]:
    """Row numbers of the sample: first row, the largest triangle of each inner bucket, last row. ``sums``: numbers for
    each bucket whose exact sum is that of its values."""
    starts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
    ends = np.append(starts[1:], len(bucket))
    count, highs, lows = (np.add.reduceat(v, starts).tolist() for v in (n, high, low))
    chosen = [0]
    for i in range(1, len(starts) - 1):
        mean_x = ((highs[i + 1] << _LOW_BITS) + lows[i + 1]) / count[i + 1]
        mean_y = fsum(sums[i + 1]) / count[i + 1]
        chosen.append(_largest(x, y, chosen[-1], slice(int(starts[i]), int(ends[i])), mean_x, mean_y))
    chosen.append(len(bucket) - 1)
    return chosen


def bucket_of(position, length, samples: int):
    """Bucket 0..samples - 1 of a row: the ends stand alone, an inner row is in bucket
    ceil(position / width) with width = (length - 2) / (samples - 2), computed in integers."""
    inner = (position * (samples - 2) - 1) // (length - 2) + 1
    return np.where(position == 0, 0, np.where(position == length - 1, samples - 1, inner))


def lttb(
    df: DataFrame, k: str = DEVICE, t: str = TIME, v: str = VALUE, samples: int = DECIMATE_TO,
    threshold: int = DECIMATE_ABOVE, tie: Sequence[str] = (), hot_rows: int = HOT_ROWS, chunk: int = _CHUNK,
) -> DataFrame:
    """(device, time, value) of at most ``samples`` points for each series longer than ``threshold``.

    Shorter series pass unchanged. Rows without a finite value are left out. The result depends neither on ``hot_rows``
    nor on ``chunk``; rows of one time need ``tie`` for an order.
    """
    if samples < 3:
        raise ValueError("samples must be at least 3")
    points = df.select(
        k, t, *tie, F.col(v).cast("double").alias("_y"), F.unix_micros(F.col(t).cast("timestamp")).alias("_x"),
    ).filter(F.col("_x").isNotNull() & (F.abs("_y") < float("inf")))
    limit = max(threshold, samples)
    cold, hot = split_hot(points, k, max(hot_rows, limit))
    schema = f"`{k}` {df.schema[k].dataType.simpleString()}, `{t}` {df.schema[t].dataType.simpleString()}, `{v}` double"

    def sample(table: pa.Table, start: int, end: int) -> np.ndarray:
        n = int(end - start)
        if n <= limit:
            return np.arange(start, end)
        x, y = (table.column(c).slice(start, n).to_numpy() for c in ("_x", "_y"))
        bucket = bucket_of(np.arange(n), n, samples)
        edges = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), n).tolist()
        sums = [y[a:b].tolist() for a, b in zip(edges[:-1], edges[1:])]
        return start + np.array(_choose(x, y, bucket, x >> _LOW_BITS, x & _LOW, np.ones(n, np.int64), sums))

    done = per_key_rows(cold, k, ["_x", *tie], sample, [k, t, "_x", "_y"]).drop("_x").withColumnRenamed("_y", v)
    if hot is None:
        return done

    ready = sorted_positions(hot, k, ["_x", *tie]).select(
        k, t, POSITION, TOTAL, F.floor(F.col(POSITION) / chunk).cast("long").alias("_part"),
        F.lit(0).cast("long").alias("_bucket"), "_x", "_y", F.shiftright("_x", _LOW_BITS).alias("_high"),
        F.col("_x").bitwiseAND(F.lit(_LOW)).cast("long").alias("_low"), F.array("_y").alias("_sy"),
        F.lit(1).cast("long").alias("_n"),
    )

    # Many chunks, buckets and devices share a call, so a series that was cut into small pieces does not pay for each.
    def reduce_chunks(table: pa.Table, _: np.ndarray) -> pa.Table:
        buckets = bucket_of(table.column(POSITION).to_numpy(), table.column(TOTAL).to_numpy(), samples)
        return _reduce(table.set_column(table.column_names.index("_bucket"), "_bucket", pa.array(buckets)), part)

    # A bucket can span many chunks: its hull points are reduced once more before the walk.
    part = [k, "_part"]
    hulls = over_sorted(ready, part, [POSITION], reduce_chunks, ready.schema)
    bundles = hulls.withColumn("_part", F.floor(F.col("_bucket") / _BUNDLE).cast("long"))
    corners = over_sorted(bundles, part, [POSITION], lambda table, _: _reduce(table, part), ready.schema)

    def walk(table: pa.Table, starts: np.ndarray) -> pa.Table:
        x, y, bucket, high, low, n = (table.column(c).to_numpy() for c in ("_x", "_y", "_bucket", "_high", "_low", "_n"))
        given, chosen = table.column("_sy").to_pylist(), []
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), table.num_rows]):
            edges = [*(a + np.flatnonzero(np.append(True, np.diff(bucket[a:b]) != 0))).tolist(), b]
            sums = [[v for row in given[c:d] for v in row] for c, d in zip(edges[:-1], edges[1:])]
            rows = _choose(x[a:b], y[a:b], bucket[a:b], high[a:b], low[a:b], n[a:b], sums)
            chosen += [a + row for row in rows]
        return table.take(pa.array(chosen)).select([k, t, "_y"]).rename_columns([k, t, v])

    return done.unionByName(over_sorted(corners, [k], [POSITION], walk, schema))
