"""Rolling-median outlier filter (Hampel) per device.

The two medians of a frame are taken on Arrow batches with numpy: as a window expression the second
one needs a lambda per frame cell, which Spark interprets; measured, that is about three times slower.
"""

import bisect
import datetime as dt
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.scalars import clamp, nan_to_null
from millrace.operators.layout import HOT_ROWS, over_series, over_sorted
from millrace.schemas import DEVICE, HAMPEL_SIGMA, HAMPEL_WINDOW, MAD_SCALE, OUTLIER, RAW_VALUE, TIME, VALUE
from millrace.session import bounded, stage


_FRAME_FIELDS = [
    T.StructField("window_median", T.DoubleType()),
    T.StructField("window_mad", T.DoubleType()),
    T.StructField("_inner", T.BooleanType()),
]
_TOUCHED = T.StructField("_touched", T.BooleanType())
_CELLS = 1 << 16  # frame cells in work at a time, to stay in the cache


def frame_stats(values: np.ndarray, starts: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Median of the centred frame of each row, and the median distance to it.

    A frame ends at its series' ends and leaves out NaN; one without values gives NaN. Frames are
    sorted as rows of a matrix, where NaN goes last, so the middle follows from the count.
    """
    n = len(values)
    first = np.repeat(starts, np.diff(np.append(starts, n)))
    beyond = np.repeat(np.append(starts[1:], n), np.diff(np.append(starts, n)))
    reach = np.arange(-radius, radius + 1)
    median, mad = np.empty(n), np.empty(n)
    frames = np.lib.stride_tricks.sliding_window_view(np.pad(values, radius, constant_values=np.nan), len(reach))
    step = max(1, _CELLS // len(reach))
    for a in range(0, n, step):
        b = min(a + step, n)
        at = np.arange(a, b)[:, None] + reach
        inside = (at >= first[a:b, None]) & (at < beyond[a:b, None])
        frame = np.where(inside, frames[a:b], np.nan)
        frame.sort(axis=1)
        count = np.count_nonzero(~np.isnan(frame), axis=1)
        rows, lower, upper = np.arange(b - a), np.maximum(count - 1, 0) // 2, np.minimum(count // 2, len(reach) - 1)
        median[a:b] = (frame[rows, lower] + frame[rows, upper]) / 2
        away = np.abs(frame - median[a:b, None])
        away.sort(axis=1)
        mad[a:b] = (away[rows, lower] + away[rows, upper]) / 2
    return median, mad


def frame_place(starts: np.ndarray, n: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last row of each row's frame."""
    size = np.diff(np.append(starts, n))
    first, last = np.repeat(starts, size), np.repeat(starts + size - 1, size)
    rows = np.arange(n)
    return np.maximum(rows - radius, first), np.minimum(rows + radius, last)


def _with_frame_stats(rows: DataFrame, part: list[str], order: Sequence[str], radius: int) -> DataFrame:
    """Add ``window_median``, ``window_mad``, ``_inner`` (the frame is whole) and, where ``rows`` has
    ``_new``, ``_touched`` (the frame holds a new row)."""
    marks_new = "_new" in rows.columns
    schema = T.StructType([*rows.schema.fields, *_FRAME_FIELDS, *([_TOUCHED] if marks_new else [])])

    def compute(table: pa.Table, starts: np.ndarray) -> pa.Table:
        values = table.column("_v").to_numpy()
        from_, to = frame_place(starts, len(values), radius)
        median, mad = frame_stats(values, starts, radius)
        table = (
            table.append_column("window_median", pa.array(median, from_pandas=True))
            .append_column("window_mad", pa.array(mad, from_pandas=True))
            .append_column("_inner", pa.array(to - from_ == 2 * radius))
        )
        if marks_new:
            seen = np.append(0, np.cumsum(table.column("_new").to_numpy()))
            table = table.append_column("_touched", pa.array(seen[to + 1] > seen[from_]))
        return table

    return over_sorted(rows, part, order, compute, schema)


def _measured(df: DataFrame, v: str) -> DataFrame:
    return df.withColumn("_v", nan_to_null(F.col(v).cast("double")))


def rolling_mad(
    df: DataFrame, k: str = DEVICE, t: str = TIME, v: str = RAW_VALUE, window: int = HAMPEL_WINDOW,
    n_sigma: float = HAMPEL_SIGMA, tie: Sequence[str] = (), hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add ``window_median`` over ``window // 2`` rows on either side, ``window_mad`` (median distance to
    it) and ``thresholds``. Null readings are left out."""
    order, radius = [t, *tie], window // 2

    def compute(rows: DataFrame, part: list[str]) -> DataFrame:
        return _with_frame_stats(rows, part, order, radius)

    done = over_series(_measured(df, v), k, order, radius, compute, hot_rows).drop("_v", "_inner")
    return done.withColumn("thresholds", F.col("window_mad") * (n_sigma * MAD_SCALE))


def rolling_median(
    df: DataFrame, k: str = DEVICE, t: str = TIME, v: str = RAW_VALUE, window: int = HAMPEL_WINDOW,
    tie: Sequence[str] = (), hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add ``window_median`` as a plain window expression: the middle of the sorted frame."""
    order, radius = [t, *tie], window // 2

    def compute(rows: DataFrame, part: list[str]) -> DataFrame:
        frame = Window.partitionBy(*part).orderBy(*order).rowsBetween(-radius, radius)
        values = rows.withColumn("_frame", F.sort_array(F.collect_list("_v").over(frame)))
        n = F.size("_frame")
        lower = F.get("_frame", F.floor((n - 1) / 2).cast("int"))
        upper = F.get("_frame", F.floor(n / 2).cast("int"))
        return values.withColumn("window_median", (lower + upper) / 2).drop("_frame")

    return over_series(_measured(df, v), k, order, radius, compute, hot_rows).drop("_v")


def hampel(
    df: DataFrame, k: str = DEVICE, t: str = TIME, v: str = RAW_VALUE, window: int = HAMPEL_WINDOW,
    n_sigma: float = HAMPEL_SIGMA, edge: str = "truncate", tie: Sequence[str] = (), keep: Sequence[str] = (),
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Cleaned series: raw and smoothed value, outlier flag, window median and threshold (and ``keep`` as is).

    A reading further from its window's median than ``n_sigma`` x 1.4826 x MAD is replaced by the
    median. ``edge="keep"`` leaves the first and last ``window // 2`` rows of a series unchanged.
    The rows are shuffled once, by device (or by block of a hot device).
    """
    if edge not in ("truncate", "keep"):
        raise ValueError(f"edge must be 'truncate' or 'keep', not {edge!r}")
    order, radius = [t, *tie], window // 2
    rows = _measured(df, v).select(k, *order, *keep, "_v")

    def compute(rows: DataFrame, part: list[str]) -> DataFrame:
        return _with_frame_stats(rows, part, order, radius)

    judged = over_series(rows, k, order, radius, compute, hot_rows)
    return _judge(judged, [k, *order, *keep], n_sigma, F.col("_inner") if edge == "keep" else None)


def _judge(rows: DataFrame, carried: Sequence[str], n_sigma: float, allowed: Column | None = None) -> DataFrame:
    """Flag and replace, given ``_v``, ``window_median`` and ``window_mad``; bound the numbers for storage."""
    threshold = F.col("window_mad") * (n_sigma * MAD_SCALE)
    flag = F.coalesce(F.abs(F.col("_v") - F.col("window_median")) > threshold, F.lit(False))
    if allowed is not None:
        flag = flag & allowed
    return rows.withColumn(OUTLIER, flag).select(
        *carried,
        clamp("_v").alias(RAW_VALUE),
        clamp(F.when(F.col(OUTLIER), F.col("window_median")).otherwise(F.col("_v"))).alias(VALUE),
        OUTLIER,
        clamp("window_median").alias("window_median"),
        clamp(threshold).alias("thresholds"),
    )


def reclean(clean: DataFrame, k: str = DEVICE, t: str = TIME, **options) -> DataFrame:
    """Filter the stored raw values of every device again, over the whole history, in one job."""
    return hampel(clean.filter(F.col(t).isNotNull()), k, t, RAW_VALUE, **options)


_FEW_DEVICES = 1_000


def _day_counts(target: DataFrame, span: DataFrame, k: str, t: str) -> DataFrame:
    return (
        target.select(k, F.to_date(t).alias("_day"))
        .join(span, k)
        .groupBy(k, "_day", "_from", "_to")
        .agg(F.count(F.lit(1)).alias("_n"))
    )


def _recent_first(
    target: DataFrame, span: DataFrame, rows: int, k: str, t: str, date: str, recent_days: int
) -> DataFrame:
    """Day counts from the recent partitions; older ones are read only for devices that lack rows there."""
    earliest = span.agg(F.min("_from")).head()[0]
    if earliest is None:
        return _day_counts(target.limit(0), span, k, t)
    edge = F.date_sub(F.lit(earliest), recent_days)
    recent = stage(_day_counts(target.filter(F.col(date) >= edge), span, k, t), "recent-days")
    have = recent.filter("_day < _from").groupBy(k).agg(F.sum("_n").alias("_have"))
    lacking = span.join(have, k, "left").filter(F.coalesce("_have", F.lit(0)) < rows).drop("_have")
    lacking = bounded(lacking, "lacking", _FEW_DEVICES)
    if lacking is None:
        return recent
    return recent.unionByName(_day_counts(target.filter(F.col(date) < edge), lacking, k, t))


def lookback(
    target: DataFrame, new: DataFrame, rows: int, k: str = DEVICE, t: str = TIME, date: str | None = None,
    recent_days: int = 31,
) -> DataFrame:
    """Stored rows that can see, or be seen by, the new rows through at most ``rows`` neighbours.

    Days are counted first, so no device is ranked row by row: per device the answer is every
    whole day that touches the span of the new rows or is needed to reach ``rows`` rows on either
    side of it. Whole days are more than needed, never less, and stay contiguous. If ``target`` is
    partitioned by ``date`` (the day of ``t``), only the partitions in question are read.
    """
    span = stage(
        new.groupBy(k).agg(F.to_date(F.min(t)).alias("_from"), F.to_date(F.max(t)).alias("_to")), "span"
    )
    if date is None:
        days = _day_counts(target, span, k, t)
    else:
        days = _recent_first(target, span, rows, k, t, date, recent_days)
    above, below = F.col("_day") < F.col("_from"), F.col("_day") > F.col("_to")
    others = (Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(k).orderBy(F.col("_day").desc()).rowsBetween(*others)
    later = Window.partitionBy(k).orderBy("_day").rowsBetween(*others)
    nearer_above = F.coalesce(F.sum(F.when(above, F.col("_n"))).over(earlier), F.lit(0))
    nearer_below = F.coalesce(F.sum(F.when(below, F.col("_n"))).over(later), F.lit(0))
    needed = (
        days.withColumns({"_above": nearer_above, "_below": nearer_below})
        .filter(F.when(above, F.col("_above") < rows).when(below, F.col("_below") < rows).otherwise(True))
        .groupBy(k)
        .agg(F.min("_day").alias("_first"), F.max("_day").alias("_last"))
    )
    reach = stage(needed, "reach")
    if date is not None:
        first, last = reach.agg(F.min("_first"), F.max("_last")).head()
        target = target.filter(F.col(date).between(F.lit(first), F.lit(last)))
    return (
        target.join(reach, k)
        .filter(F.to_date(t).between(F.col("_first"), F.col("_last")))
        .drop("_first", "_last")
    )


def needed_days(
    days_in: Callable[[Sequence[dt.date]], DataFrame], days: Sequence[dt.date], extents: DataFrame, new: DataFrame,
    rows: int, k: str = DEVICE, day: str = "event_date", step: int = 31,
) -> DataFrame:
    """(device, day) of the stored rows that can see, or be seen by, new rows through at most ``rows`` neighbours.

    It reads an index of counts, never the series: ``days_in(some days)`` gives (device, day, n) of those days, ``days``
    are all days there are, ``extents`` has (device, first_day, last_day). ``new`` has (device, day) of the new rows.
    For every such pair the answer is the day itself and the days next to it until ``rows`` rows are counted on either
    side. The index is read outwards from the new days, first ``step`` days, then four times as far, each time only for
    the devices that still lack rows and whose extent goes on: a new device reads nothing, and a late row of one device
    opens no day of another. The lists on the driver are days, so they grow with the calendar only.
    """
    days = sorted(days)
    pairs = stage(new.select(k, day).distinct(), "new-days")
    open_ = stage(pairs.join(extents.select(k, "first_day", "last_day"), k), "open-days")
    spark, found, reach = new.sparkSession, None, 0
    place: dict[dt.date, tuple[int, int]] = {}
    limits_of: dict[dt.date, tuple[dt.date, dt.date]] = {}
    while days:
        asked = [r[0] for r in open_.select(day).distinct().collect()]
        if not asked:
            break
        reach = reach * 4 if reach else step
        ring: set[dt.date] = set()
        for d in asked:
            at, (inner_lo, inner_hi) = bisect.bisect_left(days, d), place.get(d, (len(days), 0))
            lo, hi = place[d] = max(0, at - reach), min(len(days), at + reach + 1)
            ring.update(days[lo : min(inner_lo, hi)], days[max(inner_hi, lo) : hi])
            limits_of[d] = min(d, days[lo] if lo < len(days) else d), max(d, days[hi - 1])
        counts = days_in(sorted(ring)).select(k, F.col(day).alias("_at"), "n").join(open_.select(k).distinct(), k)
        found = counts if found is None else counts.unionByName(found)
        found = stage(found.distinct(), "day-counts")
        limits = spark.createDataFrame([(d, *x) for d, x in limits_of.items()], f"{day} date, _lo date, _hi date")
        # Only a series that goes on beyond the days read can lack rows.
        beyond = (F.col("first_day") < F.col("_lo")) | (F.col("last_day") > F.col("_hi"))
        open_ = stage(open_.join(limits, day).filter(beyond), "open-days")
        if open_.isEmpty():
            break
        near = open_.join(found, k).filter(F.col("_at").between(F.col("_lo"), F.col("_hi")))
        have = near.groupBy(k, day).agg(
            F.coalesce(F.sum(F.when(F.col("_at") < F.col(day), F.col("n"))), F.lit(0)).alias("_before"),
            F.coalesce(F.sum(F.when(F.col("_at") > F.col(day), F.col("n"))), F.lit(0)).alias("_after"),
        )
        left = (
            open_.join(have, [k, day], "left").na.fill(0, ["_before", "_after"])
            .filter(((F.col("_before") < rows) & (F.col("first_day") < F.col("_lo")))
                    | ((F.col("_after") < rows) & (F.col("last_day") > F.col("_hi"))))
        )
        open_ = stage(left.select(k, day, "first_day", "last_day"), "open-days")
    own = pairs.select(k, day)
    if found is None:
        return own
    # Of the new days on one side of a stored day, the next one has the fewest rows between, so no other is looked at.
    marked = own.filter(F.col(day).isNotNull()).select(k, F.col(day).alias("_at"), F.lit(None).cast("long").alias("n"))
    both = found.select(k, "_at", "n").withColumn("_new", F.lit(False))
    both = both.unionByName(marked.withColumn("_new", F.lit(True))).groupBy(k, "_at").agg(
        F.sum("n").alias("n"), F.max("_new").alias("_new"))
    others, own_n = (Window.unboundedPreceding, -1), F.coalesce("n", F.lit(0))
    in_order, back = Window.partitionBy(k).orderBy("_at"), Window.partitionBy(k).orderBy(F.col("_at").desc())
    both = both.withColumn("_sum", F.sum(own_n).over(in_order))
    before = F.last(F.when(F.col("_new"), F.col("_sum")), True).over(in_order.rowsBetween(*others))
    after = F.last(F.when(F.col("_new"), F.col("_sum") - own_n), True).over(back.rowsBetween(*others))
    needed = both.withColumns({"_since": F.col("_sum") - own_n - before, "_until": after - F.col("_sum")})
    needed = needed.filter(F.col("n").isNotNull() & ((F.col("_since") < rows) | (F.col("_until") < rows)))
    return own.union(needed.select(k, "_at")).distinct()


def hampel_incremental(
    target: DataFrame, new: DataFrame, k: str = DEVICE, t: str = TIME, v: str = RAW_VALUE,
    window: int = HAMPEL_WINDOW, n_sigma: float = HAMPEL_SIGMA, hot_rows: int = HOT_ROWS, date: str | None = None,
) -> DataFrame:
    """Rows to upsert after ``new`` arrives, so that the stored series equals a full recompute.

    A new row also changes the window of its ``window // 2`` neighbours on both sides, so these are
    filtered again; they need as many rows around them. ``new`` has (device, time, value), one row
    per key; a key that is stored already is replaced. Where an index of days is kept, use ``needed_days`` and
    ``refilter``.
    """
    stored = lookback(target, new.select(k, t), 2 * (window // 2), k, t, date)
    return refilter(stored, new, k, t, v, window, n_sigma, hot_rows)


def refilter(
    stored: DataFrame, new: DataFrame, k: str = DEVICE, t: str = TIME, v: str = RAW_VALUE,
    window: int = HAMPEL_WINDOW, n_sigma: float = HAMPEL_SIGMA, hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``new`` and the stored rows whose frames hold a new row, filtered. ``stored`` has at least ``window - 1`` rows on
    either side of every new row, or all there are; what lies between such stretches may be missing."""
    radius = window // 2
    keys = new.select(k, t)
    rows = (
        stored.select(k, t, F.col(RAW_VALUE).alias("_v")).join(keys, [k, t], "left_anti")
        .withColumn("_new", F.lit(False))
        .unionByName(new.select(k, t, nan_to_null(F.col(v).cast("double")).alias("_v"), F.lit(True).alias("_new")))
    )

    def compute(rows: DataFrame, part: list[str]) -> DataFrame:
        return _with_frame_stats(rows, part, [t], radius)

    # Rows are counted before the join, which would run once more for it; replaced rows count twice.
    counted = stored.select(k).unionByName(new.select(k))
    cleaned = over_series(rows, k, [t], radius, compute, hot_rows, counted).filter("_touched")
    return _judge(cleaned, [k, t], n_sigma)
