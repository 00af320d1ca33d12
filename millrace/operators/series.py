"""Gaps, thinning and mean lines of a series."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.scalars import finite, interval
from millrace.operators.layout import HOT_ROWS, POSITION, TOTAL, over_series, with_position
from millrace.schemas import DEVICE, LONG_GAP, LONG_GAP_RANGES, RANGE_MEAN, SHORT_GAP, TIME, VALUE


def gap_threshold(range_key: str) -> str:
    return LONG_GAP if range_key in LONG_GAP_RANGES else SHORT_GAP


def _with_next(df: DataFrame, k: str, order: Sequence[str], columns: Sequence[str], hot_rows: int) -> DataFrame:
    def compute(rows: DataFrame, part: list[str]) -> DataFrame:
        ordered = Window.partitionBy(*part).orderBy(*order)
        for c in columns:
            rows = rows.withColumn(f"_next_{c}", F.lead(c).over(ordered))
        return rows

    return over_series(df, k, order, 1, compute, hot_rows)


def gap_ranges(
    df: DataFrame, k: str = DEVICE, t: str = TIME, range_key: str = "24h", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """(device, start, end) of neighbouring times further apart than the range's threshold."""
    times = df.select(k, t).filter(F.col(t).isNotNull())
    following = F.col(f"_next_{t}")
    return (
        _with_next(times, k, [t], [t], hot_rows)
        .filter(following - F.col(t) > interval(gap_threshold(range_key)))
        .select(k, F.col(t).alias("gap_start"), following.alias("gap_end"))
    )


def insert_gap_markers(
    df: DataFrame, range_key: str, decimated: bool, k: str = DEVICE, t: str = TIME, v: str = VALUE,
    tie: Sequence[str] = (), hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Finite points plus a break (null value, ``is_gap``) halfway into each gap whose next value is present and finite.

    A decimated series gets breaks only in the long ranges.
    """
    order = [t, *tie]
    rows = _with_next(df.select(k, *order, finite(v).alias(v)).filter(F.col(t).isNotNull()), k, order, [t, v], hot_rows)
    following = F.col(f"_next_{t}")
    wide = (
        (following - F.col(t) > interval(gap_threshold(range_key)))
        & F.col(f"_next_{v}").isNotNull()
        & F.lit(range_key in LONG_GAP_RANGES or not decimated)
    )
    point = F.struct(F.col(t).alias("t"), F.col(v).alias("v"), F.lit(False).alias("is_gap"))
    halfway = F.col(t) + (following - F.col(t)) / 2
    marker = F.struct(halfway.alias("t"), F.lit(None).cast("double").alias("v"), F.lit(True).alias("is_gap"))
    return (
        rows.filter(F.col(v).isNotNull())
        .select(k, F.explode(F.when(wide, F.array(point, marker)).otherwise(F.array(point))).alias("p"))
        .select(k, F.col("p.t").alias(t), F.col("p.v").alias(v), F.col("p.is_gap").alias("is_gap"))
    )


def stride_sample(
    df: DataFrame, limit: int | None, k: str = DEVICE, t: str = TIME, tie: Sequence[str] = (),
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Every step-th row of a series longer than ``limit``; step = length div limit, so it may be 1."""
    if not limit:
        return df
    placed = with_position(df, k, [t, *tie], hot_rows)
    step = F.greatest(F.lit(1), F.floor(F.col(TOTAL) / limit))
    keep = (F.col(TOTAL) <= limit) | (F.col(POSITION) % step == 0)
    return placed.filter(keep).drop(POSITION, TOTAL)


def mean_line(df: DataFrame, stats: DataFrame, range_key: str, k: str = DEVICE, t: str = TIME) -> DataFrame:
    """The range's mean at each time of the series; nothing for a range without one or a missing mean."""
    column = RANGE_MEAN.get(range_key)
    if column is None:
        return df.select(k, t, F.lit(None).cast("double").alias("mean")).limit(0)
    mean = stats.select(k, F.col(column).alias("mean")).filter(F.col("mean").isNotNull() & ~F.isnan("mean"))
    return df.select(k, t).join(mean, k)
