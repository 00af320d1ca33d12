"""Per-device aggregates of the cleaned series."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.scalars import finite, interval
from millrace.schemas import DEVICE, OUTLIER, STATS_WINDOWS, TIME, VALUE
from millrace.session import stage


def value_range(df: DataFrame, k: str = DEVICE, v: str = VALUE) -> DataFrame:
    return df.groupBy(k).agg(F.min(v).alias("min_v"), F.max(v).alias("max_v"))


def series_extent(df: DataFrame, k: str = DEVICE, t: str = TIME) -> DataFrame:
    return df.groupBy(k).agg(
        F.count(F.lit(1)).alias("total_measurements"),
        F.min(t).alias("first_measurement"),
        F.max(t).alias("last_measurement"),
    )


def latest_per_device(df: DataFrame, k: str = DEVICE, t: str = TIME) -> DataFrame:
    return df.groupBy(k).agg(F.max(t).alias("latest_measurement"))


def latest(df: DataFrame, device, k: str = DEVICE, t: str = TIME) -> DataFrame:
    return df.filter(F.col(k) == F.lit(device)).agg(F.max(t).alias("latest_measurement"))


def devices_in(df: DataFrame, k: str = DEVICE) -> DataFrame:
    return df.select(k).distinct().orderBy(k)


def batch_mark(df: DataFrame, ms: str = "parent_timestampMsec") -> DataFrame:
    """Greatest instant of a batch, 0 for an empty one."""
    return df.agg(F.coalesce(F.max(ms), F.lit(0).cast("long")).alias("max_ts"))


def trailing_means(
    df: DataFrame, extent: DataFrame, windows: dict[str, str] = STATS_WINDOWS, k: str = DEVICE, t: str = TIME,
    v: str = VALUE,
) -> DataFrame:
    """Means over periods that end at the device's last row, and over all time.

    ``extent`` has one row per device; hand in a staged one, so that the planner knows its size and
    the long side is aggregated map-side without a shuffle of its own.
    """
    def mean(text: str) -> Column:
        return F.avg(F.when(F.col(t) >= F.col("last_measurement") - interval(text), F.col(v)))

    return (
        df.join(extent, k)
        .groupBy(k)
        .agg(
            F.first("total_measurements").alias("total_measurements"),
            F.first("first_measurement").alias("first_measurement"),
            F.first("last_measurement").alias("last_measurement"),
            *[mean(text).alias(name) for name, text in windows.items()],
            F.avg(v).alias("avg_all_time"),
        )
    )


def device_stats(
    clean: DataFrame, as_of: Column | None = None, k: str = DEVICE, t: str = TIME, v: str = VALUE, flag: str = OUTLIER
) -> DataFrame:
    """One row per device: size, first and last time, trailing means. Flagged and null rows do not count."""
    base = clean.filter(F.col(v).isNotNull() & ~F.coalesce(F.col(flag), F.lit(False))).select(k, t, v)
    extent = stage(series_extent(base, k, t), "extent")
    stats = trailing_means(base, extent, k=k, t=t, v=v)
    return stats.withColumn("updated_at", F.current_timestamp() if as_of is None else as_of)


def daily_mean(df: DataFrame, k: str = DEVICE, t: str = TIME, v: str = VALUE) -> DataFrame:
    """Mean per device and calendar day of the session time zone."""
    return (
        df.filter(F.col(v).isNotNull())
        .groupBy(k, F.to_date(t).alias("giorno"))
        .agg(F.avg(v).alias("flow_avg_day"))
    )


def value_bounds(
    df: DataFrame, columns: tuple[str, ...] = (VALUE,), mean: DataFrame | None = None, kind: str = "series",
    k: str = DEVICE,
) -> DataFrame:
    """Axis limits of the finite values. ``mean`` has (device, mean). The top is 1.1 x the greatest of 0, values and mean.

    kind "series": bottom -50 if a value is negative, else 0; kind "curve": the smaller of minimum and 0.
    """
    lowest = [F.min(finite(c)) for c in columns]
    highest = [F.max(finite(c)) for c in columns]
    bounds = df.groupBy(k).agg(
        (F.least(*lowest) if len(columns) > 1 else lowest[0]).alias("_low"),
        (F.greatest(*highest) if len(columns) > 1 else highest[0]).alias("_high"),
    )
    top = F.greatest(F.lit(0.0), F.col("_high"))
    if mean is not None:
        bounds = bounds.join(mean.withColumnRenamed("mean", "_mean"), k, "left")
        top = F.greatest(top, F.col("_mean"))
    bottom = (
        F.when(F.col("_low") < 0, F.lit(-50.0)).otherwise(F.lit(0.0))
        if kind == "series"
        else F.least(F.coalesce(F.col("_low"), F.lit(0.0)), F.lit(0.0))
    )
    return bounds.select(k, bottom.alias("y_min"), (top * 1.1).alias("y_max"))


def time_bounds(df: DataFrame, k: str = DEVICE, t: str = TIME) -> DataFrame:
    return df.groupBy(k).agg(F.min(t).alias("x_min"), F.max(t).alias("x_max"))
