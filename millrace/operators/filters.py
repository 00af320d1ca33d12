"""Filters and projections on series and device tables."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.scalars import finite, interval, parse_ts
from millrace.operators.stats import latest_per_device
from millrace.schemas import CURVE_FLOOR, DEVICE, OUTLIER, RANGE_INTERVALS, TIME
from millrace.session import stage


def newer_than(df: DataFrame, t: str, mark_ms: int | None) -> DataFrame:
    """Rows strictly after a stored mark (epoch ms, none = 0); compares with a literal, so it is pushed down.

    ``t`` is either an epoch-ms number or a timestamp.
    """
    mark = mark_ms or 0
    kind = df.schema[t].dataType.typeName()
    if kind == "timestamp":
        return df.filter(F.col(t) > F.timestamp_millis(F.lit(mark)))
    if kind == "timestamp_ntz":
        return df.filter(F.col(t) > F.timestamp_millis(F.lit(mark)).cast("timestamp_ntz"))
    return df.filter(F.col(t) > mark)


def not_outlier(df: DataFrame, flag: str = OUTLIER) -> DataFrame:
    """Keep unflagged rows; a missing flag counts as not flagged."""
    return df.filter(~F.coalesce(F.col(flag), F.lit(False)))


def for_device(df: DataFrame, device, k: str = DEVICE) -> DataFrame:
    return df.filter(F.col(k) == F.lit(device))


def trailing_range(df: DataFrame, range_key: str, k: str = DEVICE, t: str = TIME) -> DataFrame:
    """Rows of each device in a period that ends at the device's own latest row, both ends included."""
    if range_key not in RANGE_INTERVALS:
        return df
    latest = stage(latest_per_device(df, k, t), "latest")
    cutoff = F.col("latest_measurement") - interval(RANGE_INTERVALS[range_key])
    return df.join(latest, k).filter(F.col(t).between(cutoff, F.col("latest_measurement"))).drop("latest_measurement")


def trailing_range_of(df: DataFrame, device, range_key: str, k: str = DEVICE, t: str = TIME) -> DataFrame:
    """The same for one device: the device filter reaches the scan and the cutoff is a scalar subquery."""
    rows = for_device(df, device, k)
    if range_key not in RANGE_INTERVALS:
        return rows
    latest = rows.agg(F.max(t)).scalar()
    return rows.filter(F.col(t).between(latest - interval(RANGE_INTERVALS[range_key]), latest))


def histogram_window(as_of: Column, hours: int, kind: str = "timestamp") -> tuple[Column, Column | None]:
    """Half-open window of ``hours`` that ends at the full hour of ``as_of``; (1970, None) = unlimited."""
    if hours <= 0:
        return F.timestamp_millis(F.lit(0)).cast(kind), None
    end = F.date_trunc("hour", as_of).cast(kind)
    return end - interval(f"INTERVAL {hours} HOURS"), end


def curve_floor(df: DataFrame, v: str = "flow_avg_day", floor: float = CURVE_FLOOR) -> DataFrame:
    """Finite values from ``floor`` on."""
    return df.filter(finite(v) >= floor)


def split_active(devices: DataFrame) -> tuple[DataFrame, DataFrame]:
    return devices.filter("is_active"), devices.filter(~F.coalesce(F.col("is_active"), F.lit(False)))


def search_devices(
    devices: DataFrame,
    text: str | None = None,
    is_active: bool | None = None,
    columns: tuple[str, ...] = (DEVICE, "name", "location"),
    k: str = DEVICE,
) -> DataFrame:
    """Case-insensitive search; every word of ``text`` must occur in one of the columns."""
    if is_active is not None:
        devices = devices.filter(F.col("is_active") == is_active)
    for word in (text or "").split():
        found = [F.lower(F.col(c).cast("string")).contains(word.lower()) for c in columns]
        devices = devices.filter(F.coalesce(*[F.when(f, True) for f in found], F.lit(False)))
    return devices.orderBy(k)


def mappable(devices: DataFrame, zero_is_missing: bool = True) -> DataFrame:
    """Devices with coordinates; a coordinate of exactly 0 counts as missing unless told otherwise."""
    for c in ("latitude", "longitude"):
        devices = devices.filter(F.col(c).isNotNull())
        if zero_is_missing:
            devices = devices.filter(F.col(c) != 0)
    return devices


def drop_unparsed(df: DataFrame, text: str, t: str, *formats: str) -> DataFrame:
    """Parse ``text`` into ``t`` and drop the rows where that fails."""
    return df.withColumn(t, parse_ts(text, *formats)).filter(F.col(t).isNotNull())


def latest_snapshot(df: DataFrame, k: str = DEVICE, version: str = "updated_at") -> DataFrame:
    """Rows whose version is the newest one of their device."""
    newest = stage(df.groupBy(k).agg(F.max(version).alias("_newest")), "newest")
    return df.join(newest, k).filter(F.col(version) == F.col("_newest")).drop("_newest")


def first_for(df: DataFrame, device, k: str = DEVICE) -> DataFrame:
    return for_device(df, device, k).limit(1)
