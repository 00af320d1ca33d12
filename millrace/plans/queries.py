"""Read queries of the dashboard: parameters in, DataFrame out."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.scalars import bin_mid, freshness, status_label
from millrace.operators.curve import all_curves as _all_curves
from millrace.operators.dedupe import dedupe_first
from millrace.operators.filters import (
    drop_unparsed,
    for_device,
    mappable,
    search_devices,
    split_active,
    trailing_range_of,
)
from millrace.operators.hampel import hampel
from millrace.operators.histogram import with_percent
from millrace.operators.layout import HOT_ROWS
from millrace.operators.series import stride_sample
from millrace.operators.stats import latest_per_device
from millrace.schemas import (
    CURVE_MAX_POINTS,
    DEVICE,
    OFFLINE_SIGMA,
    OFFLINE_WINDOW,
    OTHER_MAX_POINTS,
    OUTLIER,
    RANGE_MAX_POINTS,
    RAW_VALUE,
    TIME,
    VALUE,
)
from millrace.sources.csvfiles import LINE, read_device_csv


def _required(device):
    if device is None or device == "":
        raise ValueError("id_misuratore is required")
    return device


def series_query(clean: DataFrame, device, range_key: str = "24h", hot_rows: int = HOT_ROWS) -> DataFrame:
    """Q1: a device's rows for a range that ends at its latest row, thinned to the range's size, by time."""
    rows = trailing_range_of(clean, _required(device), range_key).select(DEVICE, TIME, RAW_VALUE, VALUE, OUTLIER)
    limit = RANGE_MAX_POINTS.get(range_key, OTHER_MAX_POINTS)
    return stride_sample(rows, limit, hot_rows=hot_rows).drop(DEVICE).orderBy(TIME)


def curve_query(curve: DataFrame, device, limit: int = CURVE_MAX_POINTS) -> DataFrame:
    """Q2: a device's duration curve by exceedance."""
    rows = for_device(curve, _required(device)).select(DEVICE, "flow_avg_day", "p_exceed")
    return stride_sample(rows, limit, t="p_exceed").drop(DEVICE).orderBy("p_exceed")


def histogram_query(hist: DataFrame, device) -> DataFrame:
    """Q3: a device's newest histogram with percent and bin midpoints."""
    rows = for_device(hist, _required(device))
    newest = rows.filter(F.col("updated_at") == rows.agg(F.max("updated_at")).scalar())
    return (
        with_percent(newest)
        .select("bin_index", "range_start", "range_end", bin_mid("range_start", "range_end").alias("mid"), "count",
                "percent")
        .orderBy("bin_index")
    )


def join_stats(devices: DataFrame, stats: DataFrame, k: str = DEVICE) -> DataFrame:
    """J8: registry with statistics where there are any."""
    return devices.join(stats, k, "left")


def device_detail(devices: DataFrame, stats: DataFrame, clean: DataFrame, device) -> tuple[DataFrame, DataFrame]:
    """Q4: (one row of device and statistics, either part may be missing; the device's last 24 h)."""
    device = _required(device)
    registry = for_device(devices, device).select(
        DEVICE, *[c for c in ("name", "location", "latitude", "longitude", "created_at", "is_active")
                  if c in devices.columns]
    )
    detail = registry.join(for_device(stats, device), DEVICE, "full").withColumn(
        "name", F.coalesce("name", F.lit("Unknown Misuratore"))
    )
    return detail, trailing_range_of(clean, device, "24h").orderBy(TIME)


def join_latest(devices: DataFrame, latest: DataFrame, k: str = DEVICE) -> DataFrame:
    """J9: registry with the latest time of each device, null where it has no rows."""
    return devices.join(latest, k, "left")


def freshness_query(devices: DataFrame, clean: DataFrame, as_of: Column) -> DataFrame:
    """Q5: status of every registered device by the age of its latest row at ``as_of``."""
    return (
        join_latest(devices.select(DEVICE), latest_per_device(clean))
        .select(DEVICE, "latest_measurement", freshness("latest_measurement", as_of).alias("status"))
        .orderBy(DEVICE)
    )


def device_catalogue(devices: DataFrame, view: str = "all", text: str | None = None) -> DataFrame:
    """Q6: registry rows by view (all, active, inactive, map) and optional search text, by id."""
    if view in ("active", "inactive"):
        devices = split_active(devices)[view == "inactive"]
    elif view == "map":
        devices = mappable(devices)
    elif view != "all":
        raise ValueError(f"unknown view {view!r}")
    return search_devices(devices, text).withColumn("status", status_label("is_active"))


def all_curves(devices: DataFrame, curve: DataFrame) -> DataFrame:
    """Q7: curves of all registered devices by exceedance; one without data keeps a row of nulls."""
    return _all_curves(devices, curve).orderBy(DEVICE, "p_exceed")


def clean_files(
    spark: SparkSession, mapping: dict[str, str] | DataFrame, window: int = OFFLINE_WINDOW, n_sigma: float = OFFLINE_SIGMA,
    as_of: Column | None = None, formats: tuple[str, ...] = (), hot_rows: int = HOT_ROWS,
) -> DataFrame | None:
    """Q8: clean the mapped CSV files (device -> path, or a frame of both); None if no file can be read.

    The first row of each readable time is kept (this also drops rows repeated as text).
    """
    rows = read_device_csv(spark, mapping)
    if rows is None:
        return None
    timed = drop_unparsed(rows, "t", TIME, *formats)
    unique = dedupe_first(timed, [DEVICE, TIME], [LINE]).select(DEVICE, TIME, "flow_ls")
    done = hampel(unique, v="flow_ls", window=window, n_sigma=n_sigma, hot_rows=hot_rows)
    return done.withColumn("updated_at", F.current_timestamp() if as_of is None else as_of)
