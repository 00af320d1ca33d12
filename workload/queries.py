"""Registered queries: each reads whole supplied tables."""

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.scalars import (
    bin_mid,
    clamp,
    coordinate_label,
    finite,
    fixed,
    fmt_full,
    fmt_iso,
    fmt_short,
    from_ms,
    hour,
    location_label,
    minus_days,
    parse_decimal,
    parse_ts,
    range_label,
    status_label,
    to_ms,
)
from millrace.operators.curve import duration_curve, interpolate_at, registered_only
from millrace.operators.dedupe import concat_series, dedupe_first, dedupe_last, merge_series
from millrace.operators.filters import (
    curve_floor,
    latest_snapshot,
    mappable,
    newer_than,
    not_outlier,
    search_devices,
    trailing_range,
)
from millrace.operators.hampel import hampel, hampel_incremental, reclean, rolling_mad, rolling_median
from millrace.operators.histogram import flow_histogram, with_percent
from millrace.operators.lttb import lttb
from millrace.operators.quality import check_fk, check_not_null, check_unique
from millrace.operators.reshape import explode_events, malformed_parts, pivot_measures
from millrace.operators.rolling import rolling_mean
from millrace.operators.series import gap_ranges, insert_gap_markers, mean_line, stride_sample
from millrace.operators.stats import (
    batch_mark,
    daily_mean,
    device_stats,
    devices_in,
    latest_per_device,
    series_extent,
    time_bounds,
    value_bounds,
    value_range,
)
from millrace.operators.throttle import throttle
from millrace.plans.queries import all_curves, device_catalogue, freshness_query, join_stats
from millrace.schemas import DEVICE, OUTLIER, RAW_VALUE, TIME, VALUE
from millrace.session import stage
from millrace.sinks.tables import advance_mark, insert_ignore, upsert
from workload import streams
from workload.tables import (
    MEASURES,
    customer_devices,
    event_messages,
    events_clean,
    events_raw,
    lineitem_clean,
    orders_clean,
    supplier_devices,
    table,
)

AS_OF = datetime(2024, 1, 31)
DAY = 86_400


def as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp_ntz")


def r6(c: Column | str) -> Column:
    """Six decimals for comparison between engines; the shift moves exact halves off the rounding point."""
    return F.round((F.col(c) if isinstance(c, str) else c) + 3e-8, 6)


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: r6(c) for c in columns})


MEANS = ["avg_24h", "avg_7d", "avg_30d", "avg_360d", "avg_all_time"]
HAMPEL_COLUMNS = [RAW_VALUE, VALUE, "window_median", "thresholds"]


def _stats(clean: DataFrame) -> DataFrame:
    return rounded(device_stats(clean, as_of()), *MEANS)


def _curve(spark: SparkSession, sf: str) -> DataFrame:
    return duration_curve(events_clean(spark, sf), customer_devices(spark, sf))


def _histogram(clean: DataFrame, **options) -> DataFrame:
    return rounded(flow_histogram(clean, as_of=as_of(), **options), "range_start", "range_end")


def _hampel(spark: SparkSession, sf: str, **options) -> DataFrame:
    return rounded(hampel(events_clean(spark, sf), **options), *HAMPEL_COLUMNS)


def _series_ranges(key: str):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        rows = trailing_range(orders_clean(spark, sf), key)
        return stride_sample(rows, 5, tie=["o_orderkey"]).select(DEVICE, TIME, VALUE, OUTLIER, "o_orderkey")

    return run


def q_device_detail(spark: SparkSession, sf: str) -> DataFrame:
    stats = _stats(events_clean(spark, sf)).drop("updated_at")
    return join_stats(customer_devices(spark, sf), stats)


def q_curve_at_80(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(interpolate_at(_curve(spark, sf)), "y_at_x")


def q_curves_all_devices(spark: SparkSession, sf: str) -> DataFrame:
    curves = all_curves(customer_devices(spark, sf), _curve(spark, sf))
    return rounded(curves, "flow_avg_day", "p_exceed")


def q_curve_floor(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(curve_floor(daily_mean(lineitem_clean(spark, sf)), floor=40_000), "flow_avg_day")


def q_curve_thinned(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(
        stride_sample(_curve(spark, sf), 7, t="p_exceed").select(DEVICE, "m", "flow_avg_day", "p_exceed"),
        "flow_avg_day", "p_exceed",
    )


def q_histogram_percent(spark: SparkSession, sf: str) -> DataFrame:
    hist = with_percent(flow_histogram(events_clean(spark, sf), as_of=as_of()))
    return rounded(hist.select(DEVICE, "bin_index", "count", "percent"), "percent")


def q_histogram_midpoint(spark: SparkSession, sf: str) -> DataFrame:
    hist = flow_histogram(events_clean(spark, sf), bins=20, as_of=as_of())
    return rounded(hist.select(DEVICE, "bin_index", bin_mid("range_start", "range_end").alias("mid"), "count"), "mid")


def q_histogram_latest(spark: SparkSession, sf: str) -> DataFrame:
    """Two refreshes of the histogram in one table; the newest one of each device is read."""
    clean = events_clean(spark, sf)
    older = flow_histogram(clean, bins=20, hours=480, as_of=as_of() - F.expr("INTERVAL 10 DAYS"))
    newer = flow_histogram(clean, bins=20, hours=240, as_of=as_of())
    newest = with_percent(latest_snapshot(older.unionByName(newer)))
    return rounded(newest.drop("window_start", "window_end"), "range_start", "range_end", "percent")


def q_hampel_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Clean the rows before a cut, then the rest as an increment; the upserted table equals a full run."""
    clean = events_clean(spark, sf)
    cut = F.lit(datetime(2024, 1, 20)).cast("timestamp_ntz")
    stored = stage(hampel(clean.filter(F.col(TIME) < cut)), "stored")
    new = clean.filter(F.col(TIME) >= cut).select(DEVICE, TIME, RAW_VALUE)
    changed = stage(hampel_incremental(stored, new), "changed")
    return rounded(upsert(stored, changed, [DEVICE, TIME], [TIME]), *HAMPEL_COLUMNS)


def q_reclean(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(reclean(hampel(events_clean(spark, sf), window=5, n_sigma=1.0)), *HAMPEL_COLUMNS)


def q_rolling_median(spark: SparkSession, sf: str) -> DataFrame:
    rows = rolling_median(events_clean(spark, sf), window=25).select(DEVICE, TIME, "window_median")
    return rounded(rows, "window_median")


def q_rolling_mad(spark: SparkSession, sf: str) -> DataFrame:
    rows = rolling_mad(events_clean(spark, sf)).select(DEVICE, TIME, "window_median", "window_mad", "thresholds")
    return rounded(rows, "window_median", "window_mad", "thresholds")


def q_hampel_orders(spark: SparkSession, sf: str) -> DataFrame:
    done = hampel(orders_clean(spark, sf), v=VALUE, window=7, n_sigma=2.0, tie=["o_orderkey"])
    return rounded(done, *HAMPEL_COLUMNS)


def q_pivot_measures(spark: SparkSession, sf: str) -> DataFrame:
    return pivot_measures(events_raw(spark, sf), MEASURES).drop("ts_s")


def q_explode_events(spark: SparkSession, sf: str) -> DataFrame:
    return explode_events(event_messages(table(spark, sf, "events")))


def q_malformed_events(spark: SparkSession, sf: str) -> DataFrame:
    parts = malformed_parts(event_messages(table(spark, sf, "events")))
    return parts.groupBy("part").agg(F.count(F.lit(1)).alias("dropped"))


def q_dedupe_time(spark: SparkSession, sf: str) -> DataFrame:
    rows = lineitem_clean(spark, sf)
    first = dedupe_first(rows, [DEVICE, TIME], [VALUE, OUTLIER])
    return first.select(DEVICE, TIME, VALUE, OUTLIER)


def q_dedupe_time_value(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias(DEVICE), F.col("l_shipdate").alias(TIME), F.col("l_quantity").alias(VALUE),
        F.col("l_extendedprice").alias("price"),
    )
    return dedupe_first(rows, [DEVICE, TIME, VALUE], ["price"])


def q_merge_series(spark: SparkSession, sf: str) -> DataFrame:
    """Two tables with different columns, times as text, some unreadable; united, parsed, de-duplicated."""
    sales = table(spark, sf, "orders").select(
        F.col("o_custkey").alias(DEVICE),
        F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias(TIME),
        F.col("o_totalprice").alias(VALUE),
        F.col("o_orderkey").alias("line"),
    )
    readings = table(spark, sf, "events").select(
        F.col("user_id").alias(DEVICE),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias(TIME),
        F.col("value").alias(VALUE),
        F.col("event_id").alias("line"),
        F.col("event_type").alias("kind"),
    )
    _, unique = merge_series(concat_series(sales, readings), ["line"])
    return unique.withColumn(TIME, F.col(TIME).cast("timestamp_ntz"))


def q_time_bounds(spark: SparkSession, sf: str) -> DataFrame:
    return time_bounds(trailing_range(events_clean(spark, sf), "7d"))


def q_value_bounds(spark: SparkSession, sf: str) -> DataFrame:
    """Customer balances as readings per nation: some are negative."""
    rows = table(spark, sf, "customer").select(F.col("c_nationkey").alias(DEVICE), F.col("c_acctbal").alias(VALUE))
    mean = rows.groupBy(DEVICE).agg((F.avg(VALUE) * 3).alias("mean"))
    series = value_bounds(rows, mean=mean)
    curve = value_bounds(rows, kind="curve").withColumnsRenamed({"y_min": "curve_min", "y_max": "curve_max"})
    return rounded(series.join(curve, DEVICE), "y_min", "y_max", "curve_min", "curve_max")


def q_mean_line(spark: SparkSession, sf: str) -> DataFrame:
    clean = events_clean(spark, sf)
    return rounded(mean_line(trailing_range(clean, "7d"), device_stats(clean, as_of()), "7d"), "mean")


def _gap_markers(range_key: str, decimated: bool):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return insert_gap_markers(events_clean(spark, sf), range_key, decimated).select(DEVICE, TIME, VALUE, "is_gap")

    return run


def q_gap_ranges_long(spark: SparkSession, sf: str) -> DataFrame:
    rows = orders_clean(spark, sf).select(DEVICE, TIME).distinct()
    return gap_ranges(rows, range_key="all")


def q_throttle(spark: SparkSession, sf: str) -> DataFrame:
    return throttle(events_clean(spark, sf), min_seconds=DAY).select(DEVICE, TIME, VALUE)


def q_throttle_blocked(spark: SparkSession, sf: str) -> DataFrame:
    return throttle(events_clean(spark, sf), min_seconds=DAY, hot_rows=40).select(DEVICE, TIME, VALUE)


def q_lttb(spark: SparkSession, sf: str) -> DataFrame:
    return lttb(events_clean(spark, sf), samples=12, threshold=20)


def q_lttb_blocked(spark: SparkSession, sf: str) -> DataFrame:
    return lttb(events_clean(spark, sf), samples=12, threshold=20, hot_rows=50, chunk=24)


def q_freshness(spark: SparkSession, sf: str) -> DataFrame:
    return freshness_query(customer_devices(spark, sf), events_clean(spark, sf), as_of())


def q_device_search(spark: SparkSession, sf: str) -> DataFrame:
    return search_devices(customer_devices(spark, sf), "ING customer#", True)


def q_catalogue(view: str):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return device_catalogue(customer_devices(spark, sf), view)

    return run


def q_mappable(spark: SparkSession, sf: str) -> DataFrame:
    """Nation and balance stand in for coordinates; nation 0 counts as missing."""
    devices = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias(DEVICE),
        F.col("s_name").alias("name"),
        F.col("s_nationkey").cast("double").alias("latitude"),
        F.when(F.col("s_acctbal") > 0, F.col("s_acctbal")).alias("longitude"),
    )
    return mappable(devices).withColumns(
        {"lat_text": coordinate_label("latitude"), "lon_text": coordinate_label("longitude")}
    )


def _urgent(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_totalprice", "o_orderkey", "o_orderstatus")
    return orders.filter(F.col("o_orderstatus") != "F"), orders.filter(F.col("o_orderstatus") == "F")


def q_insert_ignore(spark: SparkSession, sf: str) -> DataFrame:
    keys = ["o_custkey", "o_orderdate"]
    stored, new = _urgent(spark, sf)
    stored = dedupe_first(stored, keys, ["o_orderkey"])
    return stored.unionByName(insert_ignore(stored, new, keys, ["o_orderkey"]))


def q_upsert_latest(spark: SparkSession, sf: str) -> DataFrame:
    keys = ["o_custkey", "o_orderdate"]
    stored, new = _urgent(spark, sf)
    return upsert(dedupe_last(stored, keys, ["o_orderkey"]), new, keys, ["o_orderkey"])


def q_incremental_filter(spark: SparkSession, sf: str) -> DataFrame:
    mark = 1_705_708_800_000  # 2024-01-20T00:00:00Z
    return newer_than(table(spark, sf, "events"), "ts", mark).select("event_id", "user_id", "ts", "value")


def q_batch_mark(spark: SparkSession, sf: str) -> DataFrame:
    return batch_mark(events_raw(spark, sf))


def q_advance_mark(spark: SparkSession, sf: str) -> DataFrame:
    """One mark per measure kind after its batch; a stored mark that is ahead stays."""
    raw = events_raw(spark, sf)
    state = raw.groupBy(F.col("measure_name").alias("job_name")).agg(
        F.max("parent_timestampMsec").alias("last_parent_timestampmsec"), F.current_timestamp().alias("updated_at")
    )
    marks = batch_mark(raw).withColumn("max_ts", F.col("max_ts") + 1)
    return advance_mark(advance_mark(state, "view", marks), "click", marks.withColumn("max_ts", F.lit(0).cast("long"))
                        ).select("job_name", "last_parent_timestampmsec")


def q_check_unique(spark: SparkSession, sf: str) -> DataFrame:
    return check_unique(table(spark, sf, "lineitem"), ["l_suppkey", "l_shipdate"])


def q_check_not_null(spark: SparkSession, sf: str) -> DataFrame:
    stats = device_detail_rows(spark, sf)
    bad = check_not_null(stats, ["total_measurements", "avg_24h"])
    return bad.select(DEVICE, F.array_join("null_columns", ",").alias("null_columns"))


def device_detail_rows(spark: SparkSession, sf: str) -> DataFrame:
    return join_stats(customer_devices(spark, sf), device_stats(events_clean(spark, sf), as_of()))


def q_check_fk(spark: SparkSession, sf: str) -> DataFrame:
    active = customer_devices(spark, sf).filter("is_active")
    return check_fk(events_clean(spark, sf), active)


def q_not_outlier(spark: SparkSession, sf: str) -> DataFrame:
    return not_outlier(events_clean(spark, sf)).select(DEVICE, TIME, VALUE)


def q_registered_only(spark: SparkSession, sf: str) -> DataFrame:
    active = customer_devices(spark, sf).filter("is_active")
    return registered_only(events_clean(spark, sf), active).select(DEVICE, TIME, VALUE)


def q_rolling_mean_24h(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(rolling_mean(events_clean(spark, sf)).select(DEVICE, TIME, "rolling_mean"), "rolling_mean")


def seconds_series(spark: SparkSession, sf: str) -> DataFrame:
    """A dense series for each return flag: one second from row to row, by order and line."""
    rows = table(spark, sf, "lineitem")
    at = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("l_orderkey") * 8 + F.col("l_linenumber"))
    return rows.select(F.col("l_returnflag").alias(DEVICE), at.cast("timestamp_ntz").alias(TIME),
                       F.col("l_quantity").alias(VALUE))


def q_rolling_mean_dense(spark: SparkSession, sf: str) -> DataFrame:
    """Frames of up to 3,600 readings; the busiest device is a hot one."""
    rows = rolling_mean(seconds_series(spark, sf), "INTERVAL 1 HOUR", hot_rows=20_000)
    return rounded(rows.select(DEVICE, TIME, "rolling_mean"), "rolling_mean")


def q_numbers(spark: SparkSession, sf: str) -> DataFrame:
    """Number helpers on order prices: clamp, finite, decimal comma, fixed decimals."""
    price = F.col("o_totalprice")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        clamp("o_totalprice", 50_000.0, 200_000.0).alias("clamped"),
        finite(F.when(F.col("o_orderstatus") == "P", "NaN").otherwise(price.cast("decimal(12,2)").cast("string"))).alias(
            "finite"
        ),
        parse_decimal(F.replace(price.cast("decimal(12,2)").cast("string"), F.lit("."), F.lit(","))).alias("decimal"),
        fixed("o_totalprice", 2).alias("text"),
    )


def q_times(spark: SparkSession, sf: str) -> DataFrame:
    """Time helpers on event times: ms and back, hour, interval, formats."""
    ts = F.col("ts")
    return table(spark, sf, "events").select(
        "event_id",
        to_ms("ts").alias("ms"),
        from_ms(to_ms("ts")).cast("timestamp_ntz").alias("back"),
        hour("ts").cast("timestamp_ntz").alias("hour"),
        minus_days("ts", 30).alias("month_before"),
        fmt_iso("ts").alias("iso"),
        fmt_short("ts").alias("short"),
        fmt_full("ts").alias("full"),
        range_label(minus_days("ts", 7), ts, "7d").alias("label"),
        parse_ts(F.when(F.col("event_type") == "error", "?").otherwise(fmt_full("ts")), "dd/MM/yyyy HH:mm:ss")
        .cast("timestamp_ntz")
        .alias("parsed"),
    )


def q_labels(spark: SparkSession, sf: str) -> DataFrame:
    devices = customer_devices(spark, sf)
    place = F.when(F.col("location") == "BUILDING", F.lit("")).otherwise(F.col("location"))
    return devices.select(
        DEVICE, status_label("is_active").alias("status"), location_label(place).alias("place")
    )


def queries() -> dict:
    return {
        "device_stats": lambda s, d: _stats(events_clean(s, d)),
        "device_stats_orders": lambda s, d: _stats(orders_clean(s, d)),
        "series_extent": lambda s, d: series_extent(lineitem_clean(s, d)),
        "daily_mean": lambda s, d: rounded(daily_mean(lineitem_clean(s, d)), "flow_avg_day"),
        "duration_curve": lambda s, d: rounded(_curve(s, d), "flow_avg_day", "p_exceed"),
        "duration_curve_suppliers": lambda s, d: rounded(
            duration_curve(lineitem_clean(s, d), supplier_devices(s, d).filter("is_active")), "flow_avg_day", "p_exceed"
        ),
        "curve_at_80": q_curve_at_80,
        "curve_floor": q_curve_floor,
        "curve_thinned": q_curve_thinned,
        "curves_all_devices": q_curves_all_devices,
        "value_range": lambda s, d: value_range(lineitem_clean(s, d)),
        "flow_histogram": lambda s, d: _histogram(events_clean(s, d)),
        "flow_histogram_suppliers": lambda s, d: _histogram(lineitem_clean(s, d)),
        "histogram_upper": lambda s, d: _histogram(events_clean(s, d), bins=10, include_upper=True),
        "histogram_windowed": lambda s, d: _histogram(events_clean(s, d), bins=25, hours=240),
        "histogram_percent": q_histogram_percent,
        "histogram_midpoint": q_histogram_midpoint,
        "histogram_latest": q_histogram_latest,
        "rolling_median": q_rolling_median,
        "rolling_mad": q_rolling_mad,
        "hampel": _hampel,
        "hampel_offline_params": lambda s, d: _hampel(s, d, window=50, n_sigma=3.0),
        "hampel_edge_keep": lambda s, d: _hampel(s, d, window=15, n_sigma=2.0, edge="keep"),
        "hampel_blocked": lambda s, d: _hampel(s, d, hot_rows=40),
        "hampel_orders": q_hampel_orders,
        "hampel_incremental": q_hampel_incremental,
        "reclean": q_reclean,
        "pivot_measures": q_pivot_measures,
        "explode_events": q_explode_events,
        "malformed_events": q_malformed_events,
        "dedupe_time": q_dedupe_time,
        "dedupe_time_value": q_dedupe_time_value,
        "merge_series": q_merge_series,
        **{f"series_{key}": _series_ranges(key) for key in ("24h", "7d", "1m", "6m", "1y", "all")},
        "stride_blocked": lambda s, d: stride_sample(
            orders_clean(s, d), 3, tie=["o_orderkey"], hot_rows=8
        ).select(DEVICE, TIME, VALUE, "o_orderkey"),
        "time_bounds": q_time_bounds,
        "value_bounds": q_value_bounds,
        "mean_line": q_mean_line,
        "gap_ranges": lambda s, d: gap_ranges(events_clean(s, d)),
        "gap_ranges_long": q_gap_ranges_long,
        "gap_ranges_blocked": lambda s, d: gap_ranges(events_clean(s, d), range_key="1y", hot_rows=10),
        "gap_markers_short": _gap_markers("7d", False),
        "gap_markers_long": _gap_markers("6m", True),
        "gap_markers_none": _gap_markers("24h", True),
        "throttle": q_throttle,
        "throttle_blocked": q_throttle_blocked,
        "lttb": q_lttb,
        "lttb_blocked": q_lttb_blocked,
        "rolling_mean_24h": q_rolling_mean_24h,
        "rolling_mean_dense": q_rolling_mean_dense,
        "latest_per_device": lambda s, d: latest_per_device(events_clean(s, d)),
        "devices_in": lambda s, d: devices_in(events_clean(s, d)),
        "freshness": q_freshness,
        "device_detail": q_device_detail,
        "device_search": q_device_search,
        "devices_active": q_catalogue("active"),
        "devices_inactive": q_catalogue("inactive"),
        "devices_on_map": q_mappable,
        "insert_ignore": q_insert_ignore,
        "upsert_latest": q_upsert_latest,
        "incremental_filter": q_incremental_filter,
        "batch_mark": q_batch_mark,
        "advance_mark": q_advance_mark,
        "check_unique": q_check_unique,
        "check_not_null": q_check_not_null,
        "check_fk": q_check_fk,
        "not_outlier": q_not_outlier,
        "registered_only": q_registered_only,
        "scalar_numbers": q_numbers,
        "scalar_times": q_times,
        "scalar_labels": q_labels,
        **streams.queries(),
    }
