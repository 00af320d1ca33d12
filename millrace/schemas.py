"""Column names, table schemas and fixed settings of the telemetry data model."""

from pyspark.sql import types as T

# Columns of the cleaned series; operators use them as defaults.
DEVICE = "id_misuratore"
TIME = "data_misurazione"
RAW_VALUE = "flow_ls_raw"
VALUE = "flow_ls_smoothed"
OUTLIER = "is_outlier"

_str, _long, _int, _dbl, _bool, _ts = (
    T.StringType(),
    T.LongType(),
    T.IntegerType(),
    T.DoubleType(),
    T.BooleanType(),
    T.TimestampType(),
)


def _table(*fields):
    return T.StructType([T.StructField(name, kind, nullable) for name, kind, nullable in fields])


# Measure name in the events -> column of the wide table.
# The numbering of heat flow and supply temperature is irregular on purpose.
MEASURE_COLUMNS = {
    "Instant flow rate 2": "instant_flow_rate_2",
    "Instant flow rate 1": "instant_flow_rate_1",
    "Fluid velocity 2": "fluid_velocity_2",
    "Fluid velocity 1": "fluid_velocity_1",
    "Instant heat flow rate 1": "instant_heat_flow_rate_2",
    "Instant heat flow rate": "instant_heat_flow_rate_1",
    "Return water temperature 2": "return_water_temperature_2",
    "Return water temperature 1": "return_water_temperature_1",
    "Supplying water temperature 1": "supplying_water_temperature_2",
    "Supplying water temperature": "supplying_water_temperature_1",
}

# Operating parameters.
HAMPEL_WINDOW, HAMPEL_SIGMA = 49, 3.5
OFFLINE_WINDOW, OFFLINE_SIGMA = 50, 3.0
MAD_SCALE = 1.4826
CLAMP_LIMIT = 9_999_999.999
THROTTLE_SECONDS = 280
HISTOGRAM_BINS = 100
CURVE_FLOOR = -50
CURVE_LEVEL = 80
CURVE_MAX_POINTS = 20_000
DECIMATE_ABOVE, DECIMATE_TO = 1250, 1000
STATS_WINDOWS = {
    "avg_24h": "INTERVAL 24 HOURS",
    "avg_7d": "INTERVAL 7 DAYS",
    "avg_30d": "INTERVAL 30 DAYS",
    "avg_360d": "INTERVAL 360 DAYS",
}
# A range key that is not listed means the whole series.
RANGE_INTERVALS = {
    "24h": "INTERVAL 24 HOURS",
    "7d": "INTERVAL 7 DAYS",
    "1m": "INTERVAL 30 DAYS",
    "6m": "INTERVAL 182 DAYS",
    "1y": "INTERVAL 365 DAYS",
}
RANGE_MAX_POINTS = {"24h": None, "7d": 10_000, "1m": 10_000, "6m": 10_000, "1y": 10_000, "all": 20_000}
OTHER_MAX_POINTS = 25_000
# Mean shown with a range; 6m has none.
RANGE_MEAN = {"24h": "avg_24h", "7d": "avg_7d", "1m": "avg_30d", "1y": "avg_360d", "all": "avg_all_time"}
LONG_GAP_RANGES = ("6m", "1y", "all")
SHORT_GAP, LONG_GAP = "INTERVAL 2 HOURS", "INTERVAL 3 DAYS"
LATE_AFTER, LOST_AFTER = "INTERVAL 2 HOURS", "INTERVAL 6 HOURS"

RAW = _table(
    ("device_id", _str, False),
    ("group_name", _str, True),
    ("parent_timestamp", _long, True),
    ("parent_timestampMsec", _long, True),
    ("measure_name", _str, True),
    ("raw_data", _dbl, True),
    ("status", _int, True),
    ("measure_timestamp", _long, True),
    ("measure_timestampMsec", _long, True),
)
MEASUREMENTS = _table(
    ("device_id", _str, False),
    ("ts_s", _ts, False),
    *[(column, _dbl, True) for column in MEASURE_COLUMNS.values()],
)
CLEAN = _table(
    (DEVICE, _str, False),
    (TIME, _ts, False),
    (RAW_VALUE, _dbl, True),
    (VALUE, _dbl, True),
    (OUTLIER, _bool, True),
    ("window_median", _dbl, True),
    ("thresholds", _dbl, True),
    ("updated_at", _ts, True),
)
DEVICES = _table(
    (DEVICE, _str, False),
    ("name", _str, True),
    ("location", _str, True),
    ("latitude", _dbl, True),
    ("longitude", _dbl, True),
    ("created_at", _ts, True),
    ("is_active", _bool, True),
)
STATS = _table(
    (DEVICE, _str, False),
    ("total_measurements", _long, True),
    ("first_measurement", _ts, True),
    ("last_measurement", _ts, True),
    *[(name, _dbl, True) for name in (*STATS_WINDOWS, "avg_all_time")],
    ("updated_at", _ts, True),
)
HISTOGRAM = _table(
    (DEVICE, _str, False),
    ("window_start", _ts, True),
    ("window_end", _ts, True),
    ("bin_index", _int, False),
    ("range_start", _dbl, True),
    ("range_end", _dbl, True),
    ("count", _long, True),
    ("updated_at", _ts, True),
)
CURVE = _table(
    (DEVICE, _str, False),
    ("giorno", T.DateType(), False),
    ("flow_avg_day", _dbl, True),
    ("m", _long, True),
    ("n", _long, True),
    ("p_exceed", _dbl, True),
)
ETL_STATE = _table(
    ("job_name", _str, False),
    ("last_parent_timestampmsec", _long, False),
    ("updated_at", _ts, True),
)

TABLES = {
    "raw": RAW,
    "measurements": MEASUREMENTS,
    "clean": CLEAN,
    "devices": DEVICES,
    "stats": STATS,
    "histogram": HISTOGRAM,
    "duration_curve": CURVE,
    "etl_state": ETL_STATE,
}
