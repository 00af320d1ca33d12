"""Read queries of single devices, and tables that are written and read back."""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.dedupe import merge_series
from millrace.operators.filters import first_for, for_device
from millrace.operators.histogram import flow_histogram
from millrace.operators.stats import latest
from millrace.plans.queries import clean_files, curve_query, device_detail, histogram_query, series_query
from millrace.schemas import DEVICE, OUTLIER, RAW_VALUE, TIME, VALUE
from millrace.session import scratch_root
from millrace.sinks.tables import append_raw, open_table, refresh_table, upsert_snapshot, write_csv
from millrace.sources.csvfiles import read_clean_csv, read_processed_csv
from millrace.sources.events import active_sources
from workload.oracle import EVENTS, hampel, histogram, r6
from workload.queries import HAMPEL_COLUMNS, _curve, _stats, as_of, rounded, seconds_series
from workload.tables import customer_devices, events_clean, events_raw, table

ONE = 7


def _folder(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/reads/{uuid.uuid4().hex}"


def _series(range_key: str):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return series_query(events_clean(spark, sf), ONE, range_key)

    return run


def q_series_long(spark: SparkSession, sf: str) -> DataFrame:
    """A device long enough to be thinned: all lines, one second apart."""
    rows = seconds_series(spark, sf).groupBy(TIME).agg(F.max(VALUE).alias(VALUE))
    rows = rows.withColumns({DEVICE: F.lit("all"), RAW_VALUE: F.col(VALUE), OUTLIER: F.lit(False)})
    return series_query(rows, "all", "7d")


def q_curve(spark: SparkSession, sf: str) -> DataFrame:
    return curve_query(_curve(spark, sf), ONE).select(
        F.round(F.col("flow_avg_day") + 3e-8, 6).alias("flow_avg_day"), F.round(F.col("p_exceed") + 3e-8, 6).alias("p_exceed"))


def q_detail(spark: SparkSession, sf: str) -> DataFrame:
    clean = events_clean(spark, sf)
    detail, _ = device_detail(customer_devices(spark, sf), _stats(clean), clean, ONE)
    return detail.select(DEVICE, "name", "location", "is_active", "total_measurements")


def q_detail_rows(spark: SparkSession, sf: str) -> DataFrame:
    clean = events_clean(spark, sf)
    return device_detail(customer_devices(spark, sf), _stats(clean), clean, ONE)[1]


def q_latest(spark: SparkSession, sf: str) -> DataFrame:
    return latest(events_clean(spark, sf), ONE)


def q_device(spark: SparkSession, sf: str) -> DataFrame:
    return for_device(events_clean(spark, sf), ONE)


def q_first(spark: SparkSession, sf: str) -> DataFrame:
    return first_for(customer_devices(spark, sf), ONE)


def q_append(spark: SparkSession, sf: str) -> DataFrame:
    """The raw rows in two deliveries."""
    path, raw = _folder(spark), events_raw(spark, sf)
    for part in (0, 1):
        append_raw(raw.filter(F.pmod(F.hash("device_id"), F.lit(2)) == part), path)
    return spark.read.parquet(path).select(*raw.columns)


def q_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """A derived table rebuilt over an older state of itself."""
    path, rows = _folder(spark), customer_devices(spark, sf)
    refresh_table(rows.filter("is_active"), path)
    refresh_table(rows, path)
    return open_table(spark, path)


def q_upsert_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """Registry rows upserted over an older state: active devices got a new name."""
    path, rows = _folder(spark), customer_devices(spark, sf).withColumn("version", F.lit(1))
    upsert_snapshot(path, rows, [DEVICE], ["version"])
    new = rows.filter("is_active").withColumns({"name": F.upper("name"), "version": F.lit(2)})
    upsert_snapshot(path, new, [DEVICE], ["version"])
    return open_table(spark, path)


def q_read_histogram(spark: SparkSession, sf: str) -> DataFrame:
    """The newest of two histograms of one device, with percent."""
    clean = events_clean(spark, sf)
    older = flow_histogram(clean, 20, as_of=as_of() - F.expr("INTERVAL 1 DAY"))
    rows = histogram_query(older.unionByName(flow_histogram(clean, 25, as_of=as_of())), ONE)
    return rounded(rows, "range_start", "range_end", "mid", "percent")


def q_active_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Devices with both connection columns; every third customer has an empty one, every fifth none."""
    key = F.col(DEVICE)
    devices = customer_devices(spark, sf).withColumns({
        "eventhub_connection_string": F.when(key % 3 == 0, "").otherwise("sb://x"),
        "eventhub_consumer_group": F.when(key % 5 != 0, "group"),
    })
    return active_sources(devices)


def _device_files(spark: SparkSession, sf: str) -> str:
    """One folder of CSV files for each device, as exported: time and flow as text."""
    folder = _folder(spark)
    rows = table(spark, sf, "events").select(F.col("user_id").alias(DEVICE), F.col("ts").cast("string").alias("t"),
                                             F.col("value").alias("flow_ls"), F.col("event_type").alias("note"))
    write_csv(rows.repartition(DEVICE), folder)
    return folder


def q_clean_files(spark: SparkSession, sf: str) -> DataFrame:
    """The files of all devices through the offline filter; also a device whose file is missing and one without a path."""
    folder = _device_files(spark, sf)
    key = F.col("c_custkey").cast("string")
    mapping = table(spark, sf, "customer").select(key.alias(DEVICE), F.concat(F.lit(f"{folder}/{DEVICE}="), key, F.lit("/*.csv")))
    others = spark.createDataFrame([("none", f"{folder}/none.csv"), ("empty", "")], f"{DEVICE} string, path string")
    mapping = mapping.distinct().union(others)
    rows = clean_files(spark, mapping).withColumn(DEVICE, F.col(DEVICE).cast("bigint")).drop("updated_at")
    return rounded(rows.withColumn(TIME, F.col(TIME).cast("timestamp_ntz")), *HAMPEL_COLUMNS)


def q_csv_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Files by device, read back from the folder and merged; in two deliveries with the same rows."""
    rows = read_clean_csv(spark, _device_files(spark, sf)).withColumnRenamed("t", TIME)
    _, unique = merge_series(rows.unionByName(rows), ["_line"])
    return unique.select(F.col(DEVICE).cast("bigint").alias(DEVICE), F.col(TIME).cast("timestamp_ntz").alias(TIME),
                         F.col("flow_ls").cast("double").alias(VALUE), "note")


def q_processed_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Processed files back in their types: floats, flag, time."""
    folder = _folder(spark)
    rows = events_clean(spark, sf).withColumn("timestamp", F.col(TIME).cast("string")).drop(TIME, DEVICE)
    write_csv(rows, folder, None)
    return read_processed_csv(spark, folder).withColumns({
        "timestamp": F.col("timestamp").cast("timestamp_ntz"),
        **{c: F.round(F.col(c).cast("double"), 2) for c in (RAW_VALUE, VALUE)},
    })


def queries() -> dict:
    return {
        "read_histogram": q_read_histogram, "active_sources": q_active_sources, "clean_files": q_clean_files,
        "csv_round_trip": q_csv_round_trip, "processed_csv": q_processed_csv, "read_series_long": q_series_long,
        "read_series_24h": _series("24h"), "read_series_7d": _series("7d"), "read_series_all": _series("all"),
        "read_curve": q_curve, "read_detail": q_detail, "read_detail_rows": q_detail_rows, "latest_of_one": q_latest,
        "device_rows": q_device, "first_for_device": q_first, "append_raw": q_append, "refresh_table": q_refresh,
        "upsert_snapshot": q_upsert_snapshot,
    }


def oracle_sql() -> dict[str, str]:
    rows = f"""SELECT user_id AS {DEVICE}, ts AS {TIME}, value AS {RAW_VALUE}, value AS {VALUE},
        event_type = 'error' AS {OUTLIER} FROM events WHERE user_id = {ONE}"""
    registry = f"SELECT c_custkey AS {DEVICE}, c_name AS name, c_mktsegment AS location, c_acctbal > 0 AS is_active FROM customer"

    def since(text: str) -> str:
        return f"WHERE {TIME} >= (SELECT max({TIME}) FROM r) - INTERVAL {text}"

    def series(where: str, device: bool = False) -> str:
        return f"WITH r AS ({rows}) SELECT {'*' if device else f'* EXCLUDE ({DEVICE})'} FROM r {where}"

    return {
        "read_series_24h": series(since("24 HOUR")), "read_series_7d": series(since("7 DAY")), "read_series_all": series(""),
        "read_histogram": f"""WITH {EVENTS}, {histogram('events_clean', 25)} SELECT bin_index,
            {r6('range_start')} AS range_start, {r6('range_end')} AS range_end, {r6('(range_start + range_end) / 2')} AS mid,
            count, {r6('CASE WHEN sum(count) OVER () > 0 THEN count / sum(count) OVER () * 100 ELSE 0 END')} AS percent
            FROM hist WHERE {DEVICE} = {ONE}""",
        "active_sources": f"SELECT {DEVICE}, name FROM ({registry}) WHERE {DEVICE} % 3 <> 0 AND {DEVICE} % 5 <> 0",
        "clean_files": f"WITH {EVENTS}, {hampel(window=50, n_sigma=3.0)}",
        "csv_round_trip": f"""SELECT user_id AS {DEVICE}, ts AS {TIME}, value AS {VALUE}, event_type AS note FROM events""",
        "processed_csv": f"""SELECT ts AS timestamp, round(CAST(CAST(value AS FLOAT) AS DOUBLE), 2) AS {RAW_VALUE},
            round(CAST(CAST(value AS FLOAT) AS DOUBLE), 2) AS {VALUE}, event_type = 'error' AS {OUTLIER} FROM events""",
        "read_series_long": f"""WITH dense AS (SELECT make_timestamp((1700000000 + l_orderkey * 8 + l_linenumber) * 1000000)
              AS {TIME}, max(l_quantity) AS {RAW_VALUE}, max(l_quantity) AS {VALUE}, false AS {OUTLIER}
              FROM lineitem GROUP BY 1),
            ranged AS (SELECT * FROM dense WHERE {TIME} >= (SELECT max({TIME}) FROM dense) - INTERVAL 7 DAY),
            placed AS (SELECT *, row_number() OVER (ORDER BY {TIME}) - 1 AS place, count(*) OVER () AS size FROM ranged)
            SELECT * EXCLUDE (place, size) FROM placed WHERE size <= 10000 OR place % greatest(1, size // 10000) = 0""",
        "read_detail": f"""SELECT d.*, (SELECT count(*) FROM events WHERE user_id = {ONE} AND event_type <> 'error')
            AS total_measurements FROM ({registry}) AS d WHERE {DEVICE} = {ONE}""",
        "read_detail_rows": series(since("24 HOUR"), True),
        "read_curve": f"""WITH daily AS (SELECT CAST(ts AS DATE) AS day, avg(value) AS mean FROM events WHERE user_id = {ONE}
              GROUP BY 1),
            placed AS (SELECT mean, row_number() OVER (ORDER BY mean DESC, day) AS m, count(*) OVER () AS n FROM daily)
            SELECT round(mean + 3e-8, 6) AS flow_avg_day, round(m / (n + 1.0) * 100.0 + 3e-8, 6) AS p_exceed FROM placed""",
        "latest_of_one": f"SELECT max(ts) AS latest_measurement FROM events WHERE user_id = {ONE}",
        "device_rows": rows,
        "first_for_device": f"{registry} WHERE c_custkey = {ONE}",
        "append_raw": """SELECT user_id AS device_id, epoch_us(date_trunc('day', ts)) // 1000 AS "parent_timestampMsec",
            event_type AS measure_name, value AS raw_data FROM events""",
        "refresh_table": registry,
        "upsert_snapshot": f"""SELECT {DEVICE}, CASE WHEN is_active THEN upper(name) ELSE name END AS name, location, is_active,
            CASE WHEN is_active THEN 2 ELSE 1 END AS version FROM ({registry})""",
    }
