"""The stored pipeline over the supplied events: increments by mark, late rows, a new device, derived tables, streams."""

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.plans.pipeline import Tables, ensure_tables, refresh_derived, run_increment
from millrace.schemas import DEVICE, RAW, RAW_VALUE, TIME, VALUE
from millrace.session import scratch_root
from millrace.sinks.tables import append_raw
from millrace.sources.events import read_events
from millrace.streaming.streams import ingest_stream, run_pipeline
from workload.oracle import CURVE_OUT, CUSTOMERS, STATS_OUT, curve, hampel, histogram, histogram_out, stats
from workload.queries import HAMPEL_COLUMNS, MEANS, as_of, rounded
from workload.streams import naive
from workload.tables import customer_devices, event_messages, table

FLOW_MEASURE = "Instant flow rate 2"
BINS = 20
_filled: dict[tuple[str, str], Tables] = {}


def _folder(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}/{uuid.uuid4().hex}"


def raw_events(spark: SparkSession, sf: str) -> DataFrame:
    at = F.col("ts").cast("timestamp")
    return table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("device_id"), F.lit("").alias("group_name"),
        F.unix_seconds(at).alias("parent_timestamp"), F.unix_millis(at).alias("parent_timestampMsec"),
        F.lit(FLOW_MEASURE).alias("measure_name"), F.col("value").alias("raw_data"), F.lit(1).alias("status"),
        F.unix_seconds(at).alias("measure_timestamp"), F.unix_millis(at).alias("measure_timestampMsec"),
    ).select(*RAW.names)


def registry(spark: SparkSession, sf: str) -> DataFrame:
    return customer_devices(spark, sf).withColumn(DEVICE, F.col(DEVICE).cast("string"))


def two_batches(spark: SparkSession, sf: str) -> Tables:
    """Two deliveries, each taken in by the mark and followed by a refresh, and a run with nothing new. The second
    delivery has rows older than the mark and devices that were not there before."""
    name = spark.sparkContext.applicationId, sf
    if name not in _filled:
        tables, raw = Tables(_folder(spark, "chain")), raw_events(spark, sf)
        ensure_tables(tables, spark)
        at = F.timestamp_millis("parent_timestampMsec")
        late = F.pmod(F.xxhash64("device_id", "parent_timestampMsec"), F.lit(20)) == 0
        second = (at >= "2024-01-20") | late | F.col("device_id").endswith("3")
        for part in (~second, second, F.lit(False)):
            append_raw(raw.filter(part), tables.path("raw"))
            run_increment(tables, spark, dt.timedelta(days=60))
            refresh_derived(tables, registry(spark, sf), as_of().cast("timestamp"), BINS)
        _filled[name] = tables
    return _filled[name]


def _number(df: DataFrame) -> DataFrame:
    return df.withColumn(DEVICE, F.col(DEVICE).cast("bigint"))


def q_clean(spark: SparkSession, sf: str) -> DataFrame:
    rows = two_batches(spark, sf).read(spark, "clean").drop("updated_at", "event_date")
    return rounded(naive(_number(rows)), *HAMPEL_COLUMNS)


def q_stats(spark: SparkSession, sf: str) -> DataFrame:
    rows = two_batches(spark, sf).read(spark, "stats").drop("updated_at")
    return rounded(naive(naive(_number(rows), "first_measurement"), "last_measurement"), *MEANS)


def q_histogram(spark: SparkSession, sf: str) -> DataFrame:
    rows = two_batches(spark, sf).read(spark, "histogram")
    for c in ("window_start", "window_end", "updated_at"):
        rows = naive(rows, c)
    return rounded(_number(rows), "range_start", "range_end")


def q_curve(spark: SparkSession, sf: str) -> DataFrame:
    rows = two_batches(spark, sf).read(spark, "duration_curve")
    return rounded(_number(rows).select(DEVICE, "giorno", "flow_avg_day", "m", "n", "p_exceed"), "flow_avg_day", "p_exceed")


def q_marks(spark: SparkSession, sf: str) -> DataFrame:
    return two_batches(spark, sf).read(spark, "etl_state").select("job_name", "last_parent_timestampmsec")


def q_stream(spark: SparkSession, sf: str) -> DataFrame:
    """JSON messages -> raw table -> wide and clean tables, both as streams, in two runs with a restart."""
    inbox, tables = _folder(spark, "inbox"), Tables(_folder(spark, "chain"))
    events = table(spark, sf, "events").filter("event_type in ('click', 'view')")
    messages = event_messages(events).select(F.regexp_replace("body", '"(click|view)"', f'"{FLOW_MEASURE}"').alias("value"))
    for part in (0, 1):
        messages.filter(F.pmod(F.xxhash64("value"), F.lit(2)) == part).coalesce(2).write.mode("append").text(inbox)
        source = read_events(spark, "text", {"path": inbox}, streaming=True)
        ingest_stream(source, tables.path("raw"), f"{tables.root}/_ingest", None, {"availableNow": True}).awaitTermination()
        run_pipeline(spark, tables, f"{tables.root}/_clean", {"availableNow": True}, devices=registry(spark, sf),
                     refresh_every=2).awaitTermination()
    rows = tables.read(spark, "clean").drop("updated_at", "event_date")
    return rounded(naive(_number(rows)), *HAMPEL_COLUMNS)


def queries() -> dict:
    return {
        "pipeline_two_batches": q_clean, "pipeline_stats": q_stats, "pipeline_histogram": q_histogram,
        "pipeline_curve": q_curve, "pipeline_marks": q_marks, "stream_pipeline": q_stream,
    }


def oracle_sql() -> dict[str, str]:
    def series(where: str = "true") -> str:
        return f"""events_ms AS (SELECT user_id AS {DEVICE}, make_timestamp(epoch_us(ts) // 1000 * 1000) AS {TIME},
            max(value) AS {RAW_VALUE} FROM events WHERE {where} GROUP BY 1, 2)"""

    filtered = hampel("events_ms")
    cleaned = f"""{series()}, {filtered[: filtered.rindex(chr(10) + "SELECT")]}, cleaned AS (SELECT {DEVICE}, {TIME},
        CASE WHEN bad THEN med ELSE {RAW_VALUE} END AS {VALUE}, bad AS is_outlier FROM judged)"""
    mark = "max(epoch_us(ts) // 1000) AS last_parent_timestampmsec FROM events"
    return {
        "pipeline_two_batches": f"WITH {series()}, {filtered}",
        "pipeline_stats": f"WITH {cleaned}, {stats('cleaned')} SELECT {STATS_OUT} FROM stats",
        "pipeline_histogram": f"WITH {cleaned}, {histogram('cleaned', BINS)} {histogram_out()}",
        "pipeline_curve": f"WITH {cleaned}, {CUSTOMERS}, {curve('cleaned')} SELECT {CURVE_OUT} FROM curve",
        "pipeline_marks": f"""SELECT 'transform_raw_to_measurements' AS job_name, {mark}
            UNION ALL SELECT 'clean_measurements', {mark}""",
        "stream_pipeline": f"""WITH {series("event_type IN ('click', 'view')")}, {filtered}""",
    }
