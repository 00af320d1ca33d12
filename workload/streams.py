"""Streaming queries over the supplied events, run until the source is drained."""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.schemas import DEVICE, TIME, VALUE
from millrace.session import rocksdb_state, scratch_root
from millrace.sinks.tables import open_table
from millrace.sources.events import read_events
from millrace.streaming.streams import (
    daily_mean_stream,
    decode_stream,
    dedupe_stream,
    latest_stream,
    pivot_stream,
    throttle_stream,
    throttle_stream_ordered,
    upsert_sink,
)
from workload.tables import MEASURES, event_messages, table

RAW_COLUMNS = ["device_id", "group_name", "parent_timestamp", "parent_timestampMsec", "measure_name", "raw_data",
               "status", "measure_timestamp", "measure_timestampMsec"]


def event_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The events table as a stream of (device, time, value)."""
    schema = table(spark, sf, "events").schema
    rows = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


def series(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("user_id").alias(DEVICE), F.col("ts").alias(TIME), F.col("value").alias(VALUE))


def drain(stream: DataFrame) -> DataFrame:
    """Run an append stream to the end of its source into a parquet table of the scratch area."""
    spark = stream.sparkSession
    base = f"{scratch_root(spark)}/streams/{uuid.uuid4().hex}"
    query = (
        stream.writeStream.format("parquet")
        .option("path", f"{base}/rows")
        .option("checkpointLocation", f"{base}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/rows")


def drain_updates(stream: DataFrame) -> DataFrame:
    """The same for an update stream: a batch replaces the table, which holds one row per device."""
    spark = stream.sparkSession
    base = f"{scratch_root(spark)}/streams/{uuid.uuid4().hex}"
    query = (
        stream.writeStream.outputMode("complete")
        .foreachBatch(lambda batch, _id: batch.write.mode("overwrite").parquet(f"{base}/rows"))
        .option("checkpointLocation", f"{base}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/rows")


def drain_keyed(stream: DataFrame, keys: list[str]) -> DataFrame:
    """The same for an update stream whose batches are upserted by key: every key's last state."""
    base = f"{scratch_root(stream.sparkSession)}/streams/{uuid.uuid4().hex}"
    upsert_sink(stream, f"{base}/rows", f"{base}/checkpoint", keys, {"availableNow": True}).awaitTermination()
    return open_table(stream.sparkSession, f"{base}/rows")


def naive(df: DataFrame, t: str = TIME) -> DataFrame:
    return df.withColumn(t, F.col(t).cast("timestamp_ntz"))


def r6(c: str):
    return F.round(F.col(c) + 3e-8, 6)


def q_throttle(spark: SparkSession, sf: str) -> DataFrame:
    return naive(drain(throttle_stream(series(event_rows(spark, sf)), min_seconds=86_400)))


def q_throttle_late(spark: SparkSession, sf: str) -> DataFrame:
    """The events in files by delivery, a fifth of them up to ten days late, one file for each micro-batch: rows that the
    watermark has passed are thinned as in time order."""
    folder = f"{scratch_root(spark)}/streams/{uuid.uuid4().hex}"
    rows = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    late = F.when(F.pmod(F.xxhash64("event_id"), F.lit(5)) == 0, F.pmod(F.xxhash64("event_id"), F.lit(10))).otherwise(0)
    delivered = F.least(F.floor((F.dayofmonth("ts") + late) / 6), F.lit(5))
    for part in range(6):
        series(rows.filter(delivered == part)).coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(series(rows).schema).option("maxFilesPerTrigger", 1).parquet(folder)
    with rocksdb_state(spark):
        return naive(drain(throttle_stream_ordered(stream, min_seconds=86_400, delay="17 days")))


def q_pivot(spark: SparkSession, sf: str) -> DataFrame:
    rows = event_rows(spark, sf)
    raw = rows.select(
        F.col("user_id").alias("device_id"),
        F.unix_millis(F.date_trunc("day", "ts")).alias("parent_timestampMsec"),
        F.col("event_type").alias("measure_name"),
        F.col("value").alias("raw_data"),
    )
    return naive(drain_keyed(pivot_stream(raw, "1 day", MEASURES), ["device_id", "ts_s"]), "ts_s")


def q_daily_mean(spark: SparkSession, sf: str) -> DataFrame:
    days = drain_keyed(daily_mean_stream(series(event_rows(spark, sf))), [DEVICE, "giorno"])
    return days.withColumn("flow_avg_day", r6("flow_avg_day"))


def q_latest(spark: SparkSession, sf: str) -> DataFrame:
    return naive(drain_updates(latest_stream(series(event_rows(spark, sf)))), "latest_measurement")


def q_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    """Every row delivered twice within the lateness bound."""
    rows = series(event_rows(spark, sf))
    twice = rows.withColumn("_copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_copy")
    return naive(drain(dedupe_stream(twice, [DEVICE, TIME], delay="60 days")))


def q_decode(spark: SparkSession, sf: str) -> DataFrame:
    """JSON messages from files through decode and throttle to raw rows."""
    folder = f"{scratch_root(spark)}/streams/{uuid.uuid4().hex}"
    event_messages(table(spark, sf, "events")).withColumnRenamed("body", "value").write.text(folder)
    messages = read_events(spark, "text", {"path": folder}, streaming=True)
    return drain(decode_stream(messages, 86_400)).select(*RAW_COLUMNS)


def queries() -> dict:
    return {
        "stream_throttle": q_throttle,
        "stream_throttle_late": q_throttle_late,
        "stream_pivot": q_pivot,
        "stream_daily_mean": q_daily_mean,
        "stream_latest": q_latest,
        "stream_dedupe": q_dedupe,
        "stream_decode": q_decode,
    }
