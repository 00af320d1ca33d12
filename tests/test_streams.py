"""Streams over several micro-batches equal their batch twins."""

import pytest
from pyspark.sql import functions as F

from millrace.operators.hampel import hampel
from millrace.operators.reshape import explode_events
from millrace.operators.throttle import throttle
from millrace.plans.pipeline import Tables
from millrace.schemas import DEVICE, RAW, RAW_VALUE, TIME, VALUE
from millrace.sinks.store import Store
from millrace.sinks.tables import open_table
from millrace.sources.events import active_sources, read_events
from millrace.streaming.streams import (
    dedupe_stream,
    ingest_stream,
    run_pipeline,
    throttle_stream,
    throttle_stream_ordered,
    upsert_sink,
)
from workload.streams import drain
from workload.tables import event_messages, events_clean, table

SF = "/root/testdata/sf0.001"
NOW = {"availableNow": True}


@pytest.fixture(scope="module")
def parts(spark, tmp_path_factory):
    """The events in five files, one period each, read one file per micro-batch in order."""
    folder = str(tmp_path_factory.mktemp("parts"))
    rows = events_clean(spark, SF).withColumn(TIME, F.col(TIME).cast("timestamp")).drop("is_outlier", RAW_VALUE)
    for i in range(5):
        day = F.dayofmonth(TIME)
        rows.filter((day > i * 6) & (day <= i * 6 + 6)).coalesce(1).write.mode("append").parquet(folder)
    return rows, folder


def stream_of(spark, rows, folder):
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(folder)


def test_throttle_over_batches(spark, parts):
    rows, folder = parts
    for hours in (6, 100):
        out = drain(throttle_stream(stream_of(spark, rows, folder), min_seconds=hours * 3600, delay="40 days"))
        expected = throttle(rows, min_seconds=hours * 3600)
        assert out.count() == expected.count()
        assert out.exceptAll(expected.select(*out.columns)).isEmpty()


def test_throttle_drops_idle_state(spark, parts):
    """With a short lateness the state of a device expires between its rows; the result is the same."""
    rows, folder = parts
    out = drain(throttle_stream(stream_of(spark, rows, folder), min_seconds=3600, delay="1 hour"))
    assert out.count() == throttle(rows, min_seconds=3600).count()


@pytest.mark.parametrize("hours", [6, 100])
def test_ordered_throttle_of_rows_out_of_order(spark, parts, tmp_path, hours):
    """Deliveries in an order of their own, over six micro-batches; all that the watermark has passed comes out."""
    rows, _ = parts
    folder, delay = str(tmp_path / "late"), 12
    mixed = F.least(F.floor((F.dayofmonth(TIME) + F.pmod(F.xxhash64(TIME), F.lit(6))) / 6), F.lit(5))
    for part in range(6):
        rows.filter(mixed == part).coalesce(1).write.mode("append").parquet(folder)
    out = drain(throttle_stream_ordered(stream_of(spark, rows, folder), min_seconds=hours * 3600, delay=f"{delay} days"))
    passed = F.unix_millis(TIME) < rows.agg(F.max(F.unix_millis(TIME))).head()[0] - delay * 86_400_000
    expected = throttle(rows, min_seconds=hours * 3600).filter(passed)
    assert out.count() == expected.count() > 0
    assert out.exceptAll(expected.select(*out.columns)).isEmpty()


def test_upsert_sink_keeps_the_last_state_and_skips_a_repeated_batch(spark, parts, tmp_path):
    rows, folder = parts
    counts = stream_of(spark, rows, folder).groupBy(DEVICE).agg(F.count("*").alias("n"))
    path = str(tmp_path / "t")
    upsert_sink(counts, path, str(tmp_path / "c"), [DEVICE], NOW).awaitTermination()
    found = open_table(spark, path)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, rows.groupBy(DEVICE).count().collect()))
    number = Store(spark, path).snapshot().number
    assert list(Store(spark, path).snapshot().marks.values()) == [4]
    # The last batch again: its commit was written, its end not yet noted in the checkpoint.
    (tmp_path / "c" / "commits" / "4").unlink()
    (tmp_path / "c" / "commits" / ".4.crc").unlink()
    upsert_sink(counts, path, str(tmp_path / "c"), [DEVICE], NOW).awaitTermination()
    assert Store(spark, path).snapshot().number == number
    # Another stream into the same table is not taken for a repetition.
    upsert_sink(counts, path, str(tmp_path / "c2"), [DEVICE], NOW).awaitTermination()
    assert Store(spark, path).snapshot().number > number
    assert sorted(map(tuple, open_table(spark, path).collect())) == sorted(map(tuple, found.collect()))


def test_dedupe_stream(spark, parts):
    rows, folder = parts
    twice = stream_of(spark, rows, folder).withColumn("x", F.explode(F.array(F.lit(1), F.lit(2)))).drop("x")
    assert drain(dedupe_stream(twice, [DEVICE, TIME], delay="60 days")).count() == rows.count()


def test_ingest_then_pipeline(spark, tmp_path):
    """JSON files -> raw table -> wide and clean tables, restarted in between; equals the batch result."""
    inbox, tables = str(tmp_path / "inbox"), Tables(str(tmp_path / "tables"))
    events = table(spark, SF, "events").filter("event_type in ('click', 'view')")
    messages = event_messages(events).withColumn(
        "body", F.regexp_replace("body", '"(click|view)"', '"Instant flow rate 2"')
    )
    expected_raw = explode_events(messages)
    halves = [messages.filter(c) for c in ("xxhash64(body) % 2 = 0", "xxhash64(body) % 2 <> 0")]
    for half in halves:
        half.withColumnRenamed("body", "value").coalesce(2).write.mode("append").text(inbox)
        source = read_events(spark, "text", {"path": inbox}, streaming=True)
        ingest_stream(source, tables.path("raw"), str(tmp_path / "c1"), min_seconds=None, trigger=NOW).awaitTermination()
        run_pipeline(spark, tables, str(tmp_path / "c2"), trigger=NOW, max_files=20).awaitTermination()
    raw = spark.read.schema(RAW).parquet(tables.path("raw"))
    assert raw.count() == expected_raw.count()
    series = expected_raw.select(
        F.col("device_id").alias(DEVICE), F.timestamp_millis("parent_timestampMsec").alias(TIME),
        F.col("raw_data").alias(RAW_VALUE))
    columns = [DEVICE, TIME, RAW_VALUE, VALUE, "is_outlier", "window_median", "thresholds"]
    clean = tables.read(spark, "clean")
    assert clean.count() == series.count()
    assert clean.select(*columns).exceptAll(hampel(series).select(*columns)).isEmpty()


def test_active_sources(spark):
    rows = [("a", "A", "conn", "grp"), ("b", "B", "", "grp"), ("c", "C", None, "grp"), ("d", "D", "conn", "")]
    devices = spark.createDataFrame(
        rows, f"{DEVICE} string, name string, eventhub_connection_string string, eventhub_consumer_group string")
    out = active_sources(devices)
    assert out.columns == [DEVICE, "name"] and [r[0] for r in out.collect()] == ["a"]
