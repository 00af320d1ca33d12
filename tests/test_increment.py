"""Incremental cleaning equals a full recompute, in one step and through the stored tables."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from millrace.operators.hampel import hampel, hampel_incremental
from millrace.plans.pipeline import Tables, process_batch, refresh_derived, regenerate_clean
from millrace.schemas import DEVICE, RAW_VALUE, TIME, VALUE
from millrace.session import stage
from millrace.sinks.tables import DATE, upsert, with_date
from workload.tables import customer_devices, events_clean, table

SF = "/root/testdata/sf0.01"
COLUMNS = [DEVICE, TIME, RAW_VALUE, VALUE, "is_outlier", "window_median", "thresholds"]


def same(a, b, columns=COLUMNS):
    assert a.count() == b.count()
    assert a.select(*columns).exceptAll(b.select(*columns)).isEmpty()


@pytest.mark.parametrize("partitioned", [False, True])
@pytest.mark.parametrize("seed", [1, 2])
def test_random_batches_with_late_rows(spark, seed, partitioned):
    rows = events_clean(spark, SF).select(DEVICE, TIME, RAW_VALUE)
    rows = rows.withColumn("batch", F.pmod(F.xxhash64(TIME, F.lit(seed)), F.lit(10))).withColumn(
        # mostly in order: four periods, a tenth of the rows arrives one period later
        "batch", F.least(F.lit(3), F.floor(F.dayofmonth(TIME) / 8) + F.when(F.col("batch") == 0, 1).otherwise(0))
    )
    stored = None
    for batch in range(4):
        new = rows.filter(F.col("batch") == batch).drop("batch")
        if stored is None:
            stored = hampel(new, window=9)
        else:
            changed = stage(
                hampel_incremental(stored, new, window=9, date=DATE if partitioned else None).select(*COLUMNS), "changed"
            )
            stored = upsert(stored.select(*COLUMNS), changed, [DEVICE, TIME], [TIME])
        stored = stage(with_date(stored, TIME), "stored")
    same(stored, hampel(rows, window=9))


def raw_rows(spark):
    return table(spark, SF, "events").select(
        F.col("user_id").cast("string").alias("device_id"),
        F.lit("").alias("group_name"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("parent_timestamp"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("parent_timestampMsec"),
        F.lit("Instant flow rate 2").alias("measure_name"),
        F.col("value").alias("raw_data"),
        F.lit(1).alias("status"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("measure_timestamp"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("measure_timestampMsec"),
    )


def test_pipeline_on_stored_tables(spark, tmp_path):
    tables = Tables(str(tmp_path))
    raw = raw_rows(spark)
    at = F.timestamp_millis("parent_timestampMsec")
    early, late = raw.filter(at < "2024-01-18"), raw.filter(at >= "2024-01-18")
    process_batch(tables, early)
    process_batch(tables, late.withColumn("raw_data", F.col("raw_data")))
    process_batch(tables, late.withColumn("raw_data", F.lit(-1.0)))  # delivered again: the first row stays
    clean = tables.read(spark, "clean")
    expected = hampel(
        raw.select(F.col("device_id").alias(DEVICE), at.alias(TIME), F.col("raw_data").alias(RAW_VALUE))
    )
    same(clean, expected)
    mark = tables.read(spark, "etl_state").head()
    assert mark["last_parent_timestampmsec"] == raw.agg(F.max("parent_timestampMsec")).head()[0]
    regenerate_clean(tables, spark)
    clean = tables.read(spark, "clean")
    same(clean, expected)

    devices = customer_devices(spark, SF).withColumn(DEVICE, F.col(DEVICE).cast("string"))
    for _ in range(2):  # the second run replaces, it does not add
        refresh_derived(tables, devices, F.lit("2024-02-01").cast("timestamp"), bins=10)
    assert tables.read(spark, "stats").count() == 150
    assert tables.read(spark, "histogram").count() == 1500
    days = clean.select(DEVICE, F.to_date(TIME)).distinct().count()
    assert tables.read(spark, "duration_curve").count() == days
    assert clean.agg(F.max(TIME)).head()[0] - clean.agg(F.min(TIME)).head()[0] > timedelta(days=29)
