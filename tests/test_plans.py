"""The physical plans are the ones meant for large tables."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from millrace.operators.filters import newer_than, trailing_range_of
from millrace.operators.hampel import hampel
from millrace.operators.reshape import pivot_measures
from millrace.operators.stats import device_stats
from millrace.plans.queries import series_query
from workload.queries import queries
from workload.tables import MEASURES, events_clean, events_raw, table

SF = "/root/testdata/sf0.01"


def plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def test_stats_broadcast_the_extent_and_shuffle_only_partials(spark):
    text = plan(device_stats(events_clean(spark, SF)))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    assert text.count("hashpartitioning") == 1
    assert "partial_avg" in text


def test_scan_reads_only_the_columns_it_needs(spark):
    text = plan(hampel(events_clean(spark, SF)))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,value:double>" in text
    assert text.count("hashpartitioning") == 1


def test_device_and_time_filters_reach_the_scan(spark):
    text = plan(trailing_range_of(events_clean(spark, SF), 8, "7d"))
    assert "EqualTo(user_id,8)" in text and "Join" not in text
    text = plan(newer_than(table(spark, SF, "events"), "ts", 1_705_708_800_000).select("ts"))
    assert f"GreaterThan(ts,{datetime(2024, 1, 20):%Y-%m-%dT%H:%M}" in text
    assert "EqualTo(user_id,8)" in plan(series_query(events_clean(spark, SF), 8, "7d"))


def test_pivot_is_one_hash_aggregation(spark):
    text = plan(pivot_measures(events_raw(spark, SF), MEASURES))
    assert text.count("hashpartitioning") == 1 and "SortAggregate" not in text


@pytest.mark.parametrize("name", ["device_stats", "flow_histogram", "duration_curve", "hampel", "series_1y", "mean_line"])
def test_no_cross_join_and_no_single_partition(spark, name):
    text = plan(queries()[name](spark, SF))
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert "SinglePartition" not in text


def test_batch_files_carry_no_driver_collect(spark):
    """The flagship result stays lazy: building it runs only the bounded extent job."""
    assert device_stats(events_clean(spark, SF)).filter(F.col("avg_24h") > 1e12).isEmpty()
