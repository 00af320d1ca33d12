"""Supplied tables in the shape of the telemetry model."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.schemas import DEVICE, OUTLIER, RAW_VALUE, TIME, VALUE

MEASURES = {"click": "click", "error": "error", "purchase": "purchase", "signup": "signup", "view": "view"}


# Declared, so that no job has to look for the schema.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf}/{name}.parquet")


def events_clean(spark: SparkSession, sf: str) -> DataFrame:
    """Series A: one device per user; unique (device, time)."""
    return table(spark, sf, "events").select(
        F.col("user_id").alias(DEVICE),
        F.col("ts").alias(TIME),
        F.col("value").alias(RAW_VALUE),
        F.col("value").alias(VALUE),
        (F.col("event_type") == "error").alias(OUTLIER),
    )


def lineitem_clean(spark: SparkSession, sf: str) -> DataFrame:
    """Series B: one device per supplier; many rows share a (device, day)."""
    return table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias(DEVICE),
        F.col("l_shipdate").alias(TIME),
        F.col("l_extendedprice").alias(VALUE),
        (F.col("l_returnflag") == "R").alias(OUTLIER),
    )


def orders_clean(spark: SparkSession, sf: str) -> DataFrame:
    """Series C: one device per customer, sparse over years; o_orderkey breaks ties."""
    return table(spark, sf, "orders").select(
        F.col("o_custkey").alias(DEVICE),
        F.col("o_orderdate").alias(TIME),
        F.col("o_totalprice").alias(VALUE),
        (F.col("o_orderstatus") == "P").alias(OUTLIER),
        "o_orderkey",
    )


def customer_devices(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias(DEVICE),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("location"),
        (F.col("c_acctbal") > 0).alias("is_active"),
    )


def supplier_devices(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias(DEVICE), F.col("s_name").alias("name"), (F.col("s_acctbal") > 0).alias("is_active")
    )


def events_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Long rows: parent instant = the day, so that a (device, instant) has several measures."""
    return table(spark, sf, "events").select(
        F.col("user_id").alias("device_id"),
        F.unix_millis(F.date_trunc("day", "ts")).alias("parent_timestampMsec"),
        F.col("event_type").alias("measure_name"),
        F.col("value").alias("raw_data"),
    )


def event_messages(events: DataFrame) -> DataFrame:
    """One JSON message per row. Some kinds of rows carry a defect, so that the drop rules are used:

    error = ``values`` is a number; signup = the device is a number; purchase = a second measure is a number.
    """
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    reading = F.to_json(
        F.struct(
            F.col("value").alias("raw_data"),
            F.lit(1).alias("status"),
            F.floor(ms / 1000).alias("timestamp"),
            ms.alias("timestampMsec"),
        )
    )
    kind = F.col("event_type")
    good = F.concat(F.lit('{"'), kind, F.lit('": '), reading)
    device = (
        F.when(kind == "signup", F.lit("7"))
        .when(kind == "purchase", F.concat(good, F.lit(', "broken": 3}')))
        .otherwise(F.concat(good, F.lit("}")))
    )
    values = F.when(kind == "error", F.lit("5")).otherwise(
        F.concat(F.lit('{"'), F.col("user_id").cast("string"), F.lit('": '), device, F.lit("}"))
    )
    return events.select(
        F.concat(
            F.lit('{"timestamp": '), F.floor(ms / 1000).cast("string"), F.lit(', "timestampMsec": '), ms.cast("string"),
            F.lit(', "values": '), values, F.lit("}"),
        ).alias("body")
    )
