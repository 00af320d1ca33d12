"""Events to long rows, long rows to the wide table."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.scalars import nan_to_null
from millrace.schemas import MEASURE_COLUMNS

_EVENT = "timestamp bigint, timestampMsec bigint, group_name string, values map<string,string>"
_READING = "raw_data double, status int, timestamp bigint, timestampMsec bigint"


def parse_event(df: DataFrame, body: str = "body") -> DataFrame:
    """Add ``event``. Devices stay text at this stage: a malformed one must not spoil the others."""
    return df.withColumn("event", F.from_json(body, _EVENT))


def split_malformed(df: DataFrame, body: str = "body") -> tuple[DataFrame, DataFrame]:
    """(events with a ``values`` object, the rest as they came). An absent ``values`` is an empty event."""
    whole = F.get_json_object(body, "$")
    values = F.get_json_object(body, "$.values")
    readable = F.coalesce(
        F.ltrim(whole).startswith("{") & (values.isNull() | F.ltrim(values).startswith("{")), F.lit(False)
    )
    return df.filter(readable), df.filter(~readable)


def explode_devices(df: DataFrame, body: str = "body") -> DataFrame:
    """One row per (event, device) with the device's measures still as text in ``device_body``."""
    return parse_event(df, body).select(
        F.coalesce(F.col("event.group_name"), F.lit("")).alias("group_name"),
        F.col("event.timestamp").alias("parent_timestamp"),
        F.col("event.timestampMsec").alias("parent_timestampMsec"),
        F.explode("event.values").alias("device_id", "device_body"),
    ).filter(F.col("device_body").startswith("{"))


def explode_measures(devices: DataFrame) -> DataFrame:
    """One row per (event, device, measure) from ``explode_devices``."""
    measures = devices.select(
        "device_id",
        "group_name",
        "parent_timestamp",
        "parent_timestampMsec",
        F.explode(F.from_json("device_body", "map<string,string>")).alias("measure_name", "_reading"),
    )
    readings = measures.filter(F.col("_reading").startswith("{")).withColumn("_r", F.from_json("_reading", _READING))
    return readings.select(
        "device_id",
        "group_name",
        "parent_timestamp",
        "parent_timestampMsec",
        "measure_name",
        nan_to_null("_r.raw_data").alias("raw_data"),
        F.col("_r.status").alias("status"),
        F.col("_r.timestamp").alias("measure_timestamp"),
        F.col("_r.timestampMsec").alias("measure_timestampMsec"),
    )


def _exploded(df: DataFrame, value: str, name: str) -> DataFrame:
    """A row for each member of the variant ``value`` as ``name``, one of nulls where it has none. Of an array one row
    stays, without a key."""
    members = df.sparkSession.tvf.variant_explode_outer(F.col(value).outer()).select(
        F.col("pos").alias("_pos"), F.col("key").alias(name), F.col("value").alias(f"_{name}"))
    return df.lateralJoin(members).filter(F.col(name).isNotNull() | (F.coalesce("_pos", F.lit(0)) == 0))


def _is_object(value: str) -> Column:
    return F.coalesce(F.schema_of_variant(value).startswith("OBJECT"), F.lit(False))


def decode_events(df: DataFrame, body: str = "body") -> DataFrame:
    """Everything in the events from one parse of each body: readings, where ``part`` is null, and what is malformed.

    part "event": the body is no JSON object, or its ``values`` are none; "device" and "measure": that member is no
    object. ``text`` holds such a part as it came; its siblings are kept. An event without ``values`` and a device
    without measures are empty, not malformed. Numbers in text are read as numbers. An event with a key given twice is
    malformed, unless the session sets ``spark.sql.variant.allowDuplicateKeys``: then the last one counts.
    """
    events = df.select(F.col(body).alias("_body"), F.try_parse_json(body).alias("_event"))
    events = events.withColumn("_values", F.try_variant_get("_event", "$.values", "variant"))
    devices = _exploded(events, "_values", "device_id").withColumn("_array", F.col("_pos").isNotNull()).drop("_pos")
    named = F.col("device_id").isNotNull()
    # Only what has no members is looked at more closely.
    absent = F.coalesce(F.schema_of_variant("_values") == "VOID", F.lit(True))
    whole = F.col("_event").isNotNull() & F.coalesce(F.ltrim("_body").startswith("{"), F.lit(False))
    readable = named | (whole & ~F.col("_array") & (absent | _is_object("_values")))
    # Of an array no element is a device.
    devices = devices.withColumns({"_readable": whole & readable, "_device_id": F.when(named, F.col("_device_id"))})
    measures = _exploded(devices, "_device_id", "measure_name")
    member = F.col("measure_name").isNotNull()
    part = (
        F.when(~F.col("_readable"), "event")
        .when(~named, "none")
        .when(~member & (F.col("_pos").isNotNull() | ~_is_object("_device_id")), "device")
        .when(~member, "none")
        .when(~_is_object("_measure_name"), "measure")
    )
    text = (
        F.when(F.col("part") == "event", F.col("_body")).when(F.col("part") == "device", F.to_json("_device_id"))
        .when(F.col("part") == "measure", F.to_json("_measure_name"))
    )

    def event(name: str, kind: str) -> Column:
        return F.try_variant_get("_event", f"$.{name}", kind)

    def reading(name: str, kind: str) -> Column:
        return F.when(F.col("part").isNull(), F.try_variant_get("_measure_name", f"$.{name}", kind))

    return measures.withColumn("part", part).filter(F.coalesce(F.col("part") != "none", F.lit(True))).select(
        "device_id",
        F.coalesce(event("group_name", "string"), F.lit("")).alias("group_name"),
        event("timestamp", "bigint").alias("parent_timestamp"),
        event("timestampMsec", "bigint").alias("parent_timestampMsec"),
        "measure_name",
        nan_to_null(reading("raw_data", "double")).alias("raw_data"),
        reading("status", "int").alias("status"),
        reading("timestamp", "bigint").alias("measure_timestamp"),
        reading("timestampMsec", "bigint").alias("measure_timestampMsec"),
        "part",
        text.alias("text"),
    )


def explode_events(df: DataFrame, body: str = "body") -> DataFrame:
    """Raw long rows of the events. Devices and measures that are no object are dropped, the rest is kept."""
    return decode_events(df, body).filter(F.col("part").isNull()).drop("part", "text")


def malformed_parts(df: DataFrame, body: str = "body") -> DataFrame:
    """The events, devices and measures that ``explode_events`` drops, with their text."""
    bad = decode_events(df, body).filter(F.col("part").isNotNull())
    return bad.select("part", "parent_timestampMsec", "device_id", "measure_name", "text")


def pivot_measures(
    raw: DataFrame, mapping: dict[str, str] = MEASURE_COLUMNS, k: str = "device_id", ms: str = "parent_timestampMsec",
    measure: str = "measure_name", v: str = "raw_data",
) -> DataFrame:
    """Wide table: one row per (device, instant), one column per mapped measure, in one hash aggregation."""
    cells = [F.max(F.when(F.col(measure) == name, F.col(v))).alias(column) for name, column in mapping.items()]
    return raw.groupBy(k, ms).agg(*cells).withColumn("ts_s", F.timestamp_millis(ms)).select(
        k, ms, "ts_s", *mapping.values()
    )
