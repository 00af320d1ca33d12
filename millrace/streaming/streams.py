"""Streaming ingest, throttle, pivot, means, freshness and de-duplication."""

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from millrace.operators.reshape import explode_devices, explode_measures
from millrace.operators.throttle import _NONE_KEPT, kept_mask
from millrace.plans.pipeline import Tables, process_batch, refresh_derived
from millrace.schemas import DEVICE, MEASURE_COLUMNS, RAW, THROTTLE_SECONDS, TIME, VALUE
from millrace.sinks.store import BATCH, Change, Store
from millrace.sinks.tables import DATE, ROWS, with_date


def with_lateness(df: DataFrame, t: str = TIME, delay: str = "1 day") -> DataFrame:
    """Rows later than ``delay`` behind the newest one are left out of stateful operators."""
    return df.withWatermark(t, delay)


def throttle_stream(
    df: DataFrame, k: str = DEVICE, t: str = TIME, min_seconds: float = THROTTLE_SECONDS, delay: str = "1 day"
) -> DataFrame:
    """``throttle`` in the order of arrival. State is one number per device.

    Within a micro-batch rows are taken in time order. A row that arrives in a later micro-batch than a newer kept row
    of its device is dropped, so for sources that are ordered by device the result equals ``throttle``; for others it
    may keep fewer rows.

    Once the watermark is a whole gap past a device's last kept row, any row still to come is kept
    anyway, so the state is dropped then and cannot grow with devices that fell silent. A device's
    rows of one micro-batch are sorted together; the source's rate options (``maxOffsetsPerTrigger``,
    ``maxFilesPerTrigger``) bound that.
    """
    gap = round(min_seconds * 1_000_000)
    columns = df.columns
    timed = with_lateness(df.withColumn("_us", F.unix_micros(t)), t, delay)

    def step(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rows = pd.concat(list(chunks), ignore_index=True).sort_values("_us", kind="stable")
        last = state.get[0] if state.exists else _NONE_KEPT
        us = rows["_us"].to_numpy()
        keep = kept_mask(us, gap, last)
        if keep.any():
            last = int(us[keep][-1])
        state.update((last,))
        state.setTimeoutTimestamp(max((last + gap) // 1000, state.getCurrentWatermarkMs()) + 1)
        yield rows.loc[keep, columns]

    return timed.groupBy(k).applyInPandasWithState(
        step, df.schema, "last bigint", "append", GroupStateTimeout.EventTimeTimeout
    )


def _ordered_throttle(gap: int, columns: Sequence[str], schema: T.StructType) -> StatefulProcessor:
    """The processor of ``throttle_stream_ordered``.

    Spark also loads it in a Python process of the driver, which knows neither the driver's ``sys.path`` nor the files sent
    to the executors. A class made here is sent whole, and what it needs of this package is imported on the executors.
    """

    class OrderedThrottle(StatefulProcessor):
        """Rows of a device wait, in a list, until the watermark has passed them; then they are thinned in time order."""

        def __init__(self, gap: int, columns: Sequence[str], schema: T.StructType):
            self.gap, self.columns, self.schema = gap, list(columns), schema

        def init(self, handle) -> None:
            self.handle = handle
            self.waiting = handle.getListState("waiting", self.schema)
            self.last = handle.getValueState("last", "us long")

        def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
            at = self.schema.names.index("_us")
            new = [tuple(r[c] for c in self.schema.names) for r in rows]
            if new:
                self.waiting.appendList(new)
                self._wake(min(r[at] for r in new))
            return iter(())

        def _wake(self, us: int) -> None:
            # The watermark must be past the time itself: rows of that very time may still come.
            self.handle.registerTimer(us // 1000 + 1)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
            from millrace.operators.throttle import kept_mask

            at = self.schema.names.index("_us")
            passed = timerValues.getCurrentWatermarkInMs()
            rows = sorted((tuple(r) for r in self.waiting.get()), key=lambda r: r[at])
            due = [r for r in rows if r[at] // 1000 < passed]
            if not due:
                # Another timer has taken these rows; only one that has nothing left to wait for drops the state.
                if not rows and self.last.exists() and self.last.get()[0] + self.gap <= passed * 1000:
                    self.last.clear()
                return
            rest = rows[len(due):]
            if rest:
                self.waiting.put(rest)
                self._wake(rest[0][at])
            else:
                self.waiting.clear()
            last = self.last.get()[0] if self.last.exists() else _NONE_KEPT
            keep = kept_mask(np.array([r[at] for r in due], np.int64), self.gap, last)
            if keep.any():
                last = due[int(np.flatnonzero(keep)[-1])][at]
                self.last.update((last,))
            if last != _NONE_KEPT:
                # Once the watermark is a whole gap past it, the last kept row holds nothing back any more.
                self.handle.registerTimer(max((last + self.gap) // 1000 + 1, passed + 1))
            names = self.schema.names
            for row, good in zip(due, keep):
                if good:
                    by_name = dict(zip(names, row))
                    yield Row(**{c: by_name[c] for c in self.columns})

        def close(self) -> None:
            pass

    return OrderedThrottle(gap, columns, schema)


def throttle_stream_ordered(
    df: DataFrame, k: str = DEVICE, t: str = TIME, min_seconds: float = THROTTLE_SECONDS, delay: str = "1 day"
) -> DataFrame:
    """``throttle`` in time order, however the rows arrive within ``delay``; equal to it on all rows the watermark has
    passed.

    A row is held back until the watermark is past it, so rows come out ``delay`` later, and a device's state is its rows
    of that time. Rows later than that are dropped, as by every stateful operator. Needs the RocksDB state store, which
    ``build_session`` sets; in another session start the query inside ``rocksdb_state``.
    """
    gap = round(min_seconds * 1_000_000)
    timed = with_lateness(df.filter(F.col(t).isNotNull()).withColumn("_us", F.unix_micros(t)), t, delay)
    processor = _ordered_throttle(gap, df.columns, T.StructType(timed.schema.fields))
    return timed.groupBy(k).transformWithState(processor, df.schema, "append", "EventTime")


def decode_stream(events: DataFrame, min_seconds: float | None = THROTTLE_SECONDS) -> DataFrame:
    """Events to raw long rows, throttled per device on the event's own time; None = no throttle."""
    devices = explode_devices(events)
    if min_seconds is not None:
        placed = devices.withColumn("_at", F.timestamp_millis("parent_timestampMsec"))
        timed = throttle_stream(placed.filter(F.col("_at").isNotNull()), "device_id", "_at", min_seconds)
        # Events without a time cannot be throttled; they are passed on as without a throttle.
        devices = timed.drop("_at").unionByName(devices.filter(F.col("parent_timestampMsec").isNull()))
    return explode_measures(devices)


def ingest_stream(
    events: DataFrame, path: str, checkpoint: str, min_seconds: float | None = THROTTLE_SECONDS,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Events into the raw table. The file sink commits a batch as a whole, so a replay adds nothing twice."""
    rows = with_date(decode_stream(events, min_seconds), "parent_timestampMsec")
    return (
        rows.writeStream.format("parquet")
        .partitionBy(DATE)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "20 seconds"}))
        .start()
    )


def run_pipeline(
    spark: SparkSession, tables: Tables, checkpoint: str, trigger: dict | None = None, max_files: int | None = 1000,
    devices: DataFrame | None = None, refresh_every: int = 1, vacuum_every: int = 100, **options,
) -> StreamingQuery:
    """Follow the raw table and bring the wide and clean tables up to date, one commit for each micro-batch.

    With ``devices`` (the registry) the derived tables are refreshed after every ``refresh_every`` micro-batches. After
    every ``vacuum_every`` all but the last 50 commits go, and the files only they name.
    """
    reader = spark.readStream.schema(RAW)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    raw = reader.parquet(tables.path("raw"))

    def advance(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            process_batch(tables, batch, number, checkpoint, **options)
        if devices is not None and (number + 1) % refresh_every == 0:
            refresh_derived(tables, devices)
        if (number + 1) % vacuum_every == 0:
            tables.store(spark).vacuum(50)

    return (
        raw.writeStream.foreachBatch(advance)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "20 seconds"}))
        .start()
    )


def pivot_stream(
    raw: DataFrame, delay: str = "1 hour", mapping: dict[str, str] = MEASURE_COLUMNS, k: str = "device_id",
    ms: str = "parent_timestampMsec", measure: str = "measure_name", v: str = "raw_data",
) -> DataFrame:
    """Streaming twin of ``pivot_measures``. In update mode every instant comes out, again after each change; in append
    mode an instant comes out once, when the watermark passes it."""
    cells = [F.max(F.when(F.col(measure) == name, F.col(v))).alias(column) for name, column in mapping.items()]
    timed = with_lateness(raw.withColumn("ts_s", F.timestamp_millis(ms)), "ts_s", delay)
    return timed.groupBy(k, "ts_s").agg(*cells)


def upsert_sink(
    stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], trigger: dict | None = None, dated: bool = False
) -> StreamingQuery:
    """An update stream into a versioned table: of every key the last state. Each micro-batch writes its own rows only
    and is committed with its number under the name of the checkpoint, so one that is delivered again writes nothing."""
    mark = f"{BATCH} of {checkpoint}"

    def upsert(batch: DataFrame, number: int) -> None:
        store = Store(batch.sparkSession, path)
        now = store.snapshot()
        if now.marks.get(mark, -1) >= number:
            batch.write.format("noop").mode("overwrite").save()  # the state of the stream goes on all the same
        else:
            store.compact(store.commit(now, [Change(ROWS, batch, keys, dated)], {mark: number}))

    return (
        stream.writeStream.outputMode("update").foreachBatch(upsert).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "20 seconds"})).start()
    )


def latest_stream(df: DataFrame, k: str = DEVICE, t: str = TIME) -> DataFrame:
    """Latest time per device; use update or complete mode."""
    return df.groupBy(k).agg(F.max(t).alias("latest_measurement"))


def daily_mean_stream(
    df: DataFrame, delay: str = "1 day", k: str = DEVICE, t: str = TIME, v: str = VALUE
) -> DataFrame:
    """Streaming twin of ``daily_mean`` (days of UTC). In update mode every day comes out, again after each change; in
    append mode a day comes out once, when the watermark passes its end."""
    means = (
        with_lateness(df.filter(F.col(v).isNotNull()), t, delay)
        .groupBy(F.window(t, "1 day"), k)
        .agg(F.avg(v).alias("flow_avg_day"))
    )
    return means.select(k, F.to_date("window.start").alias("giorno"), "flow_avg_day")


def dedupe_stream(df: DataFrame, keys: Sequence[str], t: str = TIME, delay: str = "1 hour") -> DataFrame:
    """Drop repeated deliveries of a key within the lateness bound."""
    return with_lateness(df, t, delay).dropDuplicatesWithinWatermark(list(keys))
