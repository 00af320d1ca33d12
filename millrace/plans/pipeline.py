"""The jobs that keep the tables up to date: raw -> wide -> clean -> statistics, histogram, curve.

All tables but ``raw`` are in one store (``millrace.sinks.store``): what an increment changes, the progress marks included,
becomes visible in one commit. A job that stops before it has changed nothing and is simply run again.
"""

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.daystates import (
    border_days,
    curve_from_states,
    day_bins,
    day_states,
    histogram_from_days,
    period_starts,
    ranges_from_states,
    stats_from_states,
)
from millrace.operators.filters import histogram_window, newer_than
from millrace.operators.hampel import needed_days, reclean, refilter
from millrace.operators.histogram import flow_histogram
from millrace.operators.reshape import pivot_measures
from millrace.operators.stats import batch_mark
from millrace.schemas import (
    CLEAN,
    CURVE,
    DEVICE,
    ETL_STATE,
    HAMPEL_WINDOW,
    HISTOGRAM,
    HISTOGRAM_BINS,
    MEASURE_COLUMNS,
    MEASUREMENTS,
    OUTLIER,
    RAW,
    RAW_VALUE,
    STATS,
    TIME,
    VALUE,
)
from millrace.session import stage, staging_scope
from millrace.sinks.store import DATE, NO_DATE, Change, Files, Snapshot, Store
from millrace.sinks.tables import advance_mark, days_of, read_mark, with_date, without

FLOW = "instant_flow_rate_2"
TRANSFORM, CLEANING = "transform_raw_to_measurements", "clean_measurements"
# Marks of the store: the last stream batch taken in, the last commit seen by the derived tables.
# REGISTRY: checksum of the devices the curve was last made for.
STREAM, DERIVED, REGISTRY = "stream_batch", "derived", "registry"
_CLEAN_KEYS = [DEVICE, TIME]
_HISTOGRAM_KEYS = [DEVICE, "window_start", "window_end", "bin_index"]


@dataclass(frozen=True)
class Tables:
    """The tables under one root: ``raw`` as plain files that are only added to, the others in a store."""

    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def store(self, spark: SparkSession) -> Store:
        return Store(spark, self.root)

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.read.parquet(self.path(name)) if name == "raw" else self.store(spark).read(name)


def _dated(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(DATE, T.DateType())])


def ensure_tables(tables: Tables, spark: SparkSession) -> Snapshot:
    """Commit every table that is not there yet, empty and with its declared columns."""
    store = tables.store(spark)
    now = store.snapshot()
    declared = {
        "measurements": (MEASUREMENTS, [], True), "clean": (CLEAN, _CLEAN_KEYS, True), "stats": (STATS, [DEVICE], False),
        "histogram": (HISTOGRAM, _HISTOGRAM_KEYS, False), "duration_curve": (CURVE, [], False),
        "etl_state": (ETL_STATE, ["job_name"], False),
    }
    missing = [
        Change(name, with_date(spark.createDataFrame([], kind), kind.names[1]) if dated else
               spark.createDataFrame([], kind), keys, dated)
        for name, (kind, keys, dated) in declared.items() if not now.has(name)
    ]
    return store.commit(now, missing) if missing else now


def process_batch(tables: Tables, raw: DataFrame, batch: int | None = None, stream: str = "", **options) -> None:
    """One increment of the chain from new raw rows, as one commit.

    Rows without an instant go to the table ``quarantine``, each once: they have no key to be stored under. ``batch`` is
    the number of a micro-batch of the named stream; one that is committed already is skipped. Without it a repeated run
    finds its keys stored and changes nothing.
    """
    spark = raw.sparkSession
    store = tables.store(spark)
    now = store.snapshot()
    mark = f"{STREAM} of {stream}"
    if batch is not None and now.marks.get(mark, -1) >= batch:
        return
    with staging_scope(spark):
        done = _advance(store, now, stage(raw, "batch"), {} if batch is None else {mark: batch}, **options)
    store.compact(done)


def _advance(store: Store, now: Snapshot, raw: DataFrame, marks: dict[str, int], **options) -> Snapshot:
    changes = _increment(now, raw, **options)
    return store.commit(now, changes, marks) if changes or marks else now


def run_increment(tables: Tables, spark: SparkSession, lateness: dt.timedelta = dt.timedelta(0), **options) -> int:
    """The same for the raw rows after the stored mark; returns the new mark in epoch ms.

    Only rows strictly newer than the mark are taken, so raw rows that were written later but are older are missed; with
    ``lateness`` rows up to that much older are looked at again, and those that are not stored yet come in.
    """
    store = tables.store(spark)
    now = store.snapshot()
    mark = read_mark(now.read("etl_state"), TRANSFORM) if now.has("etl_state") else 0
    since = max(0, mark - lateness // dt.timedelta(milliseconds=1))
    # Days of the session time zone; only their folders are listed. Rows without an instant are in a folder of their own.
    first = str(dt.datetime.fromtimestamp(since / 1000, dt.UTC).date() - dt.timedelta(days=1))
    folders = [n for n in Files(spark).names(tables.path("raw")) if n.startswith(f"{DATE}=")]
    chosen = [f"{tables.path('raw')}/{n}" for n in folders if (day := n.removeprefix(f"{DATE}=")) >= first or day == NO_DATE]
    if not chosen:
        return mark
    raw = spark.read.schema(_dated(RAW)).option("basePath", tables.path("raw")).parquet(*chosen)
    new = newer_than(raw, "parent_timestampMsec", since).unionByName(raw.filter(F.col("parent_timestampMsec").isNull()))
    # The raw files stay as they are, so they are read where they lie.
    with staging_scope(spark):
        done = _advance(store, now, new.drop(DATE), {}, **options)
    store.compact(done)
    now = store.snapshot()
    return read_mark(now.read("etl_state"), TRANSFORM) if now.has("etl_state") else 0


def _increment(now: Snapshot, raw: DataFrame, **options) -> list[Change]:
    spark = raw.sparkSession
    timed = F.col("parent_timestampMsec").isNotNull()
    changes = []
    lost = raw.filter(~timed).distinct()
    if not lost.isEmpty():
        keys = lost.columns
        if now.has("quarantine"):
            lost = without(lost, now.read("quarantine"), keys)
        changes.append(Change("quarantine", stage(lost, "lost"), dated=False))
    raw = raw.filter(timed)
    new = stage(_unstored(now, raw), "insert")
    if not new.isEmpty():
        changes.append(Change("measurements", new))
        rows = new.select(F.col("device_id").alias(DEVICE), F.col("ts_s").alias(TIME), F.col(FLOW).alias("flow"), DATE)
        changes += clean_changes(now, rows, **options)
    marks = batch_mark(raw)
    if marks.head()[0]:
        state = now.read("etl_state") if now.has("etl_state") else spark.createDataFrame([], ETL_STATE)
        for job in (TRANSFORM, CLEANING):
            state = advance_mark(state, job, marks)
        changes.append(Change("etl_state", stage(state, "state"), ["job_name"], dated=False, replace=True))
    return changes


def _unstored(now: Snapshot, raw: DataFrame) -> DataFrame:
    """Wide rows, with their day, of the instants of ``raw`` that are not stored yet.

    The keys stored for these days go through the same aggregation as the readings, as cells of a column of their own;
    so rows that are looked at again are neither pivoted by themselves nor joined.
    """
    ms, stored = "parent_timestampMsec", "_stored"
    # A name that is not mapped has no cell, so the column of its own is safe from it.
    named = F.when(F.col("measure_name").isin(*MEASURE_COLUMNS), F.col("measure_name"))
    cells = raw.select("device_id", ms, named.alias("measure_name"), "raw_data")
    if now.has("measurements"):
        there = now.read("measurements", days_of(with_date(raw.select(ms), ms)))
        cells = cells.unionByName(there.select(
            "device_id", F.unix_millis("ts_s").alias(ms), F.lit(stored).alias("measure_name"), F.lit(1.0).alias("raw_data")))
    wide = pivot_measures(cells, MEASURE_COLUMNS | {stored: stored})
    return with_date(wide.filter(F.col(stored).isNull()).drop(stored, ms), "ts_s")


def clean_changes(now: Snapshot, new: DataFrame, window: int = HAMPEL_WINDOW, **options) -> list[Change]:
    """Changes of ``clean``, ``days`` and ``extents`` by new rows (device, time, flow, day).

    ``days`` (states of each device and day) is at the same time the index that tells which stored days the filter must
    read again: only those days of ``clean`` are opened, and of them only the devices in question.
    """
    spark = new.sparkSession
    if now.has("days"):
        around = stage(needed_days(lambda d: now.read("days", d), now.days("days"), now.read("extents"),
                                   new.select(DEVICE, DATE), window - 1), "around")
        stored = now.read("clean", days_of(around)).join(around, [DEVICE, DATE])
    else:
        stored = spark.createDataFrame([], _dated(CLEAN))
    kept = [DEVICE, TIME, RAW_VALUE, VALUE, OUTLIER, DATE]
    stored = stage(stored.select(*kept), "stored")
    changed = refilter(stored, new, v="flow", window=window, **options)
    changed = stage(with_date(changed, TIME).withColumn("updated_at", F.current_timestamp()), "changed")
    touched = stage(changed.select(DEVICE, DATE).distinct(), "touched")
    rows = without(stored.join(touched, [DEVICE, DATE], "left_semi"), changed, _CLEAN_KEYS)
    states = day_states(rows.unionByName(changed.select(*kept)))
    states = stage(states.withColumn("changed_in", F.lit(now.number + 1).cast("long")), "states")
    extents = states.groupBy(DEVICE).agg(F.min(DATE).alias("first_day"), F.max(DATE).alias("last_day"))
    if now.has("extents"):
        extents = (
            now.read("extents").join(extents.select(DEVICE), DEVICE, "left_semi").unionByName(extents).groupBy(DEVICE)
            .agg(F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day"))
        )
    return [
        Change("clean", changed, _CLEAN_KEYS), Change("days", states, [DEVICE, DATE]),
        Change("extents", stage(extents, "extents"), [DEVICE], dated=False),
    ]


def refresh_derived(
    tables: Tables, devices: DataFrame, as_of: Column | None = None, bins: int = HISTOGRAM_BINS, hours: int = 0
) -> None:
    """Bring statistics, histogram and curve up to date with what changed since the last refresh, as one commit.

    They are put together from day states, so old days are read only where a trailing period starts on them, and, for
    the histogram, for devices whose range has changed. Statistics and histogram are upserted for the touched devices,
    the curve is rebuilt from the states. A histogram of the last ``hours`` reads the days it covers.
    """
    spark = devices.sparkSession
    store = tables.store(spark)
    now = store.snapshot()
    as_of = F.current_timestamp() if as_of is None else as_of
    if not now.has("days"):
        return
    known = devices.select(DEVICE).distinct().agg(F.sum(F.xxhash64(DEVICE).cast("decimal(38,0)"))).head()[0]
    marks = {DERIVED: now.number, REGISTRY: int(known or 0)}
    with staging_scope(spark):
        same = now.marks.get(REGISTRY) == marks[REGISTRY]
        done = store.commit(now, _derived(now, devices, same, as_of, bins, hours), marks)
    store.compact(done)


def _derived(now: Snapshot, devices: DataFrame, same: bool, as_of: Column, bins: int, hours: int) -> list[Change]:
    """``same``: the curve was last made for these devices."""
    seen = now.marks.get(DERIVED, 0)
    changed = stage(now.read("days", since=seen).filter(F.col("changed_in") > seen).select(DEVICE, DATE), "changed-days")
    curve = Change("duration_curve", curve_from_states(now.read("days"), devices), dated=False, replace=True)
    if seen and changed.isEmpty():
        return ([] if same else [curve]) + _windowed(now, devices, as_of, bins, hours)
    touched = stage(changed.select(DEVICE).distinct(), "touched-devices")
    states = stage(now.read("days").join(touched, DEVICE, "left_semi"), "touched-states")
    starts = stage(period_starts(states), "starts")
    border = stage(border_days(starts), "border")
    rows = now.read("clean", days_of(border)).join(border, [DEVICE, DATE], "left_semi")
    changes = [
        Change("stats", stats_from_states(states, starts, rows, as_of), [DEVICE], dated=False), curve,
    ]
    if hours:
        return changes + _windowed(now, devices, as_of, bins, hours)
    return changes + _histogram_changes(now, states, changed, as_of, bins)


def _windowed(now: Snapshot, devices: DataFrame, as_of: Column, bins: int, hours: int) -> list[Change]:
    """The histogram of the last ``hours``, if any."""
    if not hours:
        return []
    start, end = histogram_window(as_of, hours)
    first, last = (x.date() for x in devices.sparkSession.range(1).select(start, end).head())
    clean = now.read("clean", [d for d in now.days("clean") if first <= d <= last])
    return [Change("histogram", stage(flow_histogram(clean, bins, hours, as_of), "histogram"), _HISTOGRAM_KEYS, dated=False)]


def _histogram_changes(now: Snapshot, states: DataFrame, changed: DataFrame, as_of: Column, bins: int) -> list[Change]:
    """Bin counts of the touched days, of all days where the range or the number of bins is another, and their sums."""
    ranges = stage(ranges_from_states(states).withColumn("n_bins", F.lit(bins)), "ranges")
    if now.has("ranges"):
        known = now.read("ranges").select(DEVICE, F.struct("min_v", "max_v", "n_bins").alias("_old"))
        same = F.col("_old").eqNullSafe(F.struct("min_v", "max_v", "n_bins"))
        moved = stage(ranges.join(known, DEVICE, "left").filter(~same).select(DEVICE), "moved")
    else:
        moved = ranges.select(DEVICE)
    again = stage(
        changed.unionByName(states.join(moved, DEVICE, "left_semi").select(DEVICE, DATE)).distinct(), "bin-days")
    rows = now.read("clean", days_of(again)).join(again, [DEVICE, DATE], "left_semi")
    # A day that is without values now keeps a row, so that it replaces an older state.
    fresh = again.join(day_bins(rows, ranges, bins), [DEVICE, DATE], "left")
    fresh = stage(fresh, "day-bins")
    days = fresh
    if now.has("day_bins"):
        stored = now.read("day_bins").join(ranges.select(DEVICE), DEVICE, "left_semi")
        days = without(stored, fresh, [DEVICE, DATE]).unionByName(fresh)
    start, _ = histogram_window(as_of, 0)
    made = histogram_from_days(days, ranges.drop("n_bins"), bins, start, F.lit(None).cast("timestamp"), as_of)
    return [
        Change("ranges", ranges, [DEVICE], dated=False), Change("day_bins", fresh, [DEVICE, DATE]),
        Change("histogram", made, _HISTOGRAM_KEYS, dated=False),
    ]


def regenerate_clean(tables: Tables, spark: SparkSession, **options) -> None:
    """Filter every stored series again and upsert the result and the states of all days."""
    store = tables.store(spark)
    now = store.snapshot()
    if not now.has("days"):
        return
    with staging_scope(spark):
        rows = with_date(reclean(now.read("clean"), **options), TIME).withColumn("updated_at", F.current_timestamp())
        rows = stage(rows, "clean")
        states = day_states(rows).withColumn("changed_in", F.lit(now.number + 1).cast("long"))
        done = store.commit(now, [Change("clean", rows, _CLEAN_KEYS), Change("days", states, [DEVICE, DATE])])
    store.compact(done, 1)
