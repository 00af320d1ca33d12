"""Table writers: append, insert-or-ignore, upsert, marks, full refresh, CSV. Changing tables are versioned, see ``store``."""

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.dedupe import dedupe_first, dedupe_last
from millrace.schemas import DEVICE, ETL_STATE, TABLES
from millrace.session import stage
from millrace.sinks.store import DATE, Change, Files, Snapshot, Store, is_store, without

ROWS = "rows"


def with_date(df: DataFrame, t: str) -> DataFrame:
    """Add the partition date; ``t`` is a timestamp or an epoch-ms number."""
    numeric = df.schema[t].dataType.typeName() == "long"
    return df.withColumn(DATE, F.to_date(F.timestamp_millis(t) if numeric else F.col(t)))


def append_raw(df: DataFrame, path: str, t: str = "parent_timestampMsec") -> None:
    """Append by date. The rebalance hint splits a hot date over several files and merges small ones."""
    with_date(df, t).hint("rebalance", DATE).write.mode("append").partitionBy(DATE).parquet(path)


def insert_ignore(target: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows of ``new`` to append: one per key (the first along ``order``), keys already stored left out."""
    first = dedupe_first(new, keys, order)
    return without(first, target, keys)


def upsert(target: DataFrame, new: DataFrame, keys: Sequence[str], version: Sequence[str]) -> DataFrame:
    """The table after the upsert: ``new`` replaces equal keys, its last row along ``version`` wins.

    Stored rows are only anti-joined with the new keys, never sorted or grouped.
    """
    last = dedupe_last(new, keys, version)
    return without(target, last, keys).unionByName(last, allowMissingColumns=True)


def table_exists(spark: SparkSession, path: str) -> bool:
    return Files(spark).exists(path)


def days_of(df: DataFrame) -> list[dt.date]:
    """The days that occur, in order: a list that grows with the calendar, not with the rows."""
    return sorted(row[0] for row in df.select(DATE).distinct().collect() if row[0] is not None)


def open_table(spark: SparkSession, path: str) -> DataFrame:
    """The current rows of the table at ``path``, versioned or plain Parquet."""
    return Store(spark, path).read(ROWS) if is_store(spark, path) else spark.read.parquet(path)


def upsert_snapshot(path: str, new: DataFrame, keys: Sequence[str], version: Sequence[str]) -> None:
    """Upsert into a table without dates (statistics, histogram, state): only the new rows are written."""
    store = Store(new.sparkSession, path)
    base = store.commit(store.snapshot(), [Change(ROWS, dedupe_last(new, keys, version), keys, dated=False)])
    store.compact(base)


def upsert_dated(path: str, new: DataFrame, keys: Sequence[str], version: Sequence[str], t: str) -> None:
    """Upsert into a table by date: only the new rows are written.

    The key contains ``t``, so a key never moves to another date.
    """
    store = Store(new.sparkSession, path)
    rows = dedupe_last(with_date(new, t), [*keys, DATE], version)
    store.compact(store.commit(store.snapshot(), [Change(ROWS, rows, keys)]))


def insert_new(base: Snapshot, table: str, rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows of ``rows`` (with their date) to add to a table of ``base``; reads the keys of the touched dates only."""
    if not base.has(table):
        return dedupe_first(rows, keys, order)
    return insert_ignore(base.read(table, days_of(rows)), rows, keys, order)


def insert_ignore_dated(path: str, new: DataFrame, keys: Sequence[str], order: Sequence[str], t: str) -> None:
    """Insert-or-ignore into a table by date."""
    store = Store(new.sparkSession, path)
    base = store.snapshot()
    dated = stage(with_date(new, t), "increment")
    store.commit(base, [Change(ROWS, insert_new(base, ROWS, dated, keys, order))])


def read_mark(state: DataFrame, job: str) -> int:
    """Stored mark of a job in epoch ms, 0 if it has none."""
    row = state.filter(F.col("job_name") == job).agg(F.max("last_parent_timestampmsec")).head()
    return row[0] or 0


def advance_mark(state: DataFrame, job: str, marks: DataFrame) -> DataFrame:
    """State after a batch; ``marks`` holds the batch's ``max_ts``. A mark never moves back."""
    new = marks.select(
        F.lit(job).alias("job_name"),
        F.col("max_ts").alias("last_parent_timestampmsec"),
        F.current_timestamp().alias("updated_at"),
    )
    return dedupe_last(
        state.select(*ETL_STATE.names).unionByName(new), ["job_name"], ["last_parent_timestampmsec", "updated_at"]
    )


def refresh_table(df: DataFrame, path: str) -> None:
    """Rebuild a derived table, which ``df`` may read; the old one is read until the new one is complete."""
    store = Store(df.sparkSession, path)
    store.commit(store.snapshot(), [Change(ROWS, df, dated=False, replace=True)])


def write_csv(df: DataFrame, path: str, k: str | None = DEVICE) -> None:
    """CSV with a header, one folder per device unless ``k`` is None."""
    writer = df.write.mode("overwrite").option("header", True)
    if k is None:
        writer.csv(path)
    else:
        writer.partitionBy(k).csv(path)


def ensure_table(spark: SparkSession, name: str, database: str = "default") -> DataFrame:
    """Create the named table with its declared schema if it is not there, and return it."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS `{database}`.`{name}` ({TABLES[name].toDDL()}) USING parquet")
    return spark.table(f"`{database}`.`{name}`")
