"""Ordered work on device series that stays parallel when one device holds most of the rows.

A device with at most ``hot_rows`` rows is one window partition. A larger one is sorted by a range
shuffle, numbered, cut into blocks of equal size, and every block gets copies of the ``radius``
rows on either side, so that a window function sees the same neighbours as in the whole series.
"""

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import bounded, stage

HOT_ROWS = 2_000_000
_ROW_IN_PARTITION = (1 << 33) - 1  # low bits of monotonically_increasing_id

POSITION, TOTAL = "_pos", "_total"
BLOCK = "_block"


def hot_keys(df: DataFrame, k: str, hot_rows: int) -> DataFrame | None:
    """Keys with more than ``hot_rows`` rows, or None. One map-side combined count over ``k``."""
    counts = df.groupBy(k).agg(F.count(F.lit(1)).alias("_rows"))
    return bounded(counts.filter(F.col("_rows") > hot_rows).select(k), "hot-keys")


def split_hot(
    df: DataFrame, k: str, hot_rows: int, counted: DataFrame | None = None
) -> tuple[DataFrame, DataFrame | None]:
    """(other rows, rows of hot keys or None). ``counted`` has the keys of all rows of ``df``, or of more, and is cheaper to
    count."""
    hot = hot_keys(df if counted is None else counted, k, hot_rows)
    if hot is None:
        return df, None
    hot = hot.select(F.col(k).alias("_hot"))
    same = F.col(k).eqNullSafe(F.col("_hot"))
    return df.join(hot, same, "left_anti"), df.join(hot, same, "left_semi")


def sorted_positions(df: DataFrame, k: str, order: Sequence[str]) -> DataFrame:
    """Number the rows of each key 0.. along ``order`` without one task per key.

    The range shuffle samples the sort key, so a hot key spreads over many partitions; the last
    sort column makes even identical copies divisible. The sorted rows are written once, because
    the range limits differ from run to run, then the key counts per partition give the offsets.
    """
    rows = stage(
        df.withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(k, *order, "_tie")
        .sortWithinPartitions(k, *order, "_tie")
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_at", F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_IN_PARTITION)))
        .drop("_tie"),
        "sorted",
    )
    parts = rows.groupBy(k, "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    per_key = Window.partitionBy(k)
    before = per_key.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stage(
        parts.select(
            k,
            "_part",
            (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
            F.sum("_n").over(per_key).alias(TOTAL),
        ),
        "offsets",
    )
    return (
        rows.join(offsets, [k, "_part"])
        .withColumn(POSITION, F.col("_at") + F.col("_shift"))
        .drop("_part", "_at", "_shift")
    )


def with_position(df: DataFrame, k: str, order: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Add ``_pos`` (0-based place in the device's series) and ``_total`` (its length)."""
    cold, hot = split_hot(df, k, hot_rows)
    per_key = Window.partitionBy(k)
    placed = cold.withColumn(POSITION, F.row_number().over(per_key.orderBy(*order)).cast("long") - 1).withColumn(
        TOTAL, F.count(F.lit(1)).over(per_key)
    )
    if hot is None:
        return placed
    return placed.unionByName(sorted_positions(hot, k, order).select(*placed.columns))


def in_blocks(df: DataFrame, k: str, order: Sequence[str], block_rows: int) -> DataFrame:
    """Add ``_pos``, ``_total`` and ``_block`` = equal runs of ``block_rows`` rows per key."""
    placed = sorted_positions(df, k, order)
    return placed.withColumn(BLOCK, F.floor(F.col(POSITION) / block_rows).cast("long"))


def over_series(
    df: DataFrame,
    k: str,
    order: Sequence[str],
    radius: int,
    compute: Callable[[DataFrame, list[str]], DataFrame],
    hot_rows: int = HOT_ROWS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Apply row-window logic per device.

    ``compute(rows, part)`` adds columns using windows partitioned by the columns ``part`` and
    ordered by ``order`` that look at most ``radius`` rows away; it keeps the other columns. ``counted``: see
    ``split_hot``.
    """
    cold, hot = split_hot(df, k, hot_rows, counted)
    done = compute(cold, [k])
    if hot is None:
        return done
    block_rows = max(hot_rows, radius, 1)
    placed = in_blocks(hot, k, order, block_rows)
    within = F.col(POSITION) - F.col("_home") * block_rows
    to_previous = F.when((within < radius) & (F.col("_home") > 0), F.col("_home") - 1)
    to_next = F.when(
        (within >= block_rows - radius) & ((F.col("_home") + 1) * block_rows < F.col(TOTAL)), F.col("_home") + 1
    )
    spread = (
        placed.withColumnRenamed(BLOCK, "_home")
        .withColumn(BLOCK, F.explode(F.array_compact(F.array("_home", to_previous, to_next))))
        .withColumn("_core", F.col("_home") == F.col(BLOCK))
        .drop("_home", POSITION, TOTAL)
    )
    blocked = compute(spread, [k, BLOCK]).filter("_core").select(*done.columns)
    return done.unionByName(blocked)


def over_sorted(
    df: DataFrame,
    part: Sequence[str],
    order: Sequence[str],
    compute: Callable[[pa.Table, np.ndarray], pa.Table],
    schema: T.StructType,
) -> DataFrame:
    """Vectorised work on ordered series: ``compute(table, starts)`` gets whole series, one after another.

    Shuffle and sort stay in the JVM. The Arrow batches of a partition are cut between series, so many
    small series share one call; a series must fit a task (see ``split_hot`` and ``over_series``).

    The shuffle is by a hash of ``part``, not by ``part``: a plain repartition is dropped where a join
    below already shuffles by the same columns, and if that join is then turned into a broadcast join
    at run time, its partitions are read by map task and a series is torn apart.
    """
    part = list(part)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_keys(batches, part):
            yield from compute(table, key_starts(table, part)).to_batches()

    return df.repartition(F.xxhash64(*part)).sortWithinPartitions(*part, *order).mapInArrow(run, schema)


def per_key_rows(
    df: DataFrame, k: str, order: Sequence[str], choose: Callable[[pa.Table, int, int], np.ndarray], columns: list[str]
) -> DataFrame:
    """Keep the rows that ``choose(table, start, end)`` picks from each key's run of rows, in order."""

    def pick(table: pa.Table, starts: np.ndarray) -> pa.Table:
        ends = np.append(starts[1:], table.num_rows)
        rows = np.concatenate([choose(table, start, end) for start, end in zip(starts, ends)])
        return table.select(columns).take(pa.array(rows))

    return over_sorted(df, [k], order, pick, df.select(*columns).schema)


def key_starts(table: pa.Table, part: Sequence[str]) -> np.ndarray:
    """Row numbers at which a new key begins."""
    changed = np.zeros(table.num_rows, dtype=bool)
    changed[0] = True
    for c in part:
        codes = table.column(c).combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
        changed[1:] |= codes[1:] != codes[:-1]
    return np.flatnonzero(changed)


def _whole_keys(batches: Iterator[pa.RecordBatch], part: Sequence[str]) -> Iterator[pa.Table]:
    def key(batch: pa.RecordBatch, row: int) -> list:
        return [batch.column(c)[row].as_py() for c in part]

    pending: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        if pending and key(pending[-1], -1) != key(batch, 0):
            yield pa.Table.from_batches(pending)
            pending = []
        last = int(key_starts(pa.Table.from_batches([batch]), part)[-1])
        if last:
            yield pa.Table.from_batches([*pending, batch.slice(0, last)])
            pending = []
        pending.append(batch.slice(last))
    if pending:
        yield pa.Table.from_batches(pending)
