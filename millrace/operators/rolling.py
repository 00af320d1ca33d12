"""Rolling means over a period of time, from prefix sums.

The sum of a frame is the difference of two prefix sums, so a row costs the same however many rows its frame has. Prefix
sums are kept as two floats (a long double) of values less a centre, and start again in every partition, so that little
is lost in the difference.

A hot device is not cut into blocks of its own period, which may hold any number of rows: its rows are sorted by a range
shuffle together with two probes for each row, at the start and the end of its frame. Every partition sums up alone, and
the sums of the partitions between two probes are added. So neither the length of the period nor the density of the
series bounds what one task gets.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.scalars import interval
from millrace.operators.layout import HOT_ROWS, key_starts, over_sorted, split_hot
from millrace.schemas import DEVICE, TIME, VALUE
from millrace.session import stage

_START, _ROW, _END, _TOTAL = range(4)
_COUNTS = ["n", "nan", "up", "down"]
_SUMS = ["high", "low", *_COUNTS]


def first_from(values: np.ndarray, wanted: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """For each i the first place in ``low[i]:high[i]`` whose value is at least ``wanted[i]``, else ``high[i]``."""
    low, high = low.copy(), high.copy()
    live = np.flatnonzero(low < high)
    while len(live):
        middle = (low[live] + high[live]) >> 1
        below = values[middle] < wanted[live]
        low[live[below]] = middle[below] + 1
        high[live[~below]] = middle[~below]
        live = live[low[live] < high[live]]
    return low


def _prefix(values: np.ndarray) -> np.ndarray:
    return np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])


def _kinds(v: np.ndarray, present: np.ndarray) -> dict[str, np.ndarray]:
    """1 where a reading is a finite number, NaN, or an infinity of either sign."""
    return {"n": present & np.isfinite(v), "nan": present & np.isnan(v), "up": present & (v == np.inf),
            "down": present & (v == -np.inf)}


def _mean(total, count, nan, up, down):
    """Mean of frames from their sums; the rules of floating-point addition for readings that are no finite numbers."""
    with np.errstate(divide="ignore", invalid="ignore"):
        mean = np.where(count > 0, total / np.maximum(count, 1), np.nan).astype(np.float64)
    mean = np.where(up > 0, np.inf, np.where(down > 0, -np.inf, mean))
    mean = np.where((nan > 0) | ((up > 0) & (down > 0)), np.nan, mean)
    return pa.array(mean, mask=(count + nan + up + down) == 0)


def _cold(df: DataFrame, k: str, t: str) -> DataFrame:
    schema = df.drop("_us", "_from", "_v").schema.add("rolling_mean", "double")

    def compute(table: pa.Table, starts: np.ndarray) -> pa.Table:
        n = table.num_rows
        timed = table.column("_us").combine_chunks().is_valid().to_numpy(zero_copy_only=False)
        us, start_at = (table.column(c).combine_chunks().fill_null(0).to_numpy() for c in ("_us", "_from"))
        reading = table.column("_v").combine_chunks()
        present = reading.is_valid().to_numpy(zero_copy_only=False) & timed
        v = reading.fill_null(0.0).to_numpy()
        size = np.diff(np.append(starts, n))
        # Rows without a time come first in their series and belong to no frame.
        low = np.repeat(starts + np.add.reduceat(~timed, starts), size)
        high = np.repeat(starts + size, size)
        a = first_from(us, start_at, low, high)
        b = first_from(us, us + 1, low, high)
        kinds = _kinds(v, present)
        finite = np.where(kinds["n"], v, 0.0)
        centre = np.add.reduceat(finite, starts) / np.maximum(np.add.reduceat(kinds["n"].astype(np.int64), starts), 1)
        centre = np.where(np.isfinite(centre), centre, 0.0)
        off = np.repeat(centre, size)
        sums = _prefix(np.where(kinds["n"], v - off, 0.0).astype(np.longdouble))
        counts = {c: _prefix(x.astype(np.int64)) for c, x in kinds.items()}
        count = {c: np.where(timed, x[b] - x[a], 0) for c, x in counts.items()}
        total = sums[b] - sums[a] + off.astype(np.longdouble) * count["n"]
        mean = _mean(total, count["n"], count["nan"], count["up"], count["down"])
        return table.drop_columns(["_us", "_from", "_v"]).append_column("rolling_mean", mean)

    return over_sorted(df, [k], ["_us"], compute, schema)


def _partial_sums(rows: DataFrame, k: str) -> DataFrame:
    """For every probe the sums of the values before it in its partition; for every device and partition its totals."""
    kind = rows.schema[k].dataType.simpleString()
    shape = f"`{k}` {kind}, part int, kind int, id long, high double, low double, n long, nan long, up long, down long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, part, carry, counts = None, None, np.longdouble(0), dict.fromkeys(_COUNTS, 0)

        def made(keys, parts, kinds, ids, sums, found) -> pa.RecordBatch:
            high = sums.astype(np.float64)
            low = (sums - high).astype(np.float64)
            return pa.RecordBatch.from_arrays(
                [keys, pa.array(parts, pa.int32()), pa.array(kinds, pa.int32()), pa.array(ids, pa.int64()),
                 pa.array(high), pa.array(low), *(pa.array(found[c], pa.int64()) for c in _COUNTS)],
                names=[k, "part", "kind", "id", *_SUMS])

        def total() -> pa.RecordBatch:
            one = {c: [x] for c, x in counts.items()}
            return made(key, [part], [_TOTAL], [-1], np.array([carry], np.longdouble), one)

        for batch in batches:
            if batch.num_rows == 0:
                continue
            table = pa.Table.from_batches([batch])
            for start, end in zip(s := key_starts(table, [k]), np.append(s[1:], batch.num_rows)):
                piece = batch.slice(int(start), int(end - start))
                own = piece.column(k).slice(0, 1)
                if key is not None and not own.equals(key):
                    yield total()
                    carry, counts = np.longdouble(0), dict.fromkeys(_COUNTS, 0)
                key, part = own, piece.column("_part")[0].as_py()
                probe = piece.column("kind").to_numpy() != _ROW
                reading = piece.column("v")
                present = reading.is_valid().to_numpy(zero_copy_only=False) & ~probe
                v = reading.fill_null(0.0).to_numpy(zero_copy_only=False)
                kinds = _kinds(v, present)
                off = piece.column("_centre").to_numpy(zero_copy_only=False)
                sums = carry + np.cumsum(np.where(kinds["n"], v - off, 0.0).astype(np.longdouble))
                found = {c: counts[c] + np.cumsum(x.astype(np.int64)) for c, x in kinds.items()}
                carry, counts = sums[-1], {c: int(x[-1]) for c, x in found.items()}
                # What lies before a probe is what is summed at it: probes add nothing.
                some = np.flatnonzero(probe)
                if len(some):
                    yield made(piece.column(k).take(pa.array(some)), np.full(len(some), part),
                               piece.column("kind").to_numpy()[some], piece.column("id").to_numpy()[some], sums[some],
                               {c: x[some] for c, x in found.items()})
        if key is not None:
            yield total()

    return rows.mapInArrow(run, shape)


def _hot(rows: DataFrame, k: str) -> DataFrame:
    rows = stage(rows.withColumn("_id", F.monotonically_increasing_id()), "rolling-rows")
    usable = F.when(F.abs(F.col("_v")) < float("inf"), F.col("_v"))
    centres = rows.groupBy(F.col(k).alias("_kc")).agg(F.coalesce(F.avg(usable), F.lit(0.0)).alias("_centre"))
    centres = stage(centres, "centres")
    none = F.lit(None).cast("double")
    marks = F.explode(F.array(
        F.struct(F.col("_from").alias("us"), F.lit(_START).alias("kind"), none.alias("v")),
        F.struct(F.col("_us").alias("us"), F.lit(_ROW).alias("kind"), F.col("_v").alias("v")),
        F.struct(F.col("_us").alias("us"), F.lit(_END).alias("kind"), none.alias("v")),
    ))
    order = [k, "us", "kind", "id"]
    events = (
        rows.filter(F.col("_us").isNotNull()).select(k, F.col("_id").alias("id"), marks.alias("m"))
        .select(k, "m.us", "m.kind", "id", "m.v").join(centres, F.col(k).eqNullSafe(F.col("_kc"))).drop("_kc")
        .repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id())
    )
    sums = stage(_partial_sums(events, k), "partial-sums")
    own = Window.partitionBy(k).orderBy("part")
    before = own.rowsBetween(Window.unboundedPreceding, -1)
    totals = sums.filter(F.col("kind") == _TOTAL).withColumn("high", F.col("high") + F.col("low")).select(
        k, "part", *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"before_{c}") for c in ("high", *_COUNTS)),
        *(F.col(c).alias(f"all_{c}") for c in ("high", *_COUNTS)),
    )
    # The sum of all partitions up to and with this one, as the next one has it: equal numbers cancel exactly.
    whole = [F.lead(f"before_{c}").over(own).alias(f"after_{c}") for c in ("high", *_COUNTS)]
    totals = stage(totals.select("*", *whole), "partition-sums")
    start = sums.filter(F.col("kind") == _START).select(F.col(k).alias("_k"), "id", F.col("part").alias("part_s"),
                                                        *(F.col(c).alias(f"s_{c}") for c in _SUMS))
    end = sums.filter(F.col("kind") == _END).select("id", F.col("part").alias("part_e"),
                                                    *(F.col(c).alias(f"e_{c}") for c in _SUMS))
    first = totals.select(F.col(k).alias("_k1"), F.col("part").alias("part_s"), *(f"all_{c}" for c in ("high", *_COUNTS)),
                          *(f"after_{c}" for c in ("high", *_COUNTS)))
    last = totals.select(F.col(k).alias("_k2"), F.col("part").alias("part_e"), *(f"before_{c}" for c in ("high", *_COUNTS)))
    both = (
        start.join(end, "id")
        .join(first, F.col("_k").eqNullSafe(F.col("_k1")) & (start["part_s"] == first["part_s"]))
        .join(last, F.col("_k").eqNullSafe(F.col("_k2")) & (end["part_e"] == last["part_e"]))
    )
    same = start["part_s"] == end["part_e"]

    def framed(c: str, low: bool = False):
        inner = F.col(f"e_{c}") - F.col(f"s_{c}")
        tail = F.col(f"all_{c}") - F.col(f"s_{c}")
        if low:
            inner, tail = inner + (F.col("e_low") - F.col("s_low")), tail - F.col("s_low")
        across = tail + (F.col(f"before_{c}") - F.col(f"after_{c}")) + F.col(f"e_{c}")
        return F.when(same, inner).otherwise(across)

    found = both.select(F.col("_k"), F.col("id").alias("_id"), framed("high", True).alias("_sum"),
                        *(framed(c).alias(f"_{c}") for c in _COUNTS))
    found = found.join(centres, F.col("_k").eqNullSafe(F.col("_kc")))
    nan, inf = F.lit(float("nan")), float("inf")
    mean = (
        F.when((F.col("_nan") > 0) | ((F.col("_up") > 0) & (F.col("_down") > 0)), nan)
        .when(F.col("_up") > 0, F.lit(inf)).when(F.col("_down") > 0, F.lit(-inf))
        .when(F.col("_n") > 0, F.col("_centre") + F.col("_sum") / F.col("_n"))
    )
    return rows.join(found.select("_id", mean.alias("rolling_mean")), "_id", "left").drop("_id", "_us", "_from", "_v")


def rolling_mean(
    df: DataFrame, text: str = "INTERVAL 24 HOURS", k: str = DEVICE, t: str = TIME, v: str = VALUE,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Mean of the readings in the period that ends at each row, both ends included; null readings are left out.

    Rows of one time have one frame. A row without a time has none, and a null mean.
    """
    at = F.col(t).cast("timestamp")
    rows = df.withColumns({
        "_us": F.unix_micros(at), "_from": F.unix_micros(at - interval(text)), "_v": F.col(v).cast("double"),
    })
    cold, hot = split_hot(rows, k, hot_rows)
    done = _cold(cold, k, t)
    return done if hot is None else done.unionByName(_hot(hot, k).select(*done.columns))
