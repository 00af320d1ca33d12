"""Greedy minimum-gap throttle: keep an event if it is far enough after the last kept one.

A device that fits one task is walked directly. A hot device is cut into blocks; what a block does
to the time of the last kept event is a step function of that time, so the blocks are summarised
in parallel, the summaries are composed in a tree, and each block then starts from its exact state.
"""

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.layout import BLOCK, HOT_ROWS, POSITION, in_blocks, per_key_rows, split_hot
from millrace.schemas import DEVICE, THROTTLE_SECONDS, TIME
from millrace.session import stage

_NONE_KEPT = -(1 << 62)
_FAN = 256
_MICROS = "_us"


def kept_mask(us: np.ndarray, gap: int, last: int = _NONE_KEPT) -> np.ndarray:
    """Which of the sorted times (micros) are kept, given the last time kept before them."""
    keep = np.zeros(len(us), dtype=bool)
    # a follower of itself (gap 0) still moves on
    follower = np.maximum(np.searchsorted(us, us + gap), np.arange(1, len(us) + 1)).tolist()
    i = int(np.searchsorted(us, last + gap))
    while i < len(us):
        keep[i] = True
        i = follower[i]
    return keep


def _merge_steps(upto: np.ndarray, leave: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    last_of_run = np.append(leave[1:] != leave[:-1], True)
    return upto[last_of_run], leave[last_of_run]


def block_steps(us: np.ndarray, gap: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Step function of a block: last kept + gap <= upto[i] (first such i) leaves with leave[i].

    Beyond the last step the block keeps nothing. ``reach`` is the greatest last kept + gap that can
    occur, so no step after it is needed. Chains are followed by pointer doubling.
    """
    n = len(us)
    jump = np.maximum(np.searchsorted(us, us + gap), np.arange(1, n + 1))
    leave = np.arange(n)
    step = np.where(jump < n, jump, leave)
    while True:
        further = step[step]
        if np.array_equal(further, step):
            break
        step = further
    reach = int(us[0]) + gap
    entries = min(int(np.searchsorted(us, reach)) + 1, n)
    return *_merge_steps(us[:entries], us[step[:entries]]), reach


def apply_steps(last: np.ndarray, gap: int, upto: np.ndarray, leave: np.ndarray) -> np.ndarray:
    at = np.searchsorted(upto, last + gap)
    return np.where(at < len(upto), leave[np.minimum(at, len(leave) - 1)], last)


def compose(first: tuple, second: tuple, gap: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Step function of two adjacent blocks."""
    upto, leave, reach = first
    through = apply_steps(leave, gap, *second[:2])
    skipped = second[0] > upto[-1]
    upto, leave = np.append(upto, second[0][skipped]), np.append(through, second[1][skipped])
    entries = min(int(np.searchsorted(upto, reach)) + 1, len(upto))
    return *_merge_steps(upto[:entries], leave[:entries]), reach


def _steps_schema(k: str, kind: str) -> str:
    return f"`{k}` {kind}, {BLOCK} bigint, upto array<bigint>, leave array<bigint>, reach bigint"


def _steps_row(k: str, device: pa.ChunkedArray, block: int, steps: tuple) -> pa.Table:
    upto, leave, reach = steps
    return pa.table({k: device, BLOCK: [block], "upto": [upto.tolist()], "leave": [leave.tolist()], "reach": [reach]})


def _walk_steps(table: pa.Table, k: str, gap: int, last: int) -> pa.Table:
    """(device, block, entry) of the blocks of one device, given the state before the first."""
    table = table.sort_by(BLOCK)
    entries = []
    for upto, leave in zip(table.column("upto"), table.column("leave")):
        entries.append(last)
        last = int(apply_steps(np.array([last]), gap, upto.values.to_numpy(), leave.values.to_numpy())[0])
    return pa.table({k: table.column(k), BLOCK: table.column(BLOCK), "entry": pa.array(entries, pa.int64())})


def _entry_states(steps: DataFrame, k: str, gap: int, blocks: int) -> DataFrame:
    """(device, block, entry): the last kept time before each block."""
    kind = steps.schema[k].dataType.simpleString()
    entry_schema = f"`{k}` {kind}, {BLOCK} bigint, entry bigint"
    if blocks <= _FAN:
        return steps.groupBy(k).applyInArrow(lambda table: _walk_steps(table, k, gap, _NONE_KEPT), entry_schema)

    def fold(table: pa.Table) -> pa.Table:
        table = table.sort_by(BLOCK)
        whole = None
        for upto, leave, reach in zip(table.column("upto"), table.column("leave"), table.column("reach")):
            step = (upto.values.to_numpy(), leave.values.to_numpy(), reach.as_py())
            whole = step if whole is None else compose(whole, step, gap)
        return _steps_row(k, table.column(k).slice(0, 1), table.column("_group")[0].as_py(), whole)

    def enter(children: pa.Table, parent: pa.Table) -> pa.Table:
        return _walk_steps(children, k, gap, parent.column("entry")[0].as_py())

    grouped = steps.withColumn("_group", F.floor(F.col(BLOCK) / _FAN).cast("long"))
    parents = stage(grouped.groupBy(k, "_group").applyInArrow(fold, _steps_schema(k, kind)), "throttle-steps")
    entered = _entry_states(parents, k, gap, -(-blocks // _FAN)).withColumnRenamed(BLOCK, "_group")
    pairs = grouped.groupBy(k, "_group").cogroup(entered.groupBy(k, "_group"))
    return pairs.applyInArrow(enter, entry_schema)


def throttle(
    df: DataFrame, k: str = DEVICE, t: str = TIME, min_seconds: float = THROTTLE_SECONDS, tie: Sequence[str] = (),
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Rows kept by the throttle, in event time: at least ``min_seconds`` after the last kept row."""
    gap = round(min_seconds * 1_000_000)
    columns = df.columns
    timed = df.filter(F.col(t).isNotNull()).withColumn(_MICROS, F.unix_micros(F.col(t).cast("timestamp")))
    cold, hot = split_hot(timed, k, hot_rows)

    def walk(table: pa.Table, start: int, end: int) -> np.ndarray:
        us = table.column(_MICROS).slice(start, end - start).to_numpy()
        return start + np.flatnonzero(kept_mask(us, gap))

    done = per_key_rows(cold, k, [_MICROS, *tie], walk, columns)
    if hot is None:
        return done

    placed = in_blocks(hot, k, [_MICROS, *tie], hot_rows)
    blocks = placed.agg(F.max(BLOCK)).head()[0] + 1
    kind = df.schema[k].dataType.simpleString()

    def summarise(table: pa.Table) -> pa.Table:
        steps = block_steps(np.sort(table.column(_MICROS).to_numpy()), gap)
        return _steps_row(k, table.column(k).slice(0, 1), table.column(BLOCK)[0].as_py(), steps)

    steps = stage(
        placed.select(k, BLOCK, _MICROS).groupBy(k, BLOCK).applyInArrow(summarise, _steps_schema(k, kind)),
        "throttle-steps",
    )
    entries = stage(_entry_states(steps, k, gap, blocks), "throttle-entries")

    def walk_block(table: pa.Table) -> pa.Table:
        table = table.sort_by(POSITION)
        mask = kept_mask(table.column(_MICROS).to_numpy(), gap, table.column("entry")[0].as_py())
        return table.select(columns).filter(pa.array(mask))

    walked = placed.join(entries, [k, BLOCK]).groupBy(k, BLOCK).applyInArrow(walk_block, df.schema)
    return done.unionByName(walked)
