"""Keep-first de-duplication and series merge."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.scalars import parse_ts
from millrace.schemas import DEVICE, TIME


def _pick(df: DataFrame, keys: Sequence[str], chosen) -> DataFrame:
    picked = df.groupBy(*keys).agg(chosen(F.struct(*[F.col(c) for c in df.columns if c not in keys])).alias("_row"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def dedupe_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of each key along ``order``, which should be total.

    A partial aggregate, not a window: copies collapse before the shuffle, so a key that holds a
    large share of the rows does not land in one task.
    """
    first = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order])
    return _pick(df, keys, lambda row: F.min_by(row, first))


def dedupe_last(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    last = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order])
    return _pick(df, keys, lambda row: F.max_by(row, last))


def concat_series(*frames: DataFrame) -> DataFrame:
    """Bag union by column name; a column that a frame lacks is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def merge_series(
    df: DataFrame, order: Sequence[str], k: str = DEVICE, t: str = TIME
) -> tuple[DataFrame, DataFrame]:
    """(all rows with a readable time, one row per (device, time)): both ready to be sorted on output.

    ``order`` names the columns that give the input order, used to decide which copy is first.
    """
    if dict(df.dtypes)[t] == "string":
        df = df.withColumn(t, parse_ts(t))
    full = df.filter(F.col(t).isNotNull())
    return full, dedupe_first(full, [k, t], order)


def order_series(df: DataFrame, k: str = DEVICE, t: str = TIME) -> DataFrame:
    return df.orderBy(k, t)
