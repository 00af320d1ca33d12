"""Constraint checks: each returns the violations."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.schemas import DEVICE


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)


def check_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows where one of the columns is null, with the names of those columns."""
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns]))
    anywhere = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])
    return df.filter(anywhere).withColumn("null_columns", missing)


def check_fk(df: DataFrame, dim: DataFrame, k: str = DEVICE) -> DataFrame:
    """Key values without a row in ``dim``, with their row count; counted before the join."""
    used = df.filter(F.col(k).isNotNull()).groupBy(k).agg(F.count(F.lit(1)).alias("orphans"))
    return used.join(dim.select(k), k, "left_anti")
