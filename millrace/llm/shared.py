"""Helpers shared by the operators: staging, bounded bitmaps, connected components."""

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import stage

BITMAP_BITS = 1 << 24


def small_batches(spark) -> None:
    """Hand 1,000 rows at a time to Python where the session still has Spark's default of 10,000: rows are whole texts."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, "1000")


def documents(spark, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def table(spark, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def carried(docs: DataFrame, *named: str):
    """``docs`` as its ``named`` columns and one struct of all others, so that columns added to it clash with none, and
    the function that brings the columns back in their order."""
    others = [c for c in docs.columns if c not in named]
    packed = F.struct(*(F.col(f"`{c}`").alias(c) for c in others)) if others else F.lit(None).cast("int")
    rows = docs.select(*named, packed.alias("_carried"))

    def back(df: DataFrame) -> DataFrame:
        return df.select(*(F.col(c) if c in named else F.col("_carried")[c].alias(c) for c in docs.columns))

    return rows, back


def bitmap(df: DataFrame, key: str | Column, bits: int = BITMAP_BITS) -> np.ndarray:
    """A bitmap of ``bits`` places with the low bits of all values of a long column set.

    Its size is fixed whatever the data; it only spares shuffles. Callers join exactly afterwards, so a full bitmap
    costs time, never a row.
    """
    at = F.col(key) if isinstance(key, str) else key
    place = at.bitwiseAND(F.lit(bits - 1))
    found = (
        df.select(F.shiftright(place, 5).alias("cell"), place.bitwiseAND(F.lit(31)).cast("int").alias("bit"))
        .groupBy("cell").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("word")).toArrow()
    )
    cells = np.zeros(bits // 32, np.uint32)
    cells[found["cell"].to_numpy()] = found["word"].to_numpy().astype(np.uint32)
    return cells


def in_bitmap(cells: np.ndarray, key: np.ndarray) -> np.ndarray:
    place = key.astype(np.uint64) & np.uint64(len(cells) * 32 - 1)
    word = cells[(place >> np.uint64(5)).astype(np.int64)]
    return (word >> (place & np.uint64(31)).astype(np.uint32)) & np.uint32(1) == 1


def components(edges: DataFrame, u: str, v: str, label: str = "component") -> DataFrame:
    """(node, ``label``): the smallest node that each end of an edge can reach, by large-star and small-star rounds.

    Every round is a partial aggregate and a join on the node, written to the shared folder; a hub of very many edges
    is split by the join. Nodes without edges do not appear.
    """
    now = stage(
        edges.filter(F.col(u) != F.col(v))
        .select(F.greatest(u, v).alias("a"), F.least(u, v).alias("b")).distinct(), "edges",
    )
    mark = None
    while True:
        both = now.select("a", "b").union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = stage(
            both.join(low, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
            .distinct(), "large",
        )
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(low, "a").filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(low.select("a", F.col("m").alias("b"))).distinct()
        )
        now = stage(small, "small")
        row = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == tuple(row):
            break
        mark = tuple(row)
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias(label))
    roots = now.select(F.col("b").alias("node"), F.col("b").alias(label)).distinct()
    return nodes.union(roots)
