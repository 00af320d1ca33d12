"""Equal-width value histogram per device."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.scalars import bin_edges, bucket
from millrace.operators.filters import histogram_window
from millrace.operators.stats import value_range
from millrace.schemas import DEVICE, HISTOGRAM_BINS, TIME, VALUE
from millrace.session import stage


def with_range(df: DataFrame, ranges: DataFrame, k: str = DEVICE) -> DataFrame:
    return df.join(ranges, k)


def histogram_counts(
    df: DataFrame, ranges: DataFrame, bins: int = HISTOGRAM_BINS, k: str = DEVICE, v: str = VALUE,
    include_upper: bool = False,
) -> DataFrame:
    """Rows per (device, bin). Rows at the device maximum fall outside unless ``include_upper``."""
    index = bucket(v, "min_v", "max_v", bins)
    if include_upper:
        index = F.least(index, F.lit(bins))
    return (
        with_range(df, ranges, k)
        .withColumn("bin_index", index)
        .filter(F.col("bin_index").between(1, bins))
        .groupBy(k, "bin_index")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def bin_grid(ranges: DataFrame, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Every bin of every device."""
    return ranges.withColumn("bin_index", F.explode(F.sequence(F.lit(1), F.lit(bins))))


def fill_bins(grid: DataFrame, counts: DataFrame, k: str = DEVICE) -> DataFrame:
    return grid.join(counts, [k, "bin_index"], "left").withColumn("count", F.coalesce(F.col("count"), F.lit(0)))


def flow_histogram(
    clean: DataFrame,
    bins: int = HISTOGRAM_BINS,
    hours: int = 0,
    as_of: Column | None = None,
    k: str = DEVICE,
    t: str = TIME,
    v: str = VALUE,
    include_upper: bool = False,
) -> DataFrame:
    """Complete histogram (empty bins included) over all time or the ``hours`` before ``as_of``."""
    as_of = F.current_timestamp() if as_of is None else as_of
    kind = clean.schema[t].dataType.simpleString()
    start, end = histogram_window(as_of, hours, kind)
    data = clean.filter(F.col(v).isNotNull())
    if end is not None:
        data = data.filter((F.col(t) >= start) & (F.col(t) < end))
    data = data.select(k, v)
    ranges = stage(value_range(data, k, v), "ranges")
    counts = histogram_counts(data, ranges, bins, k, v, include_upper)
    low, high = bin_edges("min_v", "max_v", "bin_index", bins)
    return fill_bins(bin_grid(ranges, bins), counts, k).select(
        k,
        start.alias("window_start"),
        (F.lit(None).cast(kind) if end is None else end).alias("window_end"),
        "bin_index",
        low.alias("range_start"),
        high.alias("range_end"),
        "count",
        as_of.alias("updated_at"),
    )


def with_percent(hist: DataFrame, k: str = DEVICE, by: tuple[str, ...] = ()) -> DataFrame:
    """Share of each bin in its device's total; 0 where the total is 0. A group has ``bins`` rows."""
    total = F.sum("count").over(Window.partitionBy(k, *by))
    return hist.withColumn("percent", F.when(total > 0, F.col("count") / total * 100).otherwise(F.lit(0.0)))
