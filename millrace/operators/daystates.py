"""Partial states per device and day, from which statistics, histogram and curve are put together.

A day's state is made from the rows of that day alone, so an increment makes again the states of the days it touched and
leaves all others. Sums, counts and bin counts of days add up; what does not fall on a day's border (the start of a
trailing period) is read from the rows of that one day.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.scalars import bin_edges, bucket, interval
from millrace.operators.curve import rank_days, registered_only
from millrace.operators.filters import not_outlier
from millrace.operators.histogram import bin_grid, fill_bins
from millrace.schemas import DEVICE, OUTLIER, STATS_WINDOWS, TIME, VALUE

DAY = "event_date"


def day_states(clean: DataFrame, k: str = DEVICE, t: str = TIME, v: str = VALUE, flag: str = OUTLIER) -> DataFrame:
    """One row per (device, day): all rows; those with a value, their sum and range; those that count for statistics."""
    value = F.col(v)
    good = F.when(value.isNotNull() & ~F.coalesce(F.col(flag), F.lit(False)), True)
    return clean.groupBy(k, DAY).agg(
        F.count(F.lit(1)).alias("n"),
        F.count(value).alias("n_value"),
        F.sum(value).alias("total"),
        F.min(value).alias("low"),
        F.max(value).alias("high"),
        F.count(good).alias("n_good"),
        F.sum(F.when(good, value)).alias("total_good"),
        F.min(F.when(good, F.col(t))).alias("first_good"),
        F.max(F.when(good, F.col(t))).alias("last_good"),
    )


def period_starts(states: DataFrame, k: str = DEVICE) -> DataFrame:
    """(device, size, first and last time, sum over all time, start of each trailing period)."""
    whole = states.groupBy(k).agg(
        F.sum("n_good").alias("total_measurements"), F.min("first_good").alias("first_measurement"),
        F.max("last_good").alias("last_measurement"), F.sum("total_good").alias("_all"),
    ).filter(F.col("total_measurements") > 0)
    return whole.withColumns({
        f"_from_{name}": F.col("last_measurement") - interval(text) for name, text in STATS_WINDOWS.items()
    })


def border_days(starts: DataFrame, k: str = DEVICE) -> DataFrame:
    """(device, day): the days on which trailing periods start."""
    days = F.explode(F.array_distinct(F.array(*(F.to_date(f"_from_{name}") for name in STATS_WINDOWS))))
    return starts.select(k, days.alias(DAY))


def stats_from_states(
    states: DataFrame, starts: DataFrame, border: DataFrame, as_of: Column, k: str = DEVICE, t: str = TIME, v: str = VALUE,
) -> DataFrame:
    """``device_stats`` from day states; ``border`` has the rows of the ``border_days``."""
    after = states.select(k, DAY, "n_good", "total_good").join(starts, k)
    rows = not_outlier(border.filter(F.col(v).isNotNull())).select(k, DAY, t, v).join(starts, k)

    def sums(df: DataFrame, inside, count: Column, total: Column) -> DataFrame:
        cells = [c for name in STATS_WINDOWS for c in (
            F.sum(F.when(inside(name), count)).alias(f"_n_{name}"), F.sum(F.when(inside(name), total)).alias(f"_t_{name}"))]
        return df.groupBy(k).agg(*cells)

    whole_days = sums(after, lambda n: F.col(DAY) > F.to_date(f"_from_{n}"), F.col("n_good"), F.col("total_good"))
    in_part = sums(rows, lambda n: (F.col(DAY) == F.to_date(f"_from_{n}")) & (F.col(t) >= F.col(f"_from_{n}")),
                   F.lit(1).cast("long"), F.col(v))
    both = whole_days.unionByName(in_part).groupBy(k).agg(
        *(F.sum(c).alias(c) for c in whole_days.columns if c != k))
    return starts.join(both, k).select(
        k, "total_measurements", "first_measurement", "last_measurement",
        *((F.col(f"_t_{name}") / F.col(f"_n_{name}")).alias(name) for name in STATS_WINDOWS),
        (F.col("_all") / F.col("total_measurements")).alias("avg_all_time"), as_of.alias("updated_at"),
    )


def curve_from_states(states: DataFrame, devices: DataFrame, k: str = DEVICE) -> DataFrame:
    """``duration_curve`` from day states."""
    daily = states.filter("n_value > 0").select(
        k, F.col(DAY).alias("giorno"), (F.col("total") / F.col("n_value")).alias("flow_avg_day"))
    return rank_days(registered_only(daily, devices, k), k).withColumn(
        "p_exceed", F.col("m").cast("double") / (F.col("n") + 1).cast("double") * 100.0)


def ranges_from_states(states: DataFrame, k: str = DEVICE) -> DataFrame:
    return states.filter("n_value > 0").groupBy(k).agg(F.min("low").alias("min_v"), F.max("high").alias("max_v"))


def day_bins(clean: DataFrame, ranges: DataFrame, bins: int, k: str = DEVICE, v: str = VALUE) -> DataFrame:
    """(device, day, bins): how many rows of the day fall into each bin of the device's range; empty bins left out."""
    counts = (
        clean.filter(F.col(v).isNotNull()).select(k, DAY, v).join(ranges, k)
        .withColumn("bin_index", bucket(v, "min_v", "max_v", bins)).groupBy(k, DAY, "bin_index").agg(F.count("*").alias("n"))
    )
    return counts.groupBy(k, DAY).agg(F.map_from_entries(F.collect_list(
        F.when(F.col("bin_index").between(1, bins), F.struct("bin_index", "n")))).alias("bins"))


def histogram_from_days(
    days: DataFrame, ranges: DataFrame, bins: int, start: Column, end: Column, as_of: Column, k: str = DEVICE
) -> DataFrame:
    """``flow_histogram`` over all time from ``day_bins``."""
    counts = days.select(k, F.explode("bins").alias("bin_index", "n")).groupBy(k, "bin_index").agg(F.sum("n").alias("count"))
    low, high = bin_edges("min_v", "max_v", "bin_index", bins)
    return fill_bins(bin_grid(ranges, bins), counts, k).select(
        k, start.alias("window_start"), end.alias("window_end"), "bin_index", low.alias("range_start"),
        high.alias("range_end"), "count", as_of.alias("updated_at"),
    )
