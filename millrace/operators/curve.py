"""Flow-duration curve."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.scalars import finite
from millrace.operators.stats import daily_mean
from millrace.schemas import CURVE_LEVEL, DEVICE, TIME, VALUE


def registered_only(df: DataFrame, devices: DataFrame, k: str = DEVICE) -> DataFrame:
    return df.join(devices.select(k), k, "left_semi")


def rank_days(daily: DataFrame, k: str = DEVICE) -> DataFrame:
    """Rank by falling mean; equal means rank by day. A group is one device's days, bounded by the calendar."""
    per_device = Window.partitionBy(k)
    return daily.withColumn(
        "m", F.row_number().over(per_device.orderBy(F.col("flow_avg_day").desc(), F.col("giorno"))).cast("long")
    ).withColumn("n", F.count(F.lit(1)).over(per_device))


def duration_curve(
    clean: DataFrame, devices: DataFrame, k: str = DEVICE, t: str = TIME, v: str = VALUE
) -> DataFrame:
    """Exceedance percentage m / (n + 1) * 100 of each daily mean.

    The registry restricts the daily means, not the raw rows: the long side is pre-aggregated first.
    """
    daily = registered_only(daily_mean(clean, k, t, v), devices, k)
    return rank_days(daily, k).withColumn(
        "p_exceed", F.col("m").cast("double") / (F.col("n") + 1).cast("double") * 100.0
    )


def interpolate_at(
    curve: DataFrame, x: float = CURVE_LEVEL, k: str = DEVICE, xc: str = "p_exceed", yc: str = "flow_avg_day"
) -> DataFrame:
    """Curve value at ``x``: an exact hit, else the line between its neighbours, null outside.

    One aggregation, no sort: the nearest point on either side of ``x``.
    """
    point = F.struct(F.col(xc).alias("x"), F.col(yc).alias("y"))
    sides = (
        curve.filter(finite(xc).isNotNull() & finite(yc).isNotNull())
        .groupBy(k)
        .agg(
            F.max(F.when(F.col(xc) <= x, point)).alias("lo"),
            F.min(F.when(F.col(xc) >= x, point)).alias("hi"),
        )
    )
    lo, hi = F.col("lo"), F.col("hi")
    line = lo.y + (hi.y - lo.y) * ((F.lit(float(x)) - lo.x) / (hi.x - lo.x))
    return sides.select(k, F.when(hi.x == x, hi.y).when(lo.isNotNull() & hi.isNotNull(), line).alias("y_at_x"))


def all_curves(devices: DataFrame, curve: DataFrame, k: str = DEVICE) -> DataFrame:
    """Curve points of every registered device; a device without data keeps one row of nulls."""
    return devices.select(k).join(curve.select(k, "flow_avg_day", "p_exceed"), k, "left")
