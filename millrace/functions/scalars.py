"""Column expressions: numbers, time, formatting, status."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.schemas import CLAMP_LIMIT, LATE_AFTER, LOST_AFTER


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# numbers


def nan_to_null(c) -> Column:
    return F.when(~F.isnan(col(c)), col(c))


def clamp(c, low: float = -CLAMP_LIMIT, high: float = CLAMP_LIMIT) -> Column:
    """Bound a reading; null stays null and NaN becomes null."""
    number = col(c).isNotNull() & ~F.isnan(col(c))  # greatest and least skip nulls
    return F.when(number, F.least(F.greatest(col(c), F.lit(low)), F.lit(high)))


def finite(c) -> Column:
    """The number, or null for text that is no number, NaN and the infinities."""
    number = col(c).try_cast("double")
    return F.when(F.abs(number) < float("inf"), number)


def bucket(v, low, high, bins: int) -> Column:
    """Equal-width bin 1..bins; a value below ``low`` gives 0, one at ``high`` bins + 1; a flat range gives 1.

    The share of the range is taken first and then scaled, as in PostgreSQL; the built-in
    ``width_bucket`` multiplies first, which rounds some values on a bin edge to the other side.
    """
    v, low, high = col(v), col(low), col(high)
    share = (v - low) / (high - low)
    inner = F.least(F.floor(share * bins), F.lit(bins - 1)) + 1
    index = F.when(v < low, 0).when(v >= high, bins + 1).otherwise(inner)
    return F.when(low == high, 1).when(v.isNotNull(), index).cast("int")


def bin_edges(low, high, index, bins: int) -> tuple[Column, Column]:
    low, high, index = col(low), col(high), col(index)
    width = (high - low) / bins
    flat = low == high
    return (
        F.when(flat, low).otherwise(low + (index - 1) * width),
        F.when(flat, high).otherwise(low + index * width),
    )


def bin_mid(start, end) -> Column:
    return (col(start) + F.coalesce(col(end), col(start))) / 2


def parse_decimal(c) -> Column:
    """Number from text that may use a decimal comma (only the first comma counts)."""
    return finite(F.regexp_replace(F.trim(col(c).cast("string")), "^([^,]*),", "$1."))


def fixed(c, digits: int) -> Column:
    """Text with a fixed number of decimals."""
    return F.format_string(f"%.{digits}f", col(c))


# time


def from_ms(c) -> Column:
    return F.timestamp_millis(col(c))


def to_ms(c) -> Column:
    return F.unix_millis(col(c).cast("timestamp"))


def day(c) -> Column:
    return F.to_date(col(c))


def hour(c) -> Column:
    return F.date_trunc("hour", col(c))


def interval(text: str) -> Column:
    return F.expr(text)


def minus_days(c, days: int) -> Column:
    return col(c) - interval(f"INTERVAL {days} DAYS")


def parse_ts(c, *formats: str) -> Column:
    """Timestamp, or null where the text does not parse."""
    tries = [F.try_to_timestamp(col(c), F.lit(f)) for f in formats] or [F.try_to_timestamp(col(c))]
    return F.coalesce(*tries)


def fmt_iso(c, zone: str = "Z") -> Column:
    """ISO-8601; the fraction is written only where there is one."""
    t = col(c)
    seconds = F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(t, "SSSSSS")
    return F.concat(seconds, F.when(micros == "000000", "").otherwise(F.concat(F.lit("."), micros)), F.lit(zone))


def fmt_short(c) -> Column:
    return F.date_format(col(c), "dd-MM-yy HH:mm:ss")


def fmt_full(c) -> Column:
    return F.date_format(col(c), "dd/MM/yyyy HH:mm:ss")


def range_label(first, last, range_key: str) -> Column:
    return F.concat(fmt_short(first), F.lit(" -> "), fmt_short(last), F.lit(f" ({range_key})"))


# status


def freshness(last, as_of) -> Column:
    """Age class of the latest reading: gray if there is none, red after 6 h, orange after 2 h."""
    age = col(as_of) - col(last)
    return (
        F.when(col(last).isNull(), "status-gray")
        .when(age > interval(LOST_AFTER), "status-red")
        .when(age > interval(LATE_AFTER), "status-orange")
        .otherwise("status-green")
    )


def status_label(active) -> Column:
    return F.when(col(active), "Attivo").otherwise("Non attivo")


def location_label(c) -> Column:
    return F.when(F.length(col(c)) > 0, col(c)).otherwise("Non specificata")


def coordinate_label(c) -> Column:
    """Six decimals; a missing or zero coordinate is not shown."""
    return F.when(col(c) != 0, fixed(c, 6)).otherwise("N/A")
