"""Calendar features and time arithmetic. The session time zone must be UTC."""

from pyspark.sql import Column, DataFrame, functions as F

from sensorlab.schema import TIME


def micros(time) -> Column:
    """Microseconds since the epoch of a TIMESTAMP_NTZ column."""
    return F.unix_micros(_col(time).cast("timestamp"))


def from_micros(us) -> Column:
    return F.timestamp_micros(_col(us)).cast("timestamp_ntz")


def span_micros(text: str) -> int:
    """'15 minutes' -> microseconds."""
    units = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}
    number, unit = text.split()
    return int(float(number) * units[unit.rstrip("s")] * 1_000_000)


def floor_div(us: Column, width: int) -> Column:
    """Floor division that also holds before 1970."""
    return ((us - F.pmod(us, F.lit(width))) / F.lit(width)).cast("bigint")


def floor_time(time, every: str) -> Column:
    us, width = micros(time), span_micros(every)
    return from_micros(us - F.pmod(us, F.lit(width)))


def calendar_features(df: DataFrame, time: str = TIME,
                      only: tuple = ("month", "day", "hour", "minute", "day_of_week", "day_of_year", "is_weekend"),
                      ) -> DataFrame:
    """Month, day, hour, minute, Monday-based day of week, day of year, weekend flag."""
    t = F.col(time)
    features = {
        "month": F.month(t),
        "day": F.dayofmonth(t),
        "hour": F.hour(t),
        "minute": F.minute(t),
        "day_of_week": F.weekday(t),
        "day_of_year": F.dayofyear(t),
        "is_weekend": is_weekend(t),
    }
    return df.withColumns({name: features[name] for name in only})


def is_weekend(time) -> Column:
    return (F.weekday(_col(time)) >= 5).cast("int")


def period_labels(df: DataFrame, time: str = TIME) -> DataFrame:
    """Year-month, month name, year and the 'Jan 2024' label."""
    return df.withColumns({
        "year_month": F.date_format(time, "yyyy-MM"),
        "month_name": F.date_format(time, "MMMM"),
        "year": F.year(time),
        "month_year": F.date_format(time, "MMM yyyy"),
    })


def period(time, unit: str = "month") -> Column:
    """Group number used by the per-period outlier operators."""
    parts = {"month": F.month, "week": F.weekofyear, "day": F.dayofyear}
    return parts[unit](_col(time))


def period_year(time, unit: str = "month") -> Column:
    """The year that a period's number counts in; weeks go by the year that holds most of them."""
    return F.extract(F.lit("YEAROFWEEK"), _col(time)) if unit == "week" else F.year(_col(time))


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c
