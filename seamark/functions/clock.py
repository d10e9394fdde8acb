"""Times: parsing, epochs, calendar parts, forecast lead."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two request-time formats and the epochs of the day counts.
REQUEST_FORMATS = ("yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyyMMdd-HH:mm:ss")
JULIAN_DAY_OF_1970 = 2440587.5
MODIFIED_JULIAN_DAY_OF_1970 = 40587


def epoch(ts: Column) -> Column:
    """Whole seconds since 1970 of a TIMESTAMP or zone-less timestamp (UTC session)."""
    return F.unix_seconds(ts.cast("timestamp"))


def parse_request_time(text: Column) -> Column:
    first, second = REQUEST_FORMATS
    return F.coalesce(
        F.try_to_timestamp(text, F.lit(first)), F.try_to_timestamp(text, F.lit(second))
    )


def julian_day(ts: Column) -> Column:
    """Julian day rounded to 1e-4."""
    return F.round(F.unix_micros(ts) / 86400e6 + JULIAN_DAY_OF_1970, 4)


def nearest_minute(ts: Column) -> Column:
    return F.date_trunc("minute", ts + F.expr("INTERVAL 30 SECONDS"))


def from_modified_julian(days: Column) -> Column:
    return F.timestamp_millis(
        F.round((days - MODIFIED_JULIAN_DAY_OF_1970) * 86400000).cast("bigint")
    )


def from_day_and_millis(day: Column, millis: Column) -> Column:
    return F.timestamp_millis(
        ((day - MODIFIED_JULIAN_DAY_OF_1970) * 86400000 + millis).cast("bigint")
    )


def kelvin_to_celsius(k: Column) -> Column:
    return k - 273.15


def lead_hours(ts: Column, cycle: Column) -> Column:
    """Whole hours from the cycle start to the valid time."""
    return F.floor((epoch(ts) - epoch(cycle)) / 3600)


def lead_bin(hours: Column, forecast_hours: Column | int, width: int = 6) -> Column:
    """Upper edge of the half-open lead bin; the last hour keeps the last label."""
    edge = (F.floor(hours / width) + 1) * width
    limit = forecast_hours if isinstance(forecast_hours, Column) else F.lit(forecast_hours)
    return F.when(edge > limit, limit).otherwise(edge)


def valid_time_of_file(name: Column) -> Column:
    """Valid time of a model file from the dot-separated parts of its name.

    The parts ``YYYYMMDD`` and ``tHHz`` give the cycle, in either order.  A
    nowcast hour ``nNNN`` counts back (cycle - (6 - n) h), a forecast hour
    ``fNNN`` counts forward, ``hindcast`` is the cycle itself.
    """
    day = F.regexp_extract(name, r"\.(\d{8})\.", 1)
    hour = F.regexp_extract(name, r"\.t(\d{2})z\.", 1)
    cycle = F.try_to_timestamp(F.concat(day, hour), F.lit("yyyyMMddHH"))
    step = F.regexp_extract(name, r"\.[nf](\d{3})\.", 1).try_cast("int")
    shift = (
        F.when(name.contains(".hindcast."), F.lit(0))
        .when(name.rlike(r"\.n\d{3}\."), step - 6)
        .otherwise(step)
    )
    return F.timestamp_seconds(F.unix_seconds(cycle) + shift * 3600)
