"""Station providers: buoys, river gauges and quality-flagged archives."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seamark.operators.sequence import keep_first

FOOT = 0.3048

# Gauge parameter codes by unit and datum.
FEET_CODES = ("00065", "62620", "72279", "63160", "62615", "62614", "72214", "63158")
LAKE_DATUM_CODES = ("72214", "72215")
OLD_DATUM_CODES = ("62616", "62614", "63161", "62617", "63158")
FAHRENHEIT_CODES = ("00011",)
FEET_PER_SECOND_CODES = ("72255", "00055", "72168", "72254", "72322", "81904")
KNOT_CODES = ("70232",)
MILES_PER_HOUR_CODES = ("72294", "72321")
CONDUCTANCE_CODES = ("00095",)
PREFERRED_SALINITY_CODES = ("00480", "72401", "90860", "90862", "00096", "70305")


def _number(c: str, ok) -> Column:
    """'MM' and anything else that is no number, or fails ``ok``, is missing."""
    v = F.col(c).try_cast("double")
    return F.when(ok(v), v)


def buoy_rows(df: DataFrame, variable: str, *, keys: Sequence[str] = ("station_id",), ts: str = "ts") -> DataFrame:
    """(keys, ts, depth, value[, dir_deg], datum) of one variable from buoy columns.

    Range limits make values missing, rows with any missing part are dropped,
    level arrives in feet and speed in cm/s.  Water temperature is taken from
    the ocean sensor column where that exists, else from the surface one.
    """
    none = F.lit(None).cast("string")
    wide = lambda lo, hi: (lambda v: (v >= lo) & (v < hi))
    depth = _number("DEPTH", wide(0, 5000)) if "DEPTH" in df.columns else F.lit(None).cast("double")
    if variable == "wl":
        out = df.select(
            *keys, ts, F.lit(0.0).alias("depth"), (_number("TIDE", wide(-50, 98)) * FOOT).alias("value"), F.lit("MLLW").alias("datum")
        )
    elif variable == "cu":
        out = df.select(
            *keys,
            ts,
            _number("DEP01", lambda v: v.between(0, 5)).alias("depth"),
            (_number("SPD01", wide(0, 900)) / 100).alias("value"),
            _number("DIR01", lambda v: v.between(0, 360)).alias("dir_deg"),
            none.alias("datum"),
        ).filter("dir_deg IS NOT NULL")
    elif variable == "temp" and "OTMP" in df.columns:
        out = df.select(*keys, ts, depth.alias("depth"), _number("OTMP", wide(-50, 98)).alias("value"), none.alias("datum"))
    elif variable == "temp":
        out = df.select(*keys, ts, F.lit(0.0).alias("depth"), _number("WTMP", wide(-50, 98)).alias("value"), none.alias("datum"))
    elif variable == "salt":
        out = df.select(*keys, ts, depth.alias("depth"), _number("SAL", wide(0, 98)).alias("value"), none.alias("datum"))
    else:
        raise ValueError(f"unknown variable {variable}")
    return out.filter("value IS NOT NULL AND depth IS NOT NULL")


def unit_codes(spark: SparkSession) -> DataFrame:
    """(variable, code, scale, offset): value * scale + offset in SI units."""
    rows = [("wl", c, FOOT, 0.0) for c in FEET_CODES]
    rows += [("temp", c, 5 / 9, -32 * 5 / 9) for c in FAHRENHEIT_CODES]
    rows += [("salt", c, 0.00064, 0.0) for c in CONDUCTANCE_CODES]
    rows += [("cu", c, FOOT, 0.0) for c in FEET_PER_SECOND_CODES]
    rows += [("cu", c, 0.5144, 0.0) for c in KNOT_CODES]
    rows += [("cu", c, 0.44704, 0.0) for c in MILES_PER_HOUR_CODES]
    return spark.createDataFrame(rows, "variable string, code string, scale double, shift double")


def gauge_units(df: DataFrame) -> DataFrame:
    """SI values and level datum from the parameter code; small code table."""
    codes = unit_codes(df.sparkSession)
    si = F.col("value") * F.coalesce("scale", F.lit(1.0)) + F.coalesce("shift", F.lit(0.0))
    datum = F.when(F.col("code").isin(*LAKE_DATUM_CODES), "IGLD").when(
        F.col("code").isin(*OLD_DATUM_CODES), "NGVD"
    ).otherwise("NAVD88")
    return df.join(codes, ["variable", "code"], "left").select(
        *[c for c in df.columns if c != "value"],
        si.alias("value"),
        F.when(F.col("variable") == "wl", datum).alias("datum"),
    )


def first_code_series(
    df: DataFrame, keys: Sequence[str] = ("station_id", "variable"), *, ts: str = "ts", seq: str = "seq"
) -> DataFrame:
    """Of each station, the first code with data (preferred codes first), its
    first series id, and the first row per time.

    The winner per station is found by an aggregate over the ingest sequence and
    joined back, so no station is ordered as a whole.
    """
    preferred = F.when(
        (F.col("variable") == "salt") & F.col("code").isin(*PREFERRED_SALINITY_CODES), 0
    ).otherwise(1)
    win = df.groupBy(*keys).agg(
        F.min_by(F.struct("code", "series_id"), F.struct(preferred, F.col(seq))).alias("w")
    )
    chosen = df.join(win, list(keys)).filter(
        (F.col("code") == F.col("w.code")) & F.col("series_id").eqNullSafe(F.col("w.series_id"))
    ).drop("w")
    return keep_first(chosen, [*keys, ts], [seq])


# Accepted quality flags and the sensor pairs in priority order.
ACCEPTED_QC = ("1", "2")
SENSOR_PAIRS = (("wcs1", "wcd1"), ("wcs2", "wcd2"))


def quality_rows(
    df: DataFrame, keys: Sequence[str], *, qc: str = "qcFlagCode", ts: str = "ts", seq: str = "seq", accepted: Sequence[str] = ACCEPTED_QC
) -> DataFrame:
    """Rows with an accepted flag, first one per time."""
    return keep_first(df.filter(F.col(qc).isin(*accepted)), [*keys, ts], [seq])


def first_sensor_pair(
    df: DataFrame,
    keys: Sequence[str] = ("station_id",),
    *,
    code: str = "code",
    ts: str = "ts",
    pairs: Sequence[tuple[str, str]] = SENSOR_PAIRS,
) -> DataFrame:
    """Speed and direction of the first sensor pair for which both exist."""
    table = df.sparkSession.createDataFrame(
        [(i, s, d) for i, (s, d) in enumerate(pairs)], "priority int, s string, d string"
    )
    speed = df.join(table.select("priority", F.col("s").alias(code)), code)
    direction = df.join(table.select("priority", F.col("d").alias(code)), code)
    both = speed.select(*keys, "priority").distinct().join(direction.select(*keys, "priority").distinct(), [*keys, "priority"])
    best = both.groupBy(*keys).agg(F.min("priority").alias("priority"))
    on = [*keys, "priority"]
    s = speed.join(best, on).select(*keys, ts, F.col("value").alias("speed"))
    d = direction.join(best, on).select(*keys, ts, F.col("value").alias("dir_deg"))
    return s.join(d, [*keys, ts])
