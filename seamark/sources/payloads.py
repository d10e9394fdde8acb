"""JSON payloads: observations, predictions, constants, grid frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seamark.functions.tidal import standard_name

OBS_SCHEMA = "data ARRAY<STRUCT<t STRING, v STRING, s STRING, d STRING, b STRING>>"
TIDE_SCHEMA = "predictions ARRAY<STRUCT<t STRING, v STRING>>"
CONSTANTS_SCHEMA = (
    "HarmonicConstituents ARRAY<STRUCT<name STRING, amplitude DOUBLE, phase_GMT DOUBLE, speed DOUBLE>>"
)
GRID_SCHEMA = "lats ARRAY<ARRAY<DOUBLE>>, lons ARRAY<ARRAY<DOUBLE>>, values ARRAY<ARRAY<DOUBLE>>"
PAYLOAD_TIME = "yyyy-MM-dd HH:mm"


def _time(c: Column) -> Column:
    return F.try_to_timestamp(c, F.lit(PAYLOAD_TIME))


def _rows(df: DataFrame, schema: str, field: str, payload: str, keep: tuple[str, ...]) -> DataFrame:
    return df.select(*keep, F.explode(F.from_json(F.col(payload), schema)[field]).alias("r"))


def observations(df: DataFrame, *, payload: str = "payload", keep: tuple[str, ...] = ("station_id",), bin_column: str | None = None) -> DataFrame:
    """(ts, value, speed m/s, dir_deg, bin) rows; speeds arrive in cm/s.

    With ``bin_column`` rows that name another bin are dropped.
    """
    rows = _rows(df, OBS_SCHEMA, "data", payload, keep).select(
        *keep,
        _time(F.col("r.t")).alias("ts"),
        F.col("r.v").try_cast("double").alias("value"),
        (F.col("r.s").try_cast("double") / 100).alias("speed"),
        F.col("r.d").try_cast("double").alias("dir_deg"),
        F.col("r.b").try_cast("int").alias("bin"),
    )
    if bin_column is not None:
        rows = rows.filter(F.col("bin").isNull() | (F.col("bin") == F.col(bin_column)))
    return rows


def tide_predictions(
    df: DataFrame, start: Column, end: Column, *, payload: str = "payload", keep: tuple[str, ...] = ("station_id",)
) -> DataFrame:
    """Prediction rows inside the window, identical rows once."""
    rows = _rows(df, TIDE_SCHEMA, "predictions", payload, keep).select(
        *keep, _time(F.col("r.t")).alias("ts"), F.col("r.v").try_cast("double").alias("tide")
    )
    return rows.filter(F.col("ts").between(start, end)).distinct()


def harmonic_constants(df: DataFrame, *, payload: str = "payload", keep: tuple[str, ...] = ("station_id",)) -> DataFrame:
    return (
        _rows(df, CONSTANTS_SCHEMA, "HarmonicConstituents", payload, keep)
        .select(
            *keep,
            standard_name(F.col("r.name")).alias("constituent"),
            F.col("r.amplitude").alias("amplitude"),
            F.col("r.phase_GMT").alias("phase"),
        )
        .distinct()
    )


def explode_grid(df: DataFrame, *, keep: tuple[str, ...] = ("source", "ts")) -> DataFrame:
    """Frames with 2-D arrays lats, lons, values to one row per cell."""
    row = F.posexplode(F.arrays_zip("lats", "lons", "values")).alias("iy", "r")
    cell = F.posexplode(F.arrays_zip(F.col("r.lats"), F.col("r.lons"), F.col("r.values"))).alias("ix", "c")
    return (
        df.select(*keep, row)
        .select(*keep, "iy", cell)
        .select(*keep, "iy", "ix", F.col("c.lats").alias("lat"), F.col("c.lons").alias("lon"), F.col("c.values").alias("value"))
    )


def read_grids(spark: SparkSession, path: str | list[str], time_pattern: str = r"(\d{8}-\d{2})") -> DataFrame:
    """Grid JSON files, one frame each; the time comes from the file name."""
    raw = spark.read.schema(GRID_SCHEMA).option("multiLine", True).json(path)
    name = F.col("_metadata.file_name")
    ts = F.try_to_timestamp(F.regexp_extract(name, time_pattern, 1), F.lit("yyyyMMdd-HH"))
    return explode_grid(raw.select(name.alias("source"), ts.alias("ts"), "lats", "lons", "values"))
