"""Control files: small ragged text tables, read whole and cut into lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def file_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, line_no, value) of files small enough for one row each."""
    whole = spark.read.text(path, wholetext=True)
    return whole.select(
        F.col("_metadata.file_name").alias("file"), F.posexplode(F.split("value", r"\r?\n")).alias("line_no", "value")
    )


def parse_station_control(lines: DataFrame) -> DataFrame:
    """Two lines per station: identity, then position, shift, depth and datum.

    First line: ``ID SOURCEID "name"``.  Second line tokens: lat, lon, shift,
    depth, datum and, for current meters, height from bottom and mounting.  A
    word in the shift slot (RANGE, UNKNOWN) becomes ``shift_status``.
    """
    quote = '"'
    head = lines.filter("line_no % 2 = 0").select(
        "file",
        (F.col("line_no") / 2).cast("int").alias("n"),
        F.split(F.trim(F.split("value", quote)[0]), " ").alias("ids"),
        F.try_element_at(F.split("value", quote), F.lit(2)).alias("name"),
    )
    tail = lines.filter("line_no % 2 = 1").select(
        "file",
        ((F.col("line_no") - 1) / 2).cast("int").alias("n"),
        F.filter(F.split(F.trim("value"), r"\s+"), lambda s: s != "").alias("t"),
    )

    def token(i: int):
        return F.try_element_at("t", F.lit(i))

    shift = token(3)
    return (
        head.filter(F.col("name").isNotNull() & (F.size("ids") >= 2))
        .join(tail, ["file", "n"])
        .select(
            "file",
            F.element_at("ids", 1).alias("station_id"),
            F.element_at("ids", 2).alias("source_id"),
            F.element_at(F.split(F.element_at("ids", 2), "_"), -1).alias("source"),
            "name",
            token(1).try_cast("double").alias("lat"),
            token(2).try_cast("double").alias("lon"),
            shift.try_cast("double").alias("datum_shift"),
            F.when(shift.try_cast("double").isNull(), shift).otherwise("ok").alias("shift_status"),
            token(4).try_cast("double").alias("depth"),
            token(5).alias("datum"),
            token(6).try_cast("double").alias("height_from_bottom"),
            token(7).alias("mounting"),
        )
    )


def read_station_control(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return parse_station_control(file_lines(spark, path))


def parse_model_control(lines: DataFrame, *, text: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """``node layer lat lon ... station_id shift`` per line."""
    t = F.filter(F.split(F.trim(F.col(text)), r"\s+"), lambda s: s != "")
    return lines.filter(F.size(t) >= 4).select(
        *keep,
        F.element_at(t, 1).try_cast("int").alias("node_id"),
        F.element_at(t, 2).try_cast("int").alias("layer"),
        F.element_at(t, 3).try_cast("double").alias("node_lat"),
        F.element_at(t, 4).try_cast("double").alias("node_lon"),
        F.element_at(t, -2).alias("station_id"),
        F.element_at(t, -1).try_cast("double").alias("shift"),
    )


def parse_locations(lines: DataFrame, *, text: str = "value") -> DataFrame:
    """User list ``name lat lon depth``; lines of any other shape are skipped."""
    t = F.filter(F.split(F.trim(F.col(text)), r"\s+"), lambda s: s != "")
    return lines.filter(F.size(t) == 4).select(
        F.element_at(t, 1).alias("name"),
        F.element_at(t, 2).try_cast("double").alias("lat"),
        F.element_at(t, 3).try_cast("double").alias("lon"),
        F.element_at(t, 4).try_cast("double").alias("depth"),
    )
