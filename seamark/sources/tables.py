"""Skill tables, threshold configuration and overrides."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seamark.functions.text import split_bin_station_id
from seamark.operators.sequence import keep_first

# Keywords of file names, first match wins.
VARIABLE_WORDS = (
    ("water_level_hw", "Water Level high tide"),
    ("water_level_lw", "Water Level low tide"),
    ("water_level", "Water Level"),
    ("temperature", "Temperature"),
    ("currents_dir", "Current direction"),
    ("currents", "Current speed"),
    ("salinity", "Salinity"),
)
CAST_WORDS = (
    ("nowcast", "Nowcast"),
    ("forecast_a", "Forecast (A)"),
    ("forecast_b", "Forecast (B)"),
    ("forecast", "Forecast"),
    ("hindcast", "Hindcast"),
)


def _first_word(name: Column, words: Sequence[tuple[str, str]], other: str) -> Column:
    low = F.lower(name)
    return F.coalesce(*[F.when(low.contains(w), F.lit(label)) for w, label in words], F.lit(other))


def variable_of(name: Column) -> Column:
    return _first_word(name, VARIABLE_WORDS, "Other")


def cast_of(name: Column) -> Column:
    return _first_word(name, CAST_WORDS, "Unknown")


def tag_rows(df: DataFrame, file: str = "source_file") -> DataFrame:
    return df.withColumn("variable", variable_of(F.col(file))).withColumn("cast", cast_of(F.col(file)))


def read_skill_tables(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """All skill CSVs under the path, tagged from their names; of repeated
    (ID, variable, cast) rows the one in the last file stays."""
    df = spark.read.option("header", True).csv(path)
    df = tag_rows(df.select(F.col("_metadata.file_name").alias("source_file"), "*"))
    return keep_first(df, ["ID", "variable", "cast"], ["source_file"], last=True)


def read_thresholds(spark: SparkSession, path: str) -> DataFrame:
    from seamark.operators.scores import thresholds

    raw = spark.read.option("header", True).csv(path)
    return thresholds(
        spark,
        raw.select(
            F.col("name_var").alias("variable"),
            F.col("X1").try_cast("double").alias("x1"),
            F.col("X2").try_cast("double").alias("x2"),
        ),
    )


OVERRIDE_COLUMNS = ("station_id", "bin", "depth", "orientation", "name")


def clean_overrides(raw: DataFrame, seq: str | None = None) -> DataFrame:
    """Per-bin overrides from string columns.

    Rows without a station or an integer bin are skipped, a bad depth becomes
    missing, and a later row of the same bin replaces an earlier one.
    """

    def text(c: str) -> Column:
        if c not in raw.columns:
            return F.lit(None).cast("string")
        return F.nullif(F.trim(F.col(c)), F.lit(""))

    out = raw.select(
        text("station_id").alias("station_id"),
        text("bin").try_cast("int").alias("bin"),
        text("depth").try_cast("double").alias("depth"),
        text("orientation").alias("orientation"),
        text("name").alias("name"),
        (F.col(seq) if seq else F.monotonically_increasing_id()).alias("__seq"),
    ).filter("station_id IS NOT NULL AND bin IS NOT NULL")
    return keep_first(out, ["station_id", "bin"], ["__seq"], last=True).drop("__seq")


def read_overrides(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.option("header", True).option("comment", "#").csv(path)
    return clean_overrides(raw)


def split_virtual_ids(df: DataFrame, column: str = "station_id") -> DataFrame:
    both = split_bin_station_id(F.col(column))
    return df.withColumn("parent_id", both["station_id"]).withColumn("bin", both["bin"])
