"""Whitespace-separated series text: headerless, one file per series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Column positions of the text format.
SCALAR = {"value": 6}
VECTOR = {"speed": 6, "dir_deg": 7, "u": 8, "v": 9}
PAIRED_SCALAR = {"obs": 6, "model": 7, "bias": 8}
PAIRED_VECTOR = {
    "obs_speed": 6,
    "model_speed": 7,
    "speed_bias": 8,
    "obs_dir": 9,
    "model_dir": 10,
    "dir_bias": 11,
}
LIMIT = 999.0


def sentinel_mask(value: Column) -> Column:
    """Values beyond +-999 and NaN are missing."""
    clean = F.nanvl(value, F.lit(None).cast("double"))
    return F.when(F.abs(clean) <= LIMIT, clean)


def parse_series(
    lines: DataFrame, columns: dict[str, int] = SCALAR, *, text: str = "value", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Lines ``julian year month day hour minute values...`` to (keep, ts, values).

    Blank and malformed lines have no valid time and are dropped.
    """
    t = F.col("__t")

    def part(i: int, kind: str) -> Column:
        return F.try_element_at(t, F.lit(i + 1)).try_cast(kind)

    ts = F.try_make_timestamp(
        *[part(i, "double").cast("int") for i in range(1, 6)], F.lit(0)
    )
    values = [sentinel_mask(part(i, "double")).alias(n) for n, i in columns.items()]
    # The line is split once; a generator drops bad rows, because a filter would
    # be pushed below the split and repeat it.
    row = F.filter(F.array(F.struct(ts.alias("ts"), *values)), lambda r: r["ts"].isNotNull())
    return lines.select(*keep, F.split(F.trim(F.col(text)), r"\s+").alias("__t")).select(*keep, F.inline(row))


def read_series(
    spark: SparkSession,
    path: str | list[str],
    columns: dict[str, int] = SCALAR,
    *,
    name_pattern: str = r"^([^_]+)_([^_]+)_([^_.]+)_?([^.]*)\.",
    keys: tuple[str, ...] = ("station_id", "system", "variable", "cast"),
) -> DataFrame:
    """Series files with key columns taken from the file name by a pattern."""
    raw = spark.read.text(path).withColumn("__file", F.col("_metadata.file_name"))
    named = raw.select(
        "value",
        *[F.nullif(F.regexp_extract("__file", name_pattern, i), F.lit("")).alias(k) for i, k in enumerate(keys, 1)],
    )
    return parse_series(named, columns, keep=keys)


def for_cycle(lines: DataFrame, cycle: Column, columns: dict[str, int] = SCALAR, *, keep: tuple[str, ...] = ()) -> DataFrame:
    """Formatted model lines of one forecast cycle."""
    rows = parse_series(lines, columns, keep=keep)
    return rows.withColumn("cycle", cycle)
