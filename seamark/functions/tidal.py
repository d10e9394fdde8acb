"""Constituent names, speeds and small classification rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The 37 standard constituents with their angular speed in degrees
# per hour (Schureman 1958, Table 2), in priority order.
CONSTITUENT_SPEEDS = {
    "M2": 28.9841042,
    "S2": 30.0000000,
    "N2": 28.4397295,
    "K2": 30.0821373,
    "2N2": 27.8953548,
    "MU2": 27.9682084,
    "NU2": 28.5125831,
    "L2": 29.5284789,
    "T2": 29.9589333,
    "R2": 30.0410667,
    "LDA2": 29.4556253,
    "K1": 15.0410686,
    "O1": 13.9430356,
    "P1": 14.9589314,
    "Q1": 13.3986609,
    "J1": 15.5854433,
    "M1": 14.4966939,
    "OO1": 16.1391017,
    "2Q1": 12.8542862,
    "RHO1": 13.4715145,
    "MF": 1.0980331,
    "MM": 0.5443747,
    "SSA": 0.0821373,
    "SA": 0.0410686,
    "MSM": 0.4715211,
    "MSF": 1.0158958,
    "M4": 57.9682084,
    "M6": 86.9523127,
    "M8": 115.9364169,
    "MS4": 58.9841042,
    "MN4": 57.4238337,
    "MK3": 44.0251729,
    "S4": 60.0000000,
    "S6": 90.0000000,
    "2MK3": 42.9271398,
    "2SM2": 31.0158958,
    "MO3": 42.9271398,
}
# Spellings that differ from the standard name.
CONSTITUENT_ALIASES = {"LAM2": "LDA2", "RHO": "RHO1"}
# The eight major constituents used for summaries.
MAJOR_CONSTITUENTS = ("M2", "S2", "N2", "K2", "K1", "O1", "P1", "Q1")


def standard_name(name: Column) -> Column:
    clean = F.upper(F.trim(name))
    out = clean
    for alias, target in CONSTITUENT_ALIASES.items():
        out = F.when(clean == alias, F.lit(target)).otherwise(out)
    return out


def constituents(names: Sequence[str] | None = None) -> list[tuple[str, int, float]]:
    """(name, priority, speed), at most 37 entries."""
    return [
        (n, i, s)
        for i, (n, s) in enumerate(CONSTITUENT_SPEEDS.items(), start=1)
        if names is None or n in names
    ]


def constituent_table(spark: SparkSession, names: Sequence[str] | None = None) -> DataFrame:
    return spark.createDataFrame(constituents(names), "constituent string, priority int, speed double")


def each_constituent(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Every row once per constituent, with its priority and speed."""
    literal = F.array(
        *[
            F.struct(F.lit(n).alias("constituent"), F.lit(i).alias("priority"), F.lit(s).alias("speed"))
            for n, i, s in constituents(names)
        ]
    )
    return df.select("*", F.inline(literal))


def speed_of_name(name: Column) -> Column:
    """Angular speed of a standard constituent name, NULL when unknown."""
    table = F.create_map(*[F.lit(x) for item in CONSTITUENT_SPEEDS.items() for x in item])
    return F.try_element_at(table, name)


def record_class(days: Column) -> Column:
    return (
        F.when(days < 20, F.lit("short")).when(days < 180, F.lit("standard")).otherwise(F.lit("long"))
    )


def exceedance_codes(
    amp_diff: Column,
    phase_diff: Column,
    vector_diff: Column,
    amp_limit: float = 0.05,
    phase_limit: float = 10.0,
    vector_limit: float = 0.05,
) -> Column:
    """'AMP', 'PHASE' and 'VD' for each exceeded limit, comma separated."""
    return F.concat_ws(
        ",",
        F.when(F.abs(amp_diff) > amp_limit, F.lit("AMP")),
        F.when(F.abs(phase_diff) > phase_limit, F.lit("PHASE")),
        F.when(vector_diff > vector_limit, F.lit("VD")),
    )
