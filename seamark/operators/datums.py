"""Vertical datums: node shifts, station shifts, composition rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seamark.functions.rounding import half_even
from seamark.operators import spatial

# Shifts beyond this size are fill values or failure codes.
FILL_LIMIT = 999.0


def nearest_valid_shift(
    stations: DataFrame, field: DataFrame, *, node_id: str, shift: str, box_deg: float = 0.1
) -> DataFrame:
    """Nearest node whose shift is not a fill value of either sign."""
    good = field.filter(F.abs(shift) < FILL_LIMIT)
    return spatial.nearest(stations, good, node_id=node_id, node_columns=[shift], box_deg=box_deg)


# Height of low-water datum above the lake datum, per lake.
LAKE_BASE = {"erie": 173.5, "michigan_huron": 176.0, "superior": 183.2, "ontario": 74.2}


def apply_shift(value: Column, offset: Column, sign: Column | int = -1) -> Column:
    """Level moved by sign * offset; fill values and failure codes leave it alone."""
    s = sign if isinstance(sign, Column) else F.lit(sign)
    return F.when(F.abs(offset) < FILL_LIMIT, value + s * offset).otherwise(value)


def shift_levels(
    df: DataFrame, offsets: DataFrame, rules: DataFrame, *, system: str = "system", node: str = "node_id", value: str = "value"
) -> DataFrame:
    """Model levels at each node moved by its offset, with the system's sign.

    ``rules`` holds (system, sign); a system without a rule subtracts.
    """
    j = df.join(offsets.select(node, "offset"), node, "left").join(rules.select(system, "sign"), system, "left")
    moved = apply_shift(F.col(value), F.coalesce("offset", F.lit(-FILL_LIMIT)), F.coalesce("sign", F.lit(-1)))
    return j.withColumn(value, moved).select(*df.columns)


def compose_offsets(fields: DataFrame, terms: DataFrame, *, node: str = "node_id") -> DataFrame:
    """Offset per (system, target, node) as constant + sum(coef * field).

    ``fields`` is long (system, node, field, value); ``terms`` holds (system,
    target, constant, field, coef), one row per term.  A missing or fill-valued
    field makes the offset the failure code -9991.
    """
    good = fields.select("system", node, "field", F.when(F.abs("value") < FILL_LIMIT, F.col("value")).alias("value"))
    need = terms.groupBy("system", "target").agg(F.count("field").alias("n"), F.max("constant").alias("c"))
    out = (
        good.join(terms, ["system", "field"])
        .groupBy("system", "target", node)
        .agg(F.count("value").alias("ok"), F.sum(F.col("coef") * F.col("value")).alias("s"))
        .join(need, ["system", "target"])
    )
    total = F.coalesce("c", F.lit(0.0)) + F.col("s")
    return out.select(
        "system", "target", node, F.when(F.col("n") == F.col("ok"), total).otherwise(F.lit(-9991.0)).alias("offset")
    )


def observation_shift(
    stations: DataFrame, offsets: DataFrame, *, target: str, lake: Column | None = None, key: str = "station_id", datum: str = "datum"
) -> DataFrame:
    """(datum_shift, shift_status) of observations for the target datum.

    Same datum: 0.  Between the lake datum and its low-water datum: the lake
    constant with the matching sign.  Otherwise the offset table (key, datum,
    offset; infinite offset = RANGE), or UNKNOWN.
    """
    have, want = F.upper(F.col(datum)), target.upper()
    base = F.lit(None).cast("double")
    if lake is not None:
        for name, height in LAKE_BASE.items():
            base = F.when(lake == name, F.lit(height)).otherwise(base)
    same = (have == want) | (F.lit("IGLD" in want) & have.contains("IGLD")) | (F.lit("LWD" in want) & have.contains("LWD"))
    j = stations.join(offsets.select(key, datum, F.col("offset").alias("__off")), [key, datum], "left")
    finite = F.abs("__off") < float("inf")
    shift = (
        F.when(same, 0.0)
        .when(F.lit("LWD" in want) & have.contains("IGLD"), -base)
        .when(F.lit("IGLD" in want) & have.contains("LWD"), base)
        .when(finite, half_even(F.col("__off"), 2))
    )
    status = (
        F.when(shift.isNotNull(), "ok").when(F.col("__off").isNotNull() & ~finite, "RANGE").otherwise("UNKNOWN")
    )
    return j.select(*stations.columns, shift.alias("datum_shift"), status.alias("shift_status"))


def rereference_tides(tides: DataFrame, offsets: DataFrame, keys: Sequence[str], tide: str = "tide") -> DataFrame:
    """Tides plus the (rounded) offset of their station; none without a finite one."""
    j = tides.join(offsets.filter(F.abs("offset") < float("inf")), list(keys))
    return j.withColumn(tide, F.col(tide) + half_even(F.col("offset"), 2)).select(*tides.columns)


def first_datum_with_data(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], *, datum: str = "datum", value: str = "value"
) -> DataFrame:
    """Rows of the first datum, in the given order, that has any value per station."""
    rank = F.array_position(F.array(*[F.lit(d) for d in order]), F.col(datum))
    rows = df.withColumn("__rank", rank).filter("__rank > 0")
    best = rows.filter(F.col(value).isNotNull()).groupBy(*keys).agg(F.min("__rank").alias("__rank"))
    return rows.join(best, [*keys, "__rank"], "left_semi").select(*df.columns)
