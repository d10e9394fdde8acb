"""Domain polygons from well-known text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def parse_wkt(df: DataFrame, keys: tuple[str, ...] = ("domain",), wkt: str = "wkt") -> DataFrame:
    """(keys, ring, vertices ARRAY<STRUCT<x, y>>) per ring."""
    ring = F.posexplode(F.regexp_extract_all(F.col(wkt), F.lit(r"\(([^()]+)\)"), F.lit(1))).alias("ring", "text")
    pair = F.transform(
        F.split("text", ","),
        lambda p: F.struct(
            F.element_at(F.split(F.trim(p), r"\s+"), 1).try_cast("double").alias("x"),
            F.element_at(F.split(F.trim(p), r"\s+"), 2).try_cast("double").alias("y"),
        ),
    )
    return df.select(*keys, ring).select(*keys, "ring", pair.alias("vertices"))


def main_ring(rings: DataFrame, keys: tuple[str, ...] = ("domain",)) -> DataFrame:
    """The ring with the most vertices of each domain, with its extent."""
    best = rings.groupBy(*keys).agg(F.max_by(F.struct("ring", "vertices"), F.struct(F.size("vertices"), -F.col("ring"))).alias("r"))
    v = F.col("r.vertices")

    def side(axis: str, pick):
        return pick(F.transform(v, lambda p: p[axis]))

    return best.select(
        *keys,
        F.col("r.ring").alias("ring"),
        v.alias("vertices"),
        side("y", F.array_min).alias("lat_min"),
        side("y", F.array_max).alias("lat_max"),
        side("x", F.array_min).alias("lon_min"),
        side("x", F.array_max).alias("lon_max"),
    )
