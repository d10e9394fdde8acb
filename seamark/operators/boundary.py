"""Open-boundary transects: distance, vertical and along-track interpolation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seamark.functions.geo import great_circle_km
from seamark.operators.quantiles import exact_percentiles
from seamark.operators.sequence import scan


def gap_threshold(df: DataFrame, keys: Sequence[str], spacing: str) -> DataFrame:
    """median + 3 * interquartile range of node spacings, exact."""
    q = exact_percentiles(df, keys, spacing, [0.25, 0.5, 0.75])
    return q.select(*keys, (F.col("q50") + 3 * (F.col("q75") - F.col("q25"))).alias("threshold"))


def along_distance(
    nodes: DataFrame, keys: Sequence[str], *, order: str = "i", lat: str = "lat", lon: str = "lon", chunk: int = 10_000
) -> DataFrame:
    """Spacing to the previous node and cumulative distance (km) along a boundary."""
    cut = F.floor(F.col(order) / chunk)
    prev = scan(nodes, keys, [order], prior={"__p": F.struct(F.col(lat).alias("y"), F.col(lon).alias("x"))}, chunk=cut)
    gap = F.coalesce(
        great_circle_km(F.col("__p")["y"], F.col("__p")["x"], F.col(lat), F.col(lon)), F.lit(0.0)
    )
    stepped = prev.select(*nodes.columns, gap.alias("spacing_km"))
    return scan(stepped, keys, [order], totals={"along_km": F.col("spacing_km")}, chunk=cut)


def to_fixed_depths(
    df: DataFrame,
    keys: Sequence[str],
    *,
    depth_step: float,
    sigma: str = "sigma",
    value: str = "value",
    h: str = "h",
    zeta: str = "zeta",
) -> DataFrame:
    """Linear interpolation from sigma layers to depths 0, step, 2*step, ...

    Each pair of neighbouring layers of a water column yields the fixed depths
    between them, so nothing is joined.  Depths above the surface, below the
    bed or outside the layers are absent.  A column has few layers.
    """
    z = -(F.col(sigma) * (F.col(h) + F.coalesce(F.col(zeta), F.lit(0.0))) + F.coalesce(F.col(zeta), F.lit(0.0)))
    w = Window.partitionBy(*keys).orderBy("__z")
    pairs = df.select(
        *keys, F.col(value).alias("__v"), F.col(h).alias("__h"), F.coalesce(F.col(zeta), F.lit(0.0)).alias("__e"), z.alias("__z")
    ).select("*", F.lead("__z").over(w).alias("__z2"), F.lead("__v").over(w).alias("__v2"))
    last = F.lead("__z", 2).over(w)
    pairs = pairs.withColumn("__open", last.isNotNull()).filter("__z2 IS NOT NULL")
    lo = F.greatest(F.ceil(F.col("__z") / depth_step), F.lit(0)).cast("bigint")
    hi = F.floor(F.col("__z2") / depth_step).cast("bigint")
    spread = pairs.withColumn("k", F.explode(F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<bigint>"))))
    depth = F.col("k") * depth_step
    frac = F.try_divide(depth - F.col("__z"), F.col("__z2") - F.col("__z"))
    out = spread.select(
        *keys,
        "k",
        depth.alias("depth"),
        (F.col("__v") + (F.col("__v2") - F.col("__v")) * F.coalesce(frac, F.lit(0.0))).alias(value),
        ((depth >= -F.col("__e")) & (depth <= F.col("__h"))).alias("__wet"),
        ((depth < F.col("__z2")) | ~F.col("__open")).alias("__mine"),
    )
    return out.filter("__wet AND __mine").select(*keys, "k", "depth", value)


def to_regular_distance(
    df: DataFrame,
    keys: Sequence[str],
    *,
    step_km: float,
    along: str = "along_km",
    value: str = "value",
    max_gap_km: Column | None = None,
) -> DataFrame:
    """Linear interpolation along the boundary to 0, step, 2*step, ... km.

    A pair of nodes with a missing value gives missing points; a pair further
    apart than the gap limit gives none.
    """
    w = Window.partitionBy(*keys).orderBy("__x")
    pairs = df.select(
        *keys, F.col(along).alias("__x"), F.col(value).alias("__v"), *([max_gap_km.alias("__gap")] if max_gap_km is not None else [])
    ).select("*", F.lead("__x").over(w).alias("__x2"), F.lead("__v").over(w).alias("__v2"), F.lead("__x", 2).over(w).isNull().alias("__last"))
    pairs = pairs.filter("__x2 IS NOT NULL")
    if max_gap_km is not None:
        pairs = pairs.filter(F.col("__x2") - F.col("__x") <= F.col("__gap"))
    lo, hi = F.ceil(F.col("__x") / step_km).cast("bigint"), F.floor(F.col("__x2") / step_km).cast("bigint")
    spread = pairs.withColumn("k", F.explode(F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<bigint>"))))
    x = F.col("k") * step_km
    frac = F.try_divide(x - F.col("__x"), F.col("__x2") - F.col("__x"))
    return spread.filter((x < F.col("__x2")) | F.col("__last")).select(
        *keys, "k", x.alias("x_km"), (F.col("__v") + (F.col("__v2") - F.col("__v")) * F.coalesce(frac, F.lit(0.0))).alias(value)
    )


def transect(
    values: DataFrame, nodes: DataFrame, boundary: Sequence[str], *, depth_step: float, step_km: float = 0.25
) -> DataFrame:
    """Boundary section (ts, depth, distance): distances, fixed depths, regular x.

    ``values`` holds (boundary keys, i, ts, sigma, zeta, value); ``nodes`` holds
    (boundary keys, i, lat, lon, h).  Stretches wider than the gap threshold
    stay empty.
    """
    line = along_distance(nodes, boundary)
    limit = gap_threshold(line.filter("spacing_km > 0"), boundary, "spacing_km")
    fixed = to_fixed_depths(
        values.join(nodes.select(*boundary, "i", "h"), [*boundary, "i"]), [*boundary, "ts", "i"], depth_step=depth_step
    )
    placed = fixed.join(line.select(*boundary, "i", "along_km"), [*boundary, "i"]).join(limit, list(boundary))
    out = to_regular_distance(
        placed.withColumnRenamed("k", "depth_no"), [*boundary, "ts", "depth_no", "depth"], step_km=step_km, max_gap_km=F.col("threshold")
    )
    return out
