"""Model meshes: extraction, masks, layers, vectors, boundary edges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seamark.functions import angles
from seamark.functions.clock import epoch

# Physical bounds per variable; anything else +-999.
PHYSICAL_BOUNDS = {
    "temp": (-5.0, 50.0),
    "salt": (-1.0, 50.0),
    "currents": (0.0, 10.0),
    "u": (-10.0, 10.0),
    "v": (-10.0, 10.0),
}
DEFAULT_BOUNDS = (-999.0, 999.0)


def _outside(value: Column, variable: Column) -> Column:
    lo, hi = F.lit(DEFAULT_BOUNDS[0]), F.lit(DEFAULT_BOUNDS[1])
    for name, (a, b) in PHYSICAL_BOUNDS.items():
        lo = F.when(variable == name, F.lit(a)).otherwise(lo)
        hi = F.when(variable == name, F.lit(b)).otherwise(hi)
    return (value < lo) | (value > hi)


def mask_unphysical(df: DataFrame, value: str = "value", variable: str = "var") -> DataFrame:
    """Fill values and values outside the physical bounds become missing."""
    clean = F.nanvl(F.col(value), F.lit(None).cast("double"))
    return df.withColumn(value, F.when(~_outside(clean, F.col(variable)), clean))


def mask_report(df: DataFrame, keys: Sequence[str], value: str = "value", variable: str = "var") -> DataFrame:
    """How many pure fill values and how many blends with them were masked."""
    v = F.nanvl(F.col(value), F.lit(None).cast("double"))
    pure = F.abs(v) >= 999
    return df.groupBy(*keys, variable).agg(
        F.count_if(pure).alias("n_fill"),
        F.count_if(_outside(v, F.col(variable)) & ~pure).alias("n_blended"),
    )


def extract_series(
    values: DataFrame, stations: DataFrame, *, variables: Sequence[str], on: Sequence[str] = ("node_id", "layer")
) -> DataFrame:
    """Values at each station's node and layer, variables as columns.

    One scan serves all variables.  The station table filters the scan; Spark
    broadcasts it when it is below its size limit and shuffles otherwise.
    """
    near = values.filter(F.col("var").isin(*variables)).join(stations.select("station_id", *on), list(on))
    return near.groupBy("station_id", "ts").agg(
        *[F.max(F.when(F.col("var") == v, F.col("value"))).alias(v) for v in variables]
    )


def current_series(values: DataFrame, stations: DataFrame) -> DataFrame:
    uv = extract_series(values, stations, variables=["u", "v"])
    return uv.select(
        "station_id",
        "ts",
        "u",
        "v",
        angles.speed_of(F.col("u"), F.col("v")).alias("speed"),
        angles.direction_of(F.col("u"), F.col("v")).alias("dir_deg"),
    )


def files_in_window(files: DataFrame, file: str, ts: str, start: Column, end: Column) -> DataFrame:
    """Rows of files whose time span overlaps the window."""
    span = files.groupBy(file).agg(F.min(ts).alias("lo"), F.max(ts).alias("hi"))
    keep = span.filter((F.col("lo") <= end) & (F.col("hi") >= start))
    return files.join(keep.select(file), file, "left_semi").select(*files.columns)


def sigma_layers(nodes: DataFrame, levels: int, *, depth: str = "h") -> DataFrame:
    """Evenly spaced sigma levels: layer mid-points times depth, z negative-down."""
    i = F.explode(F.sequence(F.lit(0), F.lit(levels - 2))).alias("layer")
    mid = -(F.col("layer") + 0.5) / (levels - 1)
    return nodes.select("node_id", depth, i).select("node_id", "layer", (mid * F.col(depth)).alias("z"))


def element_depths(elements: DataFrame, nodes: DataFrame, *, depth: str = "h") -> DataFrame:
    """Depth of each element as the mean of its three nodes."""
    corners = elements.select("element_id", F.explode(F.array("n1", "n2", "n3")).alias("node_id"))
    return corners.join(nodes.select("node_id", depth), "node_id").groupBy("element_id").agg(F.avg(depth).alias(depth))


def side_looking_depth(stations: DataFrame, nodes: DataFrame, *, depth: str = "h") -> DataFrame:
    """Depth of side-looking sensors from the model's water depth at their node.

    Applies to side mountings (or, without a mounting, to a positive height)
    that have a height and no depth of their own; never negative.
    """
    j = stations.join(nodes.select("node_id", F.col(depth).alias("__h")), "node_id", "left")
    side = F.when(F.col("mounting").isNotNull(), F.col("mounting") == "side").otherwise(F.col("height_from_bottom") > 0)
    use = side & (F.coalesce("depth", F.lit(0.0)) <= 0.01) & (F.col("height_from_bottom") > 0) & (F.col("__h") > 0)
    new = F.greatest(F.col("__h") - F.col("height_from_bottom"), F.lit(0.0))
    return j.withColumn("depth", F.when(use, new).otherwise(F.col("depth"))).select(*stations.columns)


def centre_and_rotate(df: DataFrame, keys: Sequence[str] = ("ts",), *, angle: str = "angle") -> DataFrame:
    """East and north currents at cell centres of a staggered grid.

    ``df`` holds (keys, eta, xi, u, v, angle) with u on the west and v on the
    south face; the centre is the mean of both faces, of one where the other is
    missing, and 0 where both are.  Faces are met by equi-joins on the index.
    """
    on = [*keys, "eta", "xi"]
    east_u = df.select(*keys, "eta", (F.col("xi") - 1).alias("xi"), F.col("u").alias("u2"))
    north_v = df.select(*keys, (F.col("eta") - 1).alias("eta"), "xi", F.col("v").alias("v2"))
    j = df.join(east_u, on, "left").join(north_v, on, "left")

    def centre(a: str, b: str) -> Column:
        both = (F.col(a) + F.col(b)) / 2
        return F.coalesce(both, F.col(a), F.col(b), F.lit(0.0))

    uc, vc = centre("u", "u2"), centre("v", "v2")
    return j.select(
        *on,
        angles.rotate_east(uc, vc, F.col(angle)).alias("u_east"),
        angles.rotate_north(uc, vc, F.col(angle)).alias("v_north"),
    )


def boundary_edges(elements: DataFrame, corners: Sequence[str] = ("n1", "n2", "n3")) -> DataFrame:
    """Undirected edges that belong to exactly one element."""
    c = list(corners)
    edges = F.explode(
        F.array(
            *[
                F.struct(
                    F.least(F.col(a), F.col(b)).alias("a"), F.greatest(F.col(a), F.col(b)).alias("b")
                )
                for a, b in zip(c, c[1:] + c[:1])
            ]
        )
    )
    return elements.select(edges.alias("e")).groupBy("e.a", "e.b").agg(F.count(F.lit(1)).alias("n")).filter("n = 1").select("a", "b")


def completeness(series: DataFrame, key: str = "station_id", ts: str = "ts") -> DataFrame:
    """Rows per station against the number of distinct times of the run."""
    steps = series.select(ts).distinct().agg(F.count(F.lit(1))).scalar()
    have = series.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    return have.withColumn("n_expected", steps).withColumn("complete", F.col("n_rows") == F.col("n_expected"))
