"""Gridded fields as rows (source, ts, iy, ix, lat, lon, value)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seamark.functions.rounding import half_even
from seamark.functions import angles
from seamark.operators import scores, spatial
from seamark.session import cut_lineage, spread

CELL = ("iy", "ix")
FRAME_THRESHOLD = 3.0
# Weights of a lattice (16 a cell) that may be sent whole to the values: about 30 MB.
FEW_WEIGHTS = 500_000


def common_times(left: DataFrame, right: DataFrame, keys: Sequence[str] = (), ts: str = "ts"):
    """Both frame lists restricted to the times they share."""
    on = [*keys, ts]
    return (
        left.join(right.select(*on).distinct(), on, "left_semi"),
        right.join(left.select(*on).distinct(), on, "left_semi"),
    )


def pair_frames(obs: DataFrame, model: DataFrame, *, ts: str = "ts", value: str = "value") -> DataFrame:
    """Cells of both sources at common times; a cell missing on one side keeps NULL."""
    o, m = common_times(obs, model, ts=ts)
    on = [ts, *CELL]
    return o.select(*on, F.col(value).alias("obs")).join(
        m.select(*on, F.col(value).alias("model")), on, "full_outer"
    )


def difference_frames(pairs: DataFrame, ts: str = "ts") -> DataFrame:
    return pairs.filter("obs IS NOT NULL AND model IS NOT NULL").select(
        ts, *CELL, (F.col("model") - F.col("obs")).alias("diff")
    )


def _block(e: Column, limit: float) -> list[Column]:
    x1 = F.lit(float(limit))
    return [
        scores.central_frequency(e, x1).alias("central_freq"),
        scores.positive_outliers(e, x1).alias("pos_outlier_freq"),
        scores.negative_outliers(e, x1).alias("neg_outlier_freq"),
    ]


def frame_statistics(
    pairs: DataFrame, keys: Sequence[str] = ("ts",), *, limit: float = FRAME_THRESHOLD, min_cells: int = 5
) -> DataFrame:
    """Statistics over the cells of each frame.

    Means and spreads of a side use all its cells; errors use common cells.
    Correlation and RMSE need more than ``min_cells`` cells on each side.
    """
    obs, model = F.col("obs"), F.col("model")
    e = model - obs
    enough = (F.count(obs) > min_cells) & (F.count(model) > min_cells)
    return pairs.groupBy(*keys).agg(
        F.avg(obs).alias("obs_mean"),
        F.stddev_pop(obs).alias("obs_std"),
        F.avg(model).alias("model_mean"),
        F.stddev_pop(model).alias("model_std"),
        F.avg(e).alias("bias"),
        F.stddev_pop(e).alias("bias_std"),
        F.when(enough, half_even(scores.pearson(model, obs), 3)).alias("r"),
        F.when(enough, scores.rmse(e)).alias("rmse"),
        *_block(e, limit),
    )


def pixel_statistics(
    pairs: DataFrame, keys: Sequence[str] = CELL, *, limit: float = FRAME_THRESHOLD, min_times: int = 2
) -> DataFrame:
    """Statistics over time of each cell; NULL below ``min_times`` valid errors."""
    e = F.col("model") - F.col("obs")
    enough = F.count(e) >= min_times
    stats = [
        scores.rmse(e).alias("rmse"),
        F.avg(e).alias("diff_mean"),
        F.max(e).alias("diff_max"),
        F.min(e).alias("diff_min"),
        F.stddev_pop(e).alias("diff_std"),
        *_block(e, limit),
    ]
    names = ["rmse", "diff_mean", "diff_max", "diff_min", "diff_std", "central_freq", "pos_outlier_freq", "neg_outlier_freq"]
    return pairs.groupBy(*keys).agg(*[F.when(enough, s).alias(n) for s, n in zip(stats, names)])


def surface_skill(obs: DataFrame, model: DataFrame, *, limit: float = FRAME_THRESHOLD, min_frames: int = 3):
    """(per-frame, per-pixel) statistics of two frame sets with > 2 common times."""
    pairs = pair_frames(obs, model)
    frames = frame_statistics(pairs, limit=limit)
    enough = pairs.agg(F.count_distinct("ts")).scalar() >= min_frames
    return frames.filter(enough), pixel_statistics(pairs, limit=limit).filter(enough)


def daily_mean(df: DataFrame, keys: Sequence[str] = CELL, *, ts: str = "ts", value: str = "value") -> DataFrame:
    return df.groupBy(*keys, F.to_date(ts).alias("day")).agg(F.avg(value).alias(value))


def radar_daily_vectors(
    df: DataFrame, keys: Sequence[str] = CELL, *, ts: str = "ts", u: str = "u", v: str = "v", min_hours: int = 13
) -> DataFrame:
    """Daily mean u, v where enough hours are valid; speed and direction of that mean."""
    ok = F.col(u).isNotNull() & F.col(v).isNotNull()
    hours = F.count_if(ok)
    mean = df.groupBy(*keys, F.to_date(ts).alias("day")).agg(
        F.when(hours >= min_hours, F.avg(F.when(ok, F.col(u)))).alias("u"),
        F.when(hours >= min_hours, F.avg(F.when(ok, F.col(v)))).alias("v"),
    )
    return mean.select(
        *keys,
        "day",
        "u",
        "v",
        angles.speed_of(F.col("u"), F.col("v")).alias("speed"),
        angles.direction_of(F.col("u"), F.col("v")).alias("direction"),
    )


def climatology(
    df: DataFrame, node: str, columns: Sequence[str], *, file: str = "file", layer: str | None = None, surface: int = 0
) -> DataFrame:
    """Mean over files of per-file means: every file counts the same.

    Infinite values become missing, and one missing value makes its file mean,
    and so the node mean, missing.
    """
    rows = df if layer is None else df.filter(F.col(layer) == surface)
    clean = {c: F.when(F.abs(c) < float("inf"), F.nanvl(F.col(c), F.lit(None))) for c in columns}
    rows = rows.withColumns(clean)

    def strict(c: str) -> Column:
        return F.when(F.count(c) == F.count(F.lit(1)), F.avg(c)).alias(c)

    per_file = rows.groupBy(file, node).agg(*[strict(c) for c in columns])
    return per_file.groupBy(node).agg(*[strict(c) for c in columns])


def hourly_frames(df: DataFrame, start: Column, end: Column, ts: str = "ts") -> DataFrame:
    """Every hourly step of the window with its exactly matching frame, if any."""
    spark = df.sparkSession
    steps = spark.range(1).select(
        F.explode(F.sequence(start, end, F.expr("INTERVAL 1 HOUR"))).alias(ts)
    )
    return steps.join(df, ts, "left")


def mask_where(value: Column, other: Column, limit: float) -> Column:
    """``value`` made missing where ``other`` lies below the limit."""
    return F.when(~F.coalesce(other < limit, F.lit(False)), value)


def concat_frames(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


#: Surface variables of a product set.
SURFACE = ("sst", "ssh", "sss", "ssu", "ssv")


def _vectors(wide: DataFrame) -> DataFrame:
    u, v = F.col("ssu"), F.col("ssv")
    return wide.withColumn("speed", angles.speed_of(u, v)).withColumn("direction", angles.direction_of(u, v))


def surface_products(
    values: DataFrame,
    nodes: DataFrame,
    targets: DataFrame,
    *,
    radius_km: float,
    variables: Sequence[str] = SURFACE,
    surface: int = 0,
    resolution_km: float = 0.0,
    domain_edges: DataFrame | None = None,
) -> DataFrame:
    """Surface fields of all variables and times on the target lattice, one row a cell and time.

    ``values`` (node_id, layer, ts, var, value) is blended with weights found once per
    target and node among the wet nodes; a node without value at a time has no part in it.
    Targets outside the domain are dropped.  With both current components, speed and
    direction are added.
    """
    wet = nodes.filter("wet = 1").select("node_id", "lat", "lon")
    if domain_edges is not None:
        targets = spatial.inside_domains(targets, domain_edges)
    weights = cut_lineage(
        spatial.neighbour_weights(targets, wet, node_id="node_id", radius_km=radius_km, resolution_km=resolution_km)
    )
    field = values.filter((F.col("layer") == surface) & F.col("var").isin(*variables) & F.col("value").isNotNull())
    # Few weights go to the many values, which then stay where they are; else both are merged.
    few = weights.count() <= FEW_WEIGHTS
    met = field.select("node_id", "ts", "var", "value").join(F.broadcast(weights) if few else spread(weights), "node_id")
    w = F.col("weight")

    def blend(name: str) -> Column:
        own = F.col("var") == name
        return (F.sum(F.when(own, w * F.col("value"))) / F.sum(F.when(own, w))).alias(name)

    wide = met.groupBy(*CELL, "ts").agg(*[blend(n) for n in variables])
    return _vectors(wide) if {"ssu", "ssv"} <= set(variables) else wide


def daily_products(hourly: DataFrame, variables: Sequence[str] = SURFACE) -> DataFrame:
    """Daily means per cell; speed and direction are those of the mean current."""
    daily = hourly.groupBy(*CELL, F.to_date("ts").alias("day")).agg(*[F.avg(n).alias(n) for n in variables])
    return _vectors(daily) if {"ssu", "ssv"} <= set(variables) else daily


def every_nth_time(df: DataFrame, stride: int, ts: str = "ts") -> DataFrame:
    """Rows of every ``stride``-th of the distinct time steps, the first included.

    Ranks distinct times only, by chunks, so the rows themselves are not ordered.
    """
    from seamark.operators.sequence import scan

    times = df.select(ts).distinct().withColumn("__all", F.lit(0))
    ranked = scan(times, ["__all"], [ts], row_number="__rank")
    kept = ranked.filter((F.col("__rank") - 1) % stride == 0)
    return df.join(kept.select(ts), ts, "left_semi")
