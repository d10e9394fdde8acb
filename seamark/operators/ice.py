"""Ice cover: cell matching, daily, pixel, station and seasonal scores."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seamark.functions.rounding import half_even
from seamark.operators import scores, spatial
from seamark.operators.quantiles import exact_percentiles
from seamark.session import spread


def nearest_valid(
    stations: DataFrame,
    cells: DataFrame,
    valid: DataFrame,
    *,
    node_id: str,
    first_deg: float = 0.01,
    retry_deg: float = 0.05,
    lat: str = "lat",
    lon: str = "lon",
) -> DataFrame:
    """Nearest cell that has data, by planar degrees.

    A station is matched only if some cell (with or without data) lies within
    ``first_deg``; the nearest cell with data may then be up to ``retry_deg``
    away.
    """
    near = spatial.nearest(
        stations, cells, node_id=node_id, box_deg=retry_deg * 1.2, planar=True, lat=lat, lon=lon
    )
    covered = near.filter(F.col("distance") <= first_deg * first_deg).select(*stations.columns)
    usable = cells.join(valid.select(node_id), node_id, "left_semi")
    hit = spatial.nearest(
        covered, usable, node_id=node_id, box_deg=retry_deg * 1.2, planar=True, lat=lat, lon=lon
    ).filter(F.col("distance") <= retry_deg * retry_deg)
    return stations.join(spread(hit.select(*stations.columns, node_id)), stations.columns, "left")


EXTENT_LIMIT = 10.0
# Model concentration classes in percent.
CLASSES = ((0.0, 25.0, "0-25%"), (25.0, 50.0, "25-50%"), (50.0, 75.0, "50-75%"), (75.0, 1e9, "75-100%"))


def _flags(obs: Column, model: Column, limit: float) -> tuple[Column, Column]:
    return obs >= limit, model >= limit


def attach_climatology(pairs: DataFrame, clim: DataFrame, keys: Sequence[str], ts: str = "ts") -> DataFrame:
    """Climatology of the same calendar month and day (29 February included)."""
    rows = pairs.withColumn("month", F.month(ts)).withColumn("dom", F.dayofmonth(ts))
    return rows.join(clim, [*keys, "month", "dom"], "left").drop("month", "dom")


def daily_scores(pairs: DataFrame, keys: Sequence[str] = ("ts",), *, limit: float = EXTENT_LIMIT) -> DataFrame:
    """Per day: means, spreads, extents, RMSE, skill score and contingency rates.

    ``clim`` may be absent; the skill score then stays NULL.
    """
    obs, model = F.col("obs"), F.col("model")
    e = model - obs
    o, m = _flags(obs, model, limit)
    hits, false, missed = F.count_if(o & m), F.count_if(~o & m), F.count_if(o & ~m)
    total = (hits + false + missed).cast("double")

    def share(n: Column) -> Column:
        return F.coalesce(F.try_divide(n, F.when(total > 0, total)), F.lit(0.0))

    def extent(c: Column) -> Column:
        return F.coalesce(F.try_divide(100.0 * F.count_if(c >= limit), F.count_if(c >= 0).cast("double")), F.lit(0.0))

    either = F.when((obs + model) >= 1, e)
    enough = (F.count(obs) >= 2) & (F.count(model) >= 2)
    out = [
        F.avg(obs).alias("obs_mean"),
        F.stddev_pop(obs).alias("obs_std"),
        F.avg(model).alias("model_mean"),
        F.stddev_pop(model).alias("model_std"),
        extent(obs).alias("obs_extent"),
        extent(model).alias("model_extent"),
        F.when(enough, scores.rmse(e)).alias("rmse_all"),
        F.when(F.count(either) >= 2, scores.rmse(either)).alias("rmse_either"),
        share(hits).alias("csi"),
        share(false).alias("false_alarms"),
        share(missed).alias("misses"),
        share(false + missed).alias("extent_error"),
    ]
    if "clim" in pairs.columns:
        vs = F.avg((model - F.col("clim")) * (model - F.col("clim")))
        skill = 1 - F.try_divide(F.avg(e * e), F.when(vs > 0, vs))
        out.append(F.when(enough, skill).alias("skill_score"))
    else:
        out.append(F.lit(None).cast("double").alias("skill_score"))
    return pairs.groupBy(*keys).agg(*out)


def pixel_scores(
    pairs: DataFrame, keys: Sequence[str] = ("iy", "ix"), *, ts: str = "ts", limit: float = EXTENT_LIMIT, min_days: int = 5
) -> DataFrame:
    """Per cell over the run: differences, means, ice days and hit/miss/false shares.

    Open water (a cell that never has ice) gives NULL.  Nothing is returned for
    runs shorter than ``min_days``.
    """
    obs, model = F.col("obs"), F.col("model")
    o, m = F.coalesce(obs >= limit, F.lit(False)), F.coalesce(model >= limit, F.lit(False))
    both = obs.isNotNull() & model.isNotNull()
    e = F.when((obs + model) >= 1, model - obs)
    any_ice = F.count_if(both & (o | m)).cast("double")

    def share(flag: Column) -> Column:
        return F.try_divide(100.0 * F.count_if(both & flag), F.when(any_ice > 0, any_ice))

    def days(flag: Column) -> Column:
        return F.when(F.count_if(flag) > 0, F.count_if(flag))

    long_enough = pairs.agg(F.datediff(F.max(ts), F.min(ts)) >= min_days).scalar()
    out = pairs.groupBy(*keys).agg(
        F.avg(e).alias("diff_mean"),
        F.max(e).alias("diff_max"),
        F.min(e).alias("diff_min"),
        F.when(F.count_if(obs >= 1) > 0, F.avg(obs)).alias("obs_mean"),
        F.when(F.count_if(model >= 1) > 0, F.avg(model)).alias("model_mean"),
        scores.rmse(e).alias("rmse"),
        days(o).alias("obs_ice_days"),
        days(m).alias("model_ice_days"),
        F.when(F.count_if(o) > 0, F.lit(1)).alias("obs_ever_ice"),
        F.when(F.count_if(m) > 0, F.lit(1)).alias("model_ever_ice"),
        share(o & m).alias("hit_percent"),
        share(o & ~m).alias("miss_percent"),
        share(~o & m).alias("false_alarm_percent"),
    )
    return out.filter(long_enough)


def station_scores(pairs: DataFrame, keys: Sequence[str]) -> DataFrame:
    obs, model = F.col("obs"), F.col("model")
    e = model - obs
    return pairs.groupBy(*keys).agg(
        F.when(F.count(e) > 5, half_even(scores.pearson(model, obs), 2)).alias("r"),
        half_even(scores.rmse(e), 2).alias("rmse"),
        half_even(F.avg(e), 2).alias("bias"),
        half_even(F.stddev_pop(e), 2).alias("bias_std"),
        half_even(F.avg(obs), 2).alias("obs_mean"),
        half_even(F.avg(model), 2).alias("model_mean"),
    )


def neighbourhood_scores(
    neighbours: DataFrame, values: DataFrame, obs: DataFrame, keys: Sequence[str], *, node_id: str, ts: str = "ts"
) -> DataFrame:
    """RMSE of the mean of the 1, 9 and 25 nearest model cells, and the best of them.

    ``neighbours`` holds (station keys, node_id, rank <= 25).
    """
    sizes = (1, 9, 25)
    rows = neighbours.join(values, node_id)
    means = rows.groupBy(*keys, ts).agg(
        *[F.avg(F.when(F.col("rank") <= n, F.col("value"))).alias(f"mean_{n}") for n in sizes],
        F.stddev_pop(F.when(F.col("rank") <= 25, F.col("value"))).alias("spread_25"),
    )
    paired = means.join(obs, [*keys, ts])
    out = paired.groupBy(*keys).agg(
        *[scores.rmse(F.col(f"mean_{n}") - F.col("obs")).alias(f"rmse_{n}") for n in sizes],
        F.avg("spread_25").alias("spread_25"),
    )
    ranked = F.array_sort(
        F.filter(
            F.array(*[F.struct(F.col(f"rmse_{n}").alias("e"), F.lit(i).alias("radius")) for i, n in enumerate(sizes)]),
            lambda s: s["e"].isNotNull(),
        )
    )
    return out.withColumn("best_radius", F.try_element_at(ranked, F.lit(1))["radius"])


def class_rmse(pairs: DataFrame, keys: Sequence[str] = ("iy", "ix")) -> DataFrame:
    """Per-cell RMSE within each model concentration class and over all values."""
    obs, model = F.col("obs"), F.col("model")
    e = model - obs
    label = F.lit(None).cast("string")
    for lo, hi, name in CLASSES:
        label = F.when((model >= lo) & (model < hi), F.lit(name)).otherwise(label)
    rows = pairs.filter(e.isNotNull()).select(
        *keys, e.alias("e"), F.explode(F.array(label, F.lit("0-100%"))).alias("class")
    )
    return rows.filter(F.col("class").isNotNull()).groupBy(*keys, "class").agg(scores.rmse(F.col("e")).alias("rmse"))


def class_distribution(pairs: DataFrame, keys: Sequence[str] = ("iy", "ix")) -> DataFrame:
    """Exact quartiles of the per-cell RMSE of each class."""
    return exact_percentiles(class_rmse(pairs, keys), ["class"], "rmse", [0.25, 0.5, 0.75])


def seasonal_rollup(daily: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mean hit/false/miss rates over days with any ice, mean RMSE where positive."""
    any_ice = F.col("csi") + F.col("misses") + F.col("false_alarms") != 0
    return daily.groupBy(*keys).agg(
        *[F.avg(F.when(any_ice, F.col(c))).alias(c) for c in ("csi", "false_alarms", "misses")],
        F.avg(F.when(F.col("rmse_all") > 0, F.col("rmse_all"))).alias("rmse_all"),
        F.avg("rmse_either").alias("rmse_either"),
    )


def _fit_weights(width: int = 7, degree: int = 2) -> np.ndarray:
    """Row p: weights giving the fitted polynomial at position p of the window."""
    x = np.arange(width) - width // 2
    a = np.vander(x, degree + 1, increasing=True)
    return a @ np.linalg.pinv(a)


def smooth_daily(daily: DataFrame, keys: Sequence[str], day: str, value: str, *, width: int = 7) -> DataFrame:
    """Savitzky-Golay smoothing (order 2) of a filled daily series, at most 1.

    Gaps take the next value, trailing gaps the last; they are blanked again
    afterwards.  Series shorter than 10 rows stay unsmoothed (a 3-point fit of
    order 2 returns its middle point).  One row per key and calendar day keeps
    the per-key window small.
    """
    w = Window.partitionBy(*keys).orderBy(day)
    every = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = w.rowsBetween(Window.unboundedPreceding, 0)
    back = Window.partitionBy(*keys).orderBy(F.col(day).desc()).rowsBetween(Window.unboundedPreceding, 0)
    filled = F.coalesce(F.last(value, True).over(back), F.last(value, True).over(before))
    rows = daily.select(*keys, day, value, filled.alias("__f")).select(
        "*", F.row_number().over(w).alias("__i"), F.count(F.lit(1)).over(every).alias("__n")
    )
    half = width // 2
    weights = _fit_weights(width)

    def fit(position: int) -> Column:
        """Value at window position ``position`` of the window around the row."""
        total = F.lit(0.0)
        for p in range(width):
            off = p - position
            term = F.lag("__f", -off).over(w) if off < 0 else F.lead("__f", off).over(w)
            total = total + float(weights[position, p]) * (F.col("__f") if off == 0 else term)
        return total

    smooth = fit(half)
    for k in range(half):
        smooth = F.when(F.col("__i") == k + 1, fit(k)).otherwise(smooth)
        smooth = F.when(F.col("__n") - F.col("__i") == k, fit(width - 1 - k)).otherwise(smooth)
    smooth = F.when(F.col("__n") < 10, F.col("__f")).otherwise(smooth)
    return rows.withColumn("__s", smooth).select(
        *keys,
        day,
        value,
        F.when(F.col(value).isNotNull(), F.least(F.col("__s"), F.lit(1.0))).alias(f"{value}_smooth"),
    )


def mismatched_days(obs: DataFrame, model: DataFrame, day: str) -> DataFrame:
    """Days present on one side only."""
    o, m = obs.select(day).distinct(), model.select(day).distinct()
    return (
        o.join(m, day, "left_anti")
        .select(day, F.lit("obs").alias("only_in"))
        .unionByName(m.join(o, day, "left_anti").select(day, F.lit("model").alias("only_in")))
    )
