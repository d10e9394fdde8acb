"""Pairing model with observation.

The model side loses *every* row of a repeated timestamp.  Observations are
brought onto the union of both time axes, optionally gap-filled, and joined on
(series, ts).  Join keys carry the time, so a dominant station spreads over all
partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seamark.functions import angles
from seamark.functions.clock import epoch
from seamark.operators.fill import fill_linear, merged_timeline
from seamark.operators.sequence import CHUNK_SECONDS, halo, keep_first, unique_only


def in_window(ts: Column, start: Column, end: Column, lookback_hours: int = 0) -> Column:
    """start - lookback <= ts <= end, both ends included."""
    return ts.between(start - F.make_dt_interval(hours=F.lit(lookback_hours)), end)


def filled_observations(
    obs: DataFrame,
    model: DataFrame,
    keys: Sequence[str],
    ts: str,
    columns: str | Sequence[str],
    *,
    limit: int = 3,
) -> DataFrame:
    """Observations on the merged timeline with short gaps filled."""
    names = [columns] if isinstance(columns, str) else list(columns)
    line = merged_timeline(obs, model, keys, ts, names)
    return fill_linear(line, keys, ts, names, limit=limit, edges=True, tie=names)


def pair_scalar(
    obs: DataFrame,
    model: DataFrame,
    keys: Sequence[str],
    *,
    ts: str = "ts",
    obs_value: str = "obs",
    model_value: str = "model",
    exact_only: bool = True,
    start: Column | None = None,
    end: Column | None = None,
    lookback_hours: int = 6,
) -> DataFrame:
    """Model rows left-joined to observations, with ``bias`` = model - obs.

    ``exact_only`` uses observations only at the times they were taken;
    otherwise short gaps of the merged timeline are filled first.
    """
    if exact_only:
        right = obs.filter(F.col(obs_value).isNotNull()).select(*keys, ts, obs_value)
    else:
        right = filled_observations(obs, model, keys, ts, obs_value).filter(
            F.col(obs_value).isNotNull()
        )
    left = unique_only(model.select(*keys, ts, model_value), [*keys, ts])
    if start is not None and end is not None:
        # Filters on the join key reach both scans.
        left = left.filter(in_window(F.col(ts), start, end, lookback_hours))
    return left.join(right, [*keys, ts], "left").withColumn(
        "bias", F.col(model_value) - F.col(obs_value)
    )


def pair_vector(
    obs: DataFrame,
    model: DataFrame,
    keys: Sequence[str],
    *,
    ts: str = "ts",
    fill: bool = True,
) -> DataFrame:
    """Pair ``obs_speed, obs_dir`` with ``model_speed, model_dir``.

    With ``fill`` short gaps of observed speed and direction are filled on the
    merged timeline, each column on its own.
    """
    left = unique_only(model.select(*keys, ts, "model_speed", "model_dir"), [*keys, ts])
    names = ["obs_speed", "obs_dir"]
    right = filled_observations(obs, model, keys, ts, names) if fill else obs
    right = right.filter("obs_speed IS NOT NULL OR obs_dir IS NOT NULL").select(*keys, ts, *names)
    return left.join(right, [*keys, ts], "left").select(
        "*",
        (F.col("model_speed") - F.col("obs_speed")).alias("speed_bias"),
        angles.signed_angle(F.col("model_dir"), F.col("obs_dir")).alias("dir_bias"),
    )


def asof_nearest(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    *,
    ts: str = "ts",
    value: str = "value",
    tolerance_seconds: float = 180,
    chunk_seconds: int = CHUNK_SECONDS,
) -> DataFrame:
    """Nearest right row of the same series within the tolerance, else NULL.

    Both sides are merged into one ordered sequence and each left row looks at
    the last right row at or before it and the first after it: no candidate
    pairs are formed.  The tolerance bounds the look, so chunks with a halo are
    enough.  An earlier row wins a tie.
    """
    tag = right.select(
        *keys, ts, F.lit(0).alias("__side"), F.struct(F.col(ts).alias("at"), F.col(value)).alias("__r")
    )
    rows = left.select(*keys, ts, F.lit(1).alias("__side"), F.struct(*left.columns).alias("__l"))
    reach = int(tolerance_seconds) + 1
    wide, chunk, home = halo(
        rows.unionByName(tag, allowMissingColumns=True),
        ts,
        before=reach,
        after=reach,
        chunk_seconds=chunk_seconds,
    )
    up = Window.partitionBy(*keys, chunk).orderBy(ts, "__side", F.col("__r")[value])
    down = Window.partitionBy(*keys, chunk).orderBy(
        F.col(ts).desc(), F.col("__side").desc(), F.col("__r")[value].desc()
    )
    past = Window.unboundedPreceding, -1
    out = (
        wide.withColumn("__before", F.last("__r", True).over(up.rowsBetween(*past)))
        .withColumn("__after", F.last("__r", True).over(down.rowsBetween(*past)))
        .filter(home & (F.col("__side") == 1))
    )
    here = F.unix_micros(F.col(ts).cast("timestamp"))

    def gap(name: str) -> Column:
        return F.abs(F.unix_micros(F.col(name)["at"].cast("timestamp")) - here)

    near = F.when(
        F.col("__after").isNull() | (gap("__before") <= gap("__after")), F.col("__before")
    ).otherwise(F.col("__after"))
    ok = F.abs(F.unix_micros(near["at"].cast("timestamp")) - here) <= tolerance_seconds * 1e6
    return out.select(
        *[F.col("__l")[c].alias(c) for c in left.columns],
        F.when(ok, near["at"]).alias(f"matched_{ts}"),
        F.when(ok, near[value]).alias(f"matched_{value}"),
    )


def with_tide(pairs: DataFrame, tides: DataFrame, keys: Sequence[str], ts: str = "ts") -> DataFrame:
    """Observation, model and predicted tide at common times."""
    return pairs.join(tides, [*keys, ts], "inner")


def matched_stations(obs_stations: DataFrame, model_stations: DataFrame, key: str, order: str):
    """(matched, unmatched): equal ids; the last model entry of an id wins."""
    model = keep_first(model_stations, [key], [order], last=True)
    return obs_stations.join(model, key, "inner"), obs_stations.join(model, key, "left_anti")


def replace_cycle(frame: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Long horizon frame with the rows of the new cycles replacing old ones."""
    return frame.join(new.select(*keys).distinct(), list(keys), "left_anti").unionByName(new)


def merge_horizon_wide(frame: DataFrame, new: DataFrame, on: Sequence[str], column: str) -> DataFrame:
    """Wide frame import: full outer on time; the incoming column replaces its namesake."""
    return frame.drop(column).join(new.select(*on, column), list(on), "full_outer")


def same_day_pairs(
    daily: DataFrame, hourly: DataFrame, keys: Sequence[str], *, ts: str = "ts"
) -> DataFrame:
    """Daily observation joined to each model row of its calendar day."""
    left = daily.withColumn("day", F.to_date(ts)).drop(ts)
    return left.join(hourly.withColumn("day", F.to_date(ts)), [*keys, "day"])


def hours_between(ts: Column, other: Column) -> Column:
    return (epoch(ts) - epoch(other)) / 3600
