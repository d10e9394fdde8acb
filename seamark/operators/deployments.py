"""Sensor deployments as intervals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seamark.functions.clock import epoch
from seamark.operators.sequence import DAY, scan
from seamark.session import spread

FAR = "9999-12-31 00:00:00"
# Longest cut of a period, in powers of two of a day.
WIDEST_CUT = 5


def active_periods(
    deployments: DataFrame, start: Column, end: Column, *, deployed: str = "deployed", retrieved: str = "retrieved"
) -> DataFrame:
    """Deployments cut to the window; ``boundary`` tells that one begins or ends in it."""
    open_end = F.coalesce(F.col(retrieved), F.to_timestamp(F.lit(FAR)))
    hit = (F.col(deployed) <= end) & (open_end >= start)
    boundary = F.col(deployed).between(start, end) | open_end.between(start, end)
    return deployments.filter(hit).select(
        *[c for c in deployments.columns if c not in (deployed, retrieved)],
        F.greatest(F.col(deployed), start).alias("period_start"),
        F.least(open_end, end).alias("period_end"),
        boundary.alias("boundary"),
    )


def shifted_bins(bins: DataFrame, keys: Sequence[str], *, deployment: str = "deployment", bin_no: str = "bin", distance: str = "distance") -> DataFrame:
    """Stations whose deployments differ in their bin-to-distance tables.

    A table is the set of (bin, distance) pairs; two deployments agree when each
    pair is in both, i.e. when every pair occurs in every deployment.
    """
    good = bins.filter(F.col(deployment).isNotNull() & F.col(bin_no).isNotNull() & F.col(distance).isNotNull())
    per_bin = good.groupBy(*keys, bin_no).agg(
        F.count_distinct(deployment).alias("deps"),
        F.min(distance).alias("lo"),
        F.max(distance).alias("hi"),
    )
    total = good.groupBy(*keys).agg(F.count_distinct(deployment).alias("all_deps"))
    return (
        per_bin.join(total, list(keys))
        .groupBy(*keys)
        .agg(
            F.max("all_deps").alias("n_deployments"),
            F.max((F.col("deps") < F.col("all_deps")) | (F.col("lo") != F.col("hi"))).alias("differs"),
        )
        .select(*keys, "n_deployments", (F.col("differs") & (F.col("n_deployments") > 1)).alias("shifted"))
    )


def latest_period_only(
    obs: DataFrame, periods: DataFrame, shifted: DataFrame, keys: Sequence[str], ts: str = "ts"
) -> DataFrame:
    """Observations of stations with shifted bins restricted to their last period."""
    last = periods.groupBy(*keys).agg(F.max("period_start").alias("__from"), F.max_by("period_end", "period_start").alias("__to"))
    moved = shifted.filter("shifted").select(*keys).join(last, list(keys))
    j = obs.join(moved, list(keys), "left")
    return j.filter(
        F.col("__from").isNull() | F.col(ts).between(F.col("__from"), F.col("__to"))
    ).select(*obs.columns)


def boundary_gaps(obs: DataFrame, periods: DataFrame, keys: Sequence[str], ts: str = "ts") -> DataFrame:
    """Hours between the last observation of a period and the first of the next.

    Periods are cut into stretches of one day to 32 days, the shortest power of two that
    holds the period, and meet the observations on (station, stretch).  A station with very
    many rows is spread by stretch, short periods meet the rows of their days only, and a
    long period has about a row a month.
    """
    begin, finish = epoch(F.col("period_start")), epoch(F.col("period_end"))
    level = F.ceil(F.log2(F.greatest((finish - begin) / DAY, F.lit(1.0))))
    cut = periods.filter("period_start <= period_end").select(
        *keys, "period_start", "period_end", F.least(level, F.lit(WIDEST_CUT)).cast("int").alias("__level")
    )
    # At most six levels: one scalar array, exploded by each observation.
    levels = cut.agg(F.array_sort(F.collect_set("__level"))).scalar()
    width = F.pow(F.lit(2.0), F.col("__level")) * DAY
    part = F.explode(F.sequence(F.floor(begin / width), F.floor(finish / width)))
    p = cut.select("*", part.alias("__part"))
    seen = (
        obs.select(*keys, ts, F.explode(levels).alias("__level"))
        .withColumn("__part", F.floor(epoch(F.col(ts)) / width))
        .join(spread(p), [*keys, "__level", "__part"])
        .filter(F.col(ts).between(F.col("period_start"), F.col("period_end")))
        .groupBy(*keys, "period_start")
        .agg(F.min(ts).alias("first_obs"), F.max(ts).alias("last_obs"))
    )
    nxt = scan(seen, keys, ["period_start"], following={"next_first": F.col("first_obs")}, chunk_seconds=10 * 366 * 86400)
    hours = (epoch(F.col("next_first")) - epoch(F.col("last_obs"))) / 3600
    return nxt.filter("next_first IS NOT NULL").select(
        *keys, F.col("last_obs").alias("gap_start"), F.col("next_first").alias("gap_end"), hours.alias("hours")
    )


def short_coverage(obs: DataFrame, periods: DataFrame, keys: Sequence[str], ts: str = "ts", slack_hours: float = 1.0) -> DataFrame:
    """Periods whose last observation falls short of their end."""
    seen = obs.groupBy(*keys).agg(F.max(ts).alias("last_obs"))
    late = (epoch(F.col("period_end")) - epoch(F.col("last_obs"))) / 3600
    return periods.join(seen, list(keys), "left").select(
        *keys,
        "period_end",
        "last_obs",
        (F.col("last_obs").isNull() | (late > slack_hours)).alias("short"),
    )
