"""Forecast-horizon frames, kept long: one row per (series, cycle, valid time)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seamark.functions.rounding import half_even
from seamark.functions import clock
from seamark.operators import scores


def pair_with_observations(
    forecast: DataFrame,
    obs: DataFrame,
    keys: Sequence[str],
    *,
    ts: str = "ts",
    value: str = "obs",
) -> DataFrame:
    """Left join on (series, ts); no look-back."""
    return forecast.join(
        obs.select(*keys, ts, F.col(value).alias("obs")), [*keys, ts], "left"
    )


def add_lead(df: DataFrame, forecast_hours: int, *, ts: str = "ts", cycle: str = "cycle") -> DataFrame:
    """Lead hour and 6-hour bin of each row, rows outside 0..forecast length dropped."""
    h = clock.lead_hours(F.col(ts), F.col(cycle))
    return df.withColumn("lead_hour", h).filter(
        F.col("lead_hour").between(0, forecast_hours)
    ).withColumn("hour_bin", clock.lead_bin(F.col("lead_hour"), forecast_hours).cast("int"))


def horizon_scores(
    df: DataFrame,
    *,
    x1: float,
    cycle: str = "cycle",
    min_error_count: int = 10,
    min_cf_count: int = 20,
) -> DataFrame:
    """RMSE, mean error and CF by lead bin and by model cycle, in one pass.

    Groups need more than the given counts of errors.
    """
    e = F.col("model") - F.col("obs")
    rows = df.select("hour_bin", cycle, e.alias("e"))
    grouped = rows.groupingSets([["hour_bin"], [cycle]], "hour_bin", cycle).agg(
        F.count("e").alias("n"),
        half_even(scores.rmse(F.col("e")), 2).alias("rmse"),
        half_even(F.avg("e"), 2).alias("mean_error"),
        half_even(scores.central_frequency(F.col("e"), F.lit(float(x1))), 2).alias("central_freq"),
    )
    big = F.col("n") > min_error_count
    return grouped.filter(big).select(
        "hour_bin",
        cycle,
        "n",
        "rmse",
        "mean_error",
        F.when(F.col("n") > min_cf_count, F.col("central_freq")).alias("central_freq"),
    )


def station_cycle_matrix(
    df: DataFrame, keys: Sequence[str], *, x1: float, cycle: str = "cycle", cycles: Sequence | None = None
) -> DataFrame:
    """CF per station and cycle: long form, or one column per given cycle."""
    e = F.col("model") - F.col("obs")
    cf = half_even(scores.central_frequency(e, F.lit(float(x1))), 2)
    if cycles is None:
        return df.groupBy(*keys, cycle).agg(cf.alias("central_freq"))
    return df.groupBy(*keys).pivot(cycle, list(cycles)).agg(cf)


def from_wide(df: DataFrame, ids: Sequence[str], cycle: str = "cycle", value: str = "model") -> DataFrame:
    """Wide import (one column per cycle) to long rows without empty cells."""
    cols = [c for c in df.columns if c not in ids]
    return df.unpivot(list(ids), cols, cycle, value).filter(F.col(value).isNotNull())


def contributing_cycles(
    times: DataFrame, config: DataFrame, *, ts: str = "ts", system: str = "system"
) -> DataFrame:
    """Cycles whose forecast covers each time.

    ``config`` holds (system, forecast_hours, cycle_hours ARRAY<INT>); cycles run
    every day at those hours and reach back one forecast length.
    """
    per = times.join(config, system)
    back = F.floor(F.col("forecast_hours") / 24) + 1
    days = F.sequence(F.lit(0).cast("bigint"), back)
    out = (
        per.withColumn("__d", F.explode(days))
        .withColumn("__h", F.explode("cycle_hours"))
        .withColumn(
            "cycle",
            F.timestamp_seconds(
                F.floor(clock.epoch(F.col(ts)) / 86400) * 86400 - F.col("__d") * 86400 + F.col("__h") * 3600
            ),
        )
    )
    lead = (clock.epoch(F.col(ts)) - clock.epoch(F.col("cycle"))) / 3600
    return out.filter(lead.between(0, F.col("forecast_hours"))).select(*times.columns, "cycle")


def nearest_cycle(requests: DataFrame, config: DataFrame, *, ts: str = "ts", system: str = "system") -> DataFrame:
    """Valid cycle hour closest to the requested time of day, and the forecast length."""
    hour = F.hour(ts)
    gap = F.transform("cycle_hours", lambda h: F.struct(F.abs(h - hour).alias("d"), h.alias("h")))
    best = F.array_min(gap)["h"]
    return requests.join(config, system).select(
        *requests.columns, best.alias("cycle_hour"), "forecast_hours"
    )


def ordered_cycles(df: DataFrame, text: str, fmt: str = "yyyyMMddHH") -> DataFrame:
    """Cycle labels in time order."""
    return df.select(text).distinct().orderBy(F.try_to_timestamp(F.col(text), F.lit(fmt)))
