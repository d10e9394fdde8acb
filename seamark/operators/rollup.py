"""System-level roll-ups and skill tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seamark.operators import scores


def system_scores(
    pairs: DataFrame, keys: Sequence[str], x1: Column, *, error: str = "bias", min_pairs: int = 10
) -> DataFrame:
    """CF and RMSE / X1 over all pairs of a system; needs more than ``min_pairs``."""
    e = F.col(error)
    rows = pairs.withColumn("__x1", x1)
    enough = F.count(e) > min_pairs
    return rows.groupBy(*keys).agg(
        F.count(e).alias("n_pairs"),
        F.when(enough, scores.central_frequency(e, F.col("__x1"))).alias("central_freq"),
        F.when(enough, scores.rmse(e) / F.max("__x1")).alias("rmse_over_x1"),
    )


def system_rollup(pairs: DataFrame, outer: str, inner: str, x1: Column, *, error: str = "bias") -> DataFrame:
    """Both levels (system, variable) and (system) in one pass."""
    e = F.col(error)
    return (
        pairs.withColumn("__z", F.abs(e) / x1)
        .rollup(outer, inner)
        .agg(
            F.count(e).alias("n_pairs"),
            F.avg(F.when(F.col("__z").isNotNull(), (F.col("__z") <= 1).cast("double"))).alias("central_share"),
            F.sqrt(F.avg(F.col("__z") * F.col("__z"))).alias("rmse_over_x1"),
        )
        .filter(F.col(outer).isNotNull())
    )


def scorecard(scores_long: DataFrame, row: str, variable: str, value: str, variables: Sequence[str]) -> DataFrame:
    """One row per system, one column per variable."""
    return scores_long.groupBy(row).pivot(variable, list(variables)).agg(F.max(value))


def all_systems(tables: Sequence[DataFrame], keys: Sequence[str], start: str, end: str) -> DataFrame:
    """Union of skill tables with the overall period of each key."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out.groupBy(*keys).agg(
        F.min(start).alias("start"), F.max(end).alias("end"), F.count(F.lit(1)).alias("n_rows")
    )
