"""All registered queries and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from seamark.plans import grid_queries, ingest_queries, mesh_queries, score_queries, space_queries, tide_queries  # noqa: F401
from seamark.plans.registry import ORACLES, QUERIES, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["agg13_skill_scalar"](spark, sf_dir)
