"""Station, model and grid tables derived from the supplied tables.

The views are written once in SQL both engines run; ``SECS(x)`` stands for
whole epoch seconds of a timestamp column.  They hold times as epoch seconds
``t``; the Spark side adds ``ts``.  Every view reads whole tables, so its size
grows with them.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seamark.session import pin_utc

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

VIEWS = {
    # Model and observation series per supplier on a 6-minute grid of ship dates.
    "v_model": """
        SELECT l_suppkey AS station_id,
               SECS(l_shipdate) + ((l_orderkey * 7 + l_linenumber) % 240) * 360 AS t,
               l_orderkey * 10 + l_linenumber AS seq,
               l_quantity + (l_discount - 5e-2) * 20 + (l_tax - 4e-2) * 10 AS model
        FROM lineitem""",
    "v_obs": """
        SELECT l_suppkey AS station_id,
               SECS(l_shipdate) + ((l_orderkey * 7 + l_linenumber) % 240) * 360 AS t,
               l_orderkey * 10 + l_linenumber AS seq,
               CASE WHEN (l_orderkey * 10 + l_linenumber) % 11 = 0 THEN NULL ELSE l_quantity END AS obs
        FROM lineitem WHERE (l_orderkey * 10 + l_linenumber) % 5 <> 0""",
    # The same line items as ready pairs.
    "v_pairs": """
        SELECT l_suppkey AS station_id,
               SECS(l_shipdate) + ((l_orderkey * 7 + l_linenumber) % 240) * 360 AS t,
               l_orderkey * 10 + l_linenumber AS seq,
               CASE WHEN (l_orderkey * 10 + l_linenumber) % 11 = 0 THEN NULL ELSE l_quantity END AS obs,
               l_quantity + (l_discount - 5e-2) * 20 + (l_tax - 4e-2) * 10 AS model
        FROM lineitem""",
    # Sparse hourly series per user.
    "v_series": """
        SELECT user_id AS station_id, CAST(floor(SECS(ts) / 3600) * 3600 AS BIGINT) AS t,
               max(value) AS value
        FROM events GROUP BY 1, 2""",
    # Dense hourly tide-like series, 720 hours per station, every 97th value missing.
    "v_tide": """
        SELECT CAST(floor(o_orderkey / 720) AS BIGINT) AS station_id,
               1704067200 + (o_orderkey % 720) * 3600 AS t,
               CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE
                 cos(28.9841042e0 * (o_orderkey % 720) * 3.141592653589793e0 / 180)
                 + o_totalprice / 1e6 END AS obs,
               11e-1 * cos(28.9841042e0 * ((o_orderkey % 720) - 5e-1) * 3.141592653589793e0 / 180)
                 + o_custkey / 1e5 AS model,
               cos(28.9841042e0 * (o_orderkey % 720) * 3.141592653589793e0 / 180) AS tide
        FROM orders""",
    # Hourly currents, observed and modelled.
    "v_currents": """
        SELECT CAST(floor(event_id / 720) AS BIGINT) AS station_id,
               1704067200 + (event_id % 720) * 3600 AS t, event_id AS seq,
               CASE WHEN event_id % 29 = 0 THEN NULL ELSE value / 100 END AS obs_speed,
               CASE WHEN event_id % 29 = 0 THEN NULL
                    ELSE CAST((event_id * 37) % 360 AS DOUBLE) END AS obs_dir,
               abs(value / 100 + (event_id % 41 - 20) * 2e-2) AS model_speed,
               CAST((event_id * 37 + event_id % 91 + 315) % 360 AS DOUBLE) AS model_dir
        FROM events""",
    "v_nodes": """
        SELECT p_partkey AS node_id,
               30 + (p_partkey % 100) * 5e-2 + floor(p_partkey / 40000) * 1e-4 AS lat,
               -80 + (floor(p_partkey / 100) % 400) * 5e-2 AS lon,
               CASE WHEN p_partkey % 17 = 0 THEN 0 ELSE 1 END AS wet,
               CAST(5 + p_size AS DOUBLE) AS h
        FROM part""",
    # Stations fill an area of ten degrees; every 1,500 customers have one of their own.
    "v_stations": """
        SELECT c_custkey AS station_id, c_name AS name, c_nationkey,
               30 + (c_custkey * 7 % 503) * 1e-2 + 3e-3 AS lat,
               -80 + (c_custkey * 13 % 997) * 1e-2 + 7e-3 + floor(c_custkey / 1500) % 25 * 10 AS lon,
               CAST(c_custkey % 23 AS DOUBLE) AS depth
        FROM customer""",
    # Daily frames of 15 columns and 20 rows for every 1,500 customers.
    "v_grid": """
        SELECT SECS(o_orderdate) AS t, CAST(o_custkey % 20 + floor(o_custkey / 1500) * 20 AS BIGINT) AS iy, o_orderkey % 15 AS ix,
               max(CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE sqrt(o_totalprice) / 10 END) AS obs,
               max(CASE WHEN o_orderkey % 17 = 0 THEN NULL
                        ELSE sqrt(o_totalprice) / 10 + (o_orderkey * 31 % 701) / 1e2 - 3.5e0 END) AS model
        FROM orders GROUP BY 1, 2, 3""",
    # Daily ice concentrations in percent, with a climatology value.
    "v_ice": """
        SELECT SECS(o_orderdate) AS t, CAST(o_custkey % 20 + floor(o_custkey / 1500) * 20 AS BIGINT) AS iy, o_orderkey % 15 AS ix,
               CAST(max(CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderkey * 7 % 101 END) AS DOUBLE) AS obs,
               CAST(max((o_custkey * 11 + o_orderkey * 3) % 101) AS DOUBLE) AS model
        FROM orders GROUP BY 1, 2, 3""",
    # Forecast rows: event values seen from earlier 6-hourly cycles.
    "v_forecast": """
        SELECT user_id AS station_id, SECS(ts) AS t,
               CAST(floor(SECS(ts) / 21600) * 21600 AS BIGINT) - (event_id % 20) * 21600 AS cycle_t,
               event_id AS seq, value AS obs,
               value + (event_id * 53 % 401) / 1e1 - 20 AS model
        FROM events""",
}

_SECS = re.compile(r"SECS\((\w+)\)")
_TIME_COLUMNS = {"t": "ts", "cycle_t": "cycle"}


def duck_sql(name: str) -> str:
    return _SECS.sub(r"CAST(floor(epoch(\1)) AS BIGINT)", VIEWS[name])


def with_views(sql: str) -> str:
    """Prefix the CTEs of every demo view the statement mentions."""
    used = [v for v in VIEWS if re.search(rf"\b{v}\b", sql)]
    ctes = ",\n".join(f"{v} AS ({duck_sql(v)})" for v in used)
    if not used:
        return sql
    body = sql.strip()
    for lead in ("WITH RECURSIVE ", "WITH "):
        if body.upper().startswith(lead):
            return f"{lead}{ctes},\n{body[len(lead):]}"
    return f"WITH {ctes}\n{body}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    pin_utc(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Demo view as a DataFrame with ``ts`` (and ``cycle``) timestamps."""
    body = _SECS.sub(r"unix_seconds(CAST(\1 AS TIMESTAMP))", VIEWS[name])
    source = re.search(r"\bFROM (\w+)", body).group(1)
    df = spark.sql(
        body.replace(f"FROM {source}", "FROM {src}"), src=table(spark, sf_dir, source)
    )
    for sec, ts in _TIME_COLUMNS.items():
        if sec in df.columns:
            df = df.withColumn(ts, F.timestamp_seconds(sec)).drop(sec)
    return df


def secs(column: str, alias: str | None = None):
    """Output form of a time: epoch seconds."""
    return F.unix_seconds(F.col(column).cast("timestamp")).alias(alias or column)


def r6(column, alias: str | None = None):
    name = alias or column
    return F.round(F.col(column), 6).alias(name)


# SQL of the text of one line: head from t and its timestamp d, and one value field.
LINE_HEAD = "printf('%13.8f %4d %2d %2d %2d %2d', round(t / 86400e0 + 2440587.5, 4), year(d), month(d), day(d), hour(d), minute(d))"


def line_field(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '      nan' ELSE printf('%9.4f', {value}) END"
