"""Small text rules: lists, names, mounting symbols, labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_list(text: Column) -> Column:
    """Comma list, with or without brackets and spaces, to lower-case items."""
    return F.split(F.lower(F.regexp_replace(text, r"[\[\] ]", "")), ",")


def datum_name(text: Column) -> Column:
    """Full names for the short datum aliases; other names stay as written."""
    return (
        F.when(F.upper(text) == "NAVD", F.lit("NAVD88"))
        .when(F.upper(text) == "IGLD", F.lit("IGLD85"))
        .otherwise(text)
    )


def mounting_symbol(text: Column) -> Column:
    """One of side / up / down / unknown from whatever the provider wrote."""
    t = F.lower(F.trim(text))
    return (
        F.when(
            t.isin("side", "h") | t.startswith("side-") | t.startswith("horiz"), F.lit("side")
        )
        .when(t.isin("up", "u") | t.startswith("upward"), F.lit("up"))
        .when(t.isin("down", "d") | t.startswith("downward"), F.lit("down"))
        .otherwise(F.lit("unknown"))
    )


def bin_station_id(station: Column, bin_no: Column) -> Column:
    return F.format_string("%s_b%02d", station, bin_no)


def split_bin_station_id(text: Column) -> Column:
    """Struct (station_id, bin); bin is NULL for a plain station id."""
    pattern = r"^(.+)_b(\d+)$"
    hit = F.regexp_extract(text, pattern, 2)
    return F.struct(
        F.when(hit != "", F.regexp_extract(text, pattern, 1)).otherwise(text).alias("station_id"),
        hit.try_cast("int").alias("bin"),
    )


def depth_label(station: Column, depth: Column) -> Column:
    """``ID@depthm`` with one decimal; just the ID when the depth is missing."""
    return F.when(
        depth.isNotNull(), F.concat(station, F.lit("@"), F.format_string("%.1f", depth), F.lit("m"))
    ).otherwise(station)


def passes(value: Column, limit: Column | float, *, at_least: bool) -> Column:
    """'pass' or 'fail'; a missing value fails."""
    ok = value >= limit if at_least else value <= limit
    return F.when(ok, F.lit("pass")).otherwise(F.lit("fail"))
