"""Station inventories: capability, dedup, filters, coverage, virtual stations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seamark.functions.text import bin_station_id, mounting_symbol

FLAGS = ("has_wl", "has_temp", "has_salt", "has_cu")

# Product and series codes behind each capability.
PRODUCT_FLAGS = {
    "has_wl": ("waterlevels",),
    "has_temp": ("watertemp",),
    "has_salt": ("physocean",),
    "has_cu": ("currents", "historiccurrents"),
}
CODE_FLAGS = {
    "has_wl": (("wlo",),),
    "has_temp": (("wt1", "wt2"),),
    "has_salt": (("ws1", "ws2"),),
    "has_cu": (("wcs1", "wcs2"), ("wcd1", "wcd2")),
}


def in_box(lat: Column, lon: Column, box: Sequence[float], *, strict: bool = True) -> Column:
    """Inside (lat_min, lat_max, lon_min, lon_max), borders excluded when strict."""
    y0, y1, x0, x1 = box
    if strict:
        return (lat > y0) & (lat < y1) & (lon > x0) & (lon < x1)
    return lat.between(y0, y1) & lon.between(x0, x1)


def with_capability(df: DataFrame, flags: Sequence[str] = FLAGS) -> DataFrame:
    """Stations with any of the flags."""
    any_flag = F.lit(False)
    for f in flags:
        any_flag = any_flag | F.coalesce(F.col(f), F.lit(False))
    return df.filter(any_flag)


def capabilities_from_products(
    df: DataFrame, keys: Sequence[str], product: str = "product", flags: Mapping[str, Sequence[str]] = PRODUCT_FLAGS
) -> DataFrame:
    """(station, product) rows to one row per station with capability flags."""
    return df.groupBy(*keys).agg(
        *[F.bool_or(F.col(product).isin(*codes)).alias(f) for f, codes in flags.items()]
    )


def capabilities_from_codes(df: DataFrame, codes: str = "codes") -> DataFrame:
    """Flags from an array of series codes; currents need speed and direction."""

    def has(groups) -> Column:
        out = F.lit(True)
        for g in groups:
            out = out & F.arrays_overlap(F.col(codes), F.array(*[F.lit(c) for c in g]))
        return F.coalesce(out, F.lit(False))

    return df.withColumns({f: has(groups) for f, groups in CODE_FLAGS.items()})


def merge_inventories(*tables: DataFrame) -> DataFrame:
    """Inventories in priority order; ``priority`` keeps that order."""
    out = None
    for i, t in enumerate(tables):
        part = t.withColumn("priority", F.lit(i))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    for f in FLAGS:
        if f not in out.columns:
            out = out.withColumn(f, F.lit(None).cast("boolean"))
    return out


def dedup_inventory(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """One row per (Source, ID): first position and name, OR of the flags.

    A missing flag counts as True.  The name is no part of the key, so two
    stations that share a name both stay.
    """
    rank = F.struct(*order)
    return df.groupBy("Source", "ID").agg(
        *[F.min_by(c, F.when(F.col(c).isNotNull(), rank)).alias(c) for c in ("X", "Y", "Name")],
        *[F.bool_or(F.coalesce(F.col(f), F.lit(True))).alias(f) for f in FLAGS],
    )


def drop_name_duplicates(df: DataFrame, *, key: str = "ID", name: str = "Name", order: str) -> DataFrame:
    """Drop the first row whose name starts with another row's id.

    An id triggers a drop only when no name holds it further in.  Names are cut
    into the substrings as long as some id, which meet the ids in an equi-join.
    """
    # The distinct lengths of ids are few: one scalar array, exploded by each name.
    lengths = df.agg(F.array_sort(F.collect_set(F.length(key)))).scalar()
    grams = (
        df.select(name, F.col(order).alias("__o"))
        .withColumn("len", F.explode(lengths))
        .filter((F.col("len") > 0) & (F.length(name) >= F.col("len")))
        .select(
            "__o",
            F.posexplode(
                F.transform(
                    F.sequence(F.lit(1), F.length(name) - F.col("len") + 1),
                    lambda i: F.substr(F.col(name), i, F.col("len")),
                )
            ).alias("pos", "gram"),
        )
    )
    # First place of each id in each name, then the furthest of those.
    first = (
        grams.join(df.select(F.col(key).alias("gram")).distinct(), "gram", "left_semi")
        .groupBy("gram", "__o")
        .agg(F.min("pos").alias("pos"))
    )
    drop = (
        first.groupBy("gram")
        .agg(F.max("pos").alias("far"), F.min(F.when(F.col("pos") == 0, F.col("__o"))).alias("__o"))
        .filter("far = 0")
        .select(F.col("__o").alias(order))
        .distinct()
    )
    return df.join(drop, order, "left_anti").select(*df.columns)


def listed_only(df: DataFrame, wanted: DataFrame, key: str = "ID"):
    """(stations on the list, list entries without a station)."""
    return df.join(wanted.select(key), key, "left_semi"), wanted.select(key).distinct().join(df, key, "left_anti")


def attach_flags(df: DataFrame, available: DataFrame, keys: Sequence[str], flags: Sequence[str] = FLAGS) -> DataFrame:
    """Availability flags by left join; absent stations get False."""
    out = df.join(available.select(*keys, *flags), list(keys), "left")
    return out.withColumns({f: F.coalesce(F.col(f), F.lit(False)) for f in flags})


def map_positions(df: DataFrame, lat: str = "Y", lon: str = "X") -> DataFrame:
    """Numeric positions only; (0, 0) is no position."""
    y, x = F.col(lat).try_cast("double"), F.col(lon).try_cast("double")
    return df.withColumn(lat, y).withColumn(lon, x).filter(
        F.col(lat).isNotNull() & F.col(lon).isNotNull() & ~((F.col(lat) == 0) & (F.col(lon) == 0))
    )


def stage_coverage(
    stations: DataFrame, casts: Sequence[str], stages: Mapping[str, DataFrame], keys: Sequence[str]
) -> DataFrame:
    """For each station and cast, whether each stage holds its key.

    A stage table has ``keys`` and, where the stage depends on it, ``cast``.
    """
    out = stations.select(*keys).distinct().withColumn("cast", F.explode(F.array(*[F.lit(c) for c in casts])))
    for name, table in stages.items():
        on = [*keys, "cast"] if "cast" in table.columns else list(keys)
        mark = table.select(*on).distinct().withColumn(name, F.lit(True))
        out = out.join(mark, on, "left").withColumn(name, F.coalesce(F.col(name), F.lit(False)))
    return out


def virtual_stations(bins: DataFrame, overrides: DataFrame):
    """(one station per sensor bin, requested bins that do not exist).

    ``bins``: station_id, name, bin, depth, depth_unknown, height_from_bottom,
    mounting.  A station with overrides keeps only the bins they name; an
    override depth clears the height and the unknown mark.
    """
    o = overrides.select(
        "station_id",
        "bin",
        F.col("depth").alias("o_depth"),
        F.col("orientation").alias("o_mount"),
        F.col("name").alias("o_name"),
        F.lit(True).alias("o_hit"),
    )
    listed = overrides.select("station_id").distinct().withColumn("o_any", F.lit(True))
    j = (
        bins.join(listed, "station_id", "left")
        .join(o, ["station_id", "bin"], "left")
        .filter(F.col("o_any").isNull() | F.col("o_hit").isNotNull())
    )
    unknown = F.coalesce(F.col("depth_unknown"), F.lit(False)) & F.col("o_depth").isNull()
    label = F.concat(
        F.col("name"),
        F.format_string(" (bin %02d", "bin"),
        F.when(F.col("o_name").isNotNull(), F.concat(F.lit(" / "), F.col("o_name"))).otherwise(""),
        F.when(unknown, F.lit(", depth unknown")).otherwise(""),
        F.lit(")"),
    )
    out = j.select(
        bin_station_id(F.col("station_id"), F.col("bin")).alias("virtual_id"),
        "station_id",
        "bin",
        label.alias("label"),
        F.coalesce("o_depth", "depth", F.lit(0.0)).alias("depth"),
        F.when(F.col("o_depth").isNotNull(), 0.0)
        .otherwise(F.coalesce("height_from_bottom", F.lit(0.0)))
        .alias("height_from_bottom"),
        mounting_symbol(F.coalesce("o_mount", "mounting")).alias("mounting"),
    )
    absent = overrides.join(bins, ["station_id", "bin"], "left_anti").select("station_id", "bin")
    return out, absent


def sensor_depth(sensor: Column, measured: Column, height: Column) -> Column:
    """Depth of a side-looking sensor: its own, else water depth minus height."""
    return F.when(sensor >= 0, sensor).when((measured > height) & (height >= 0), measured - height)


def choose_bins(bins: DataFrame) -> DataFrame:
    """Bins to retrieve, with their depth.

    Side-looking: only the real-time bin (station payload, else the active
    deployment, else any), at the sensor depth.  Others: every bin at its own
    depth, 0 and flagged when that is missing.
    """
    chosen = F.coalesce("real_time_bin", "active_real_time_bin", "any_real_time_bin")
    side = F.col("mounting") == "side"
    at_sensor = sensor_depth(F.col("sensor_depth"), F.col("measured_depth"), F.col("height_from_bottom"))
    own = F.when(side, at_sensor).otherwise(F.col("bin_depth"))
    return bins.filter(~side | (F.col("bin") == chosen)).select(
        "station_id", "bin", "mounting", F.coalesce(own, F.lit(0.0)).alias("depth"), own.isNull().alias("depth_unknown")
    )


def mounting_counts(df: DataFrame, mounting: str = "mounting") -> DataFrame:
    return df.groupBy(mounting_symbol(F.col(mounting)).alias("mounting")).agg(F.count(F.lit(1)).alias("n"))
