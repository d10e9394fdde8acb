"""Model output: file manifests, run concatenation, station text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seamark.functions.clock import nearest_minute, valid_time_of_file
from seamark.operators.sequence import keep_first

NO_DATA_BELOW = -100000


def parse_names(files: DataFrame, name: str = "name") -> DataFrame:
    """Day, cycle, kind and hour of model files from their names."""
    n = F.col(name)

    def grab(pattern: str, i: int = 1) -> Column:
        return F.nullif(F.regexp_extract(n, pattern, i), F.lit(""))

    kind = grab(r"\.(fields|stations)\.")
    return files.select(
        "*",
        kind.alias("kind"),
        F.when(n.rlike(r"\.hindcast\."), "h").otherwise(grab(r"\.(fields|stations)\.(nowcast|forecast|[nf])", 2)).alias("run"),
        F.when(kind == "stations", F.lit("999")).otherwise(grab(r"\.[nf](\d{3})\.")).alias("hour"),
        grab(r"\.t(\d{2})z\.").alias("cycle"),
        F.try_to_timestamp(grab(r"\.(\d{8})\."), F.lit("yyyyMMdd")).cast("date").alias("day"),
    )


def ordered_files(
    files: DataFrame, *, kind: str, start: Column, end: Column, seq: str, extra_days: int = 0
) -> DataFrame:
    """Files of one kind in the window: hour 000 skipped, one per (hour, cycle,
    day), numbered in day, cycle, hour order."""
    used = parse_names(files).filter(
        (F.col("kind") == kind)
        & F.col("run").startswith("n")
        & F.col("day").between(start, F.date_add(end, extra_days))
        & (F.col("hour") != "000")
    )
    one = keep_first(used, ["hour", "cycle", "day"], [seq])
    return one.withColumn("sort_key", F.struct("day", "cycle", "hour"))


def date_window(
    requests: DataFrame, rules: DataFrame, *, system: str = "system", cast: str = "cast"
) -> DataFrame:
    """One row per day of each request.

    ``rules`` holds (system, cast, ahead, behind) for systems that look past the
    window; others use the window itself.
    """
    both = requests.join(rules, [system, cast], "left")
    first = F.date_sub("start_day", F.coalesce("behind", F.lit(0)))
    last = F.date_add("end_day", F.coalesce("ahead", F.lit(0)))
    return both.select(*requests.columns, F.explode(F.sequence(first, last)).alias("day"))


def expected_names(days: DataFrame, layouts: DataFrame, *, system: str = "system") -> DataFrame:
    """Expected file names from (system, kind, run, cycles ARRAY<INT>, last_hour)."""
    return (
        days.join(layouts, system)
        .withColumn("cycle", F.explode("cycles"))
        .withColumn("hour", F.explode(F.sequence(F.lit(1), F.col("last_hour"))))
        .select(
            system,
            "day",
            F.format_string(
                "%s.t%02dz.%s.%s.%s%03d.nc", F.col(system), "cycle", F.date_format("day", "yyyyMMdd"), "kind", "run", "hour"
            ).alias("name"),
        )
    )


def missing_files(expected: DataFrame, present: DataFrame, name: str = "name") -> DataFrame:
    return expected.join(present.select(name).distinct(), name, "left_anti")


def concat_runs(
    df: DataFrame, keys: Sequence[str], *, cast: str, file_order: str, ts: str = "ts", stations: bool = True
) -> DataFrame:
    """Runs joined along time: times to the nearest minute, overlaps resolved.

    Station files keep the last file's value for a repeated time, except in
    forecast_a where the first stays; field files keep every row.
    """
    out = df.withColumn(ts, nearest_minute(F.col(ts)))
    if not stations:
        return out
    return keep_first(out, [*keys, ts], [file_order], last=cast != "forecast_a")


def common_stations(df: DataFrame, *, file: str = "file", lat: str = "lat", lon: str = "lon", digits: int = 5) -> DataFrame:
    """Rows of stations that the file with the fewest stations also has."""
    spot = F.struct(F.round(lat, digits), F.round(lon, digits))
    at = df.withColumn("__spot", spot)
    per_file = at.select(file, "__spot").distinct()
    smallest = per_file.groupBy(file).agg(F.count(F.lit(1)).alias("n")).agg(
        F.min_by(file, F.struct("n", file)).alias(file)
    )
    wanted = per_file.join(smallest, file, "left_semi").select("__spot")
    return at.join(wanted, "__spot", "left_semi").drop("__spot")


def cast_window(
    df: DataFrame, *, cast: str, run: str, order: str, keys: Sequence[str] = (), steps_per_hour: int, forecast_hours: int, cycles_per_day: int
) -> DataFrame:
    """Rows of one cast from runs that hold nowcast and forecast end to end.

    Positions count within a run: the first 24 / cycles hours are the nowcast,
    the next as many are forecast_b, the whole rest is forecast_a.  A run is
    bounded by its forecast length.
    """
    n = 24 // cycles_per_day * steps_per_hour
    lo, hi = {
        "nowcast": (1, n),
        "forecast_b": (n + 1, 2 * n),
        "forecast_a": (n + 1, n + forecast_hours * steps_per_hour),
    }[cast]
    w = Window.partitionBy(run, *keys).orderBy(order)
    return df.withColumn("__pos", F.row_number().over(w)).filter(F.col("__pos").between(lo, hi)).drop("__pos")


def profile_lines(lines: DataFrame, stations: int, *, keep: tuple[str, ...] = ("file",)) -> DataFrame:
    """Station text output with alternating surface and profile lines.

    Gives (keep, step, station, layer, value, z): a profile line holds the time,
    then values of every layer of every station, then their depths.
    """
    v = F.transform(F.filter(F.split(F.trim("value"), r"\s+"), lambda s: s != ""), lambda s: s.try_cast("double"))
    rows = lines.filter("line_no % 2 = 1").select(
        *keep, ((F.col("line_no") - 1) / 2).cast("int").alias("step"), v.alias("a")
    )
    half = ((F.size("a") - 1) / 2).cast("int")
    cut = rows.select(
        *keep,
        "step",
        (half / stations).cast("int").alias("layers"),
        F.posexplode(F.arrays_zip(F.slice("a", F.lit(2), half), F.slice("a", half + 2, half))).alias("pos", "p"),
    )

    def clean(c: str) -> Column:
        return F.when(F.col(c) >= NO_DATA_BELOW, F.col(c))

    return cut.select(
        *keep,
        "step",
        F.floor(F.col("pos") / F.col("layers")).cast("int").alias("station"),
        (F.col("pos") % F.col("layers")).alias("layer"),
        clean("p.0").alias("value"),
        clean("p.1").alias("z"),
    )


def surface_lines(lines: DataFrame, base: Column, *, keep: tuple[str, ...] = ("file",), alternating: bool = False) -> DataFrame:
    """One value per station and line, time = base + seconds in the first token."""
    v = F.transform(F.filter(F.split(F.trim("value"), r"\s+"), lambda s: s != ""), lambda s: s.try_cast("double"))
    rows = lines.filter("line_no % 2 = 0") if alternating else lines
    rows = rows.select(*keep, v.alias("a"), base.alias("__base")).filter(F.size("a") > 1)
    return rows.select(
        *keep,
        F.timestamp_seconds(F.unix_seconds("__base") + F.element_at("a", 1).cast("bigint")).alias("ts"),
        F.posexplode(F.slice("a", F.lit(2), F.size("a") - 1)).alias("station", "v"),
    ).select(*keep, "ts", "station", F.when(F.col("v") >= NO_DATA_BELOW, F.col("v")).alias("value"))


def majority_size(files: DataFrame, keys: Sequence[str], size: str = "length") -> DataFrame:
    """Files whose size is the most common one of their group (smallest on a tie)."""
    counts = files.groupBy(*keys, size).agg(F.count(F.lit(1)).alias("n"))
    modal = counts.groupBy(*keys).agg(F.min_by(size, F.struct(-F.col("n"), F.col(size))).alias(size))
    return files.join(modal, [*keys, size], "left_semi").select(*files.columns)


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, modificationTime) of files, without reading them."""
    return spark.read.format("binaryFile").load(path).select("path", "length", "modificationTime")


def latest_cycle(files: DataFrame, *, system: str = "system", cycle: str = "cycle", modified: str = "modified") -> DataFrame:
    return files.groupBy(system).agg(F.max_by(cycle, modified).alias(cycle), F.max(modified).alias(modified))


def daily_snapshot(files: DataFrame, *, cycle: str, hour: str, name: str = "name") -> DataFrame:
    """The file of a fixed cycle and hour of each day, with its valid time."""
    return (
        parse_names(files, name)
        .filter((F.col("cycle") == cycle) & (F.col("hour") == hour))
        .withColumn("ts", valid_time_of_file(F.col(name)))
    )
