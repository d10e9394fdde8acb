"""Text outputs: series lines, ASCII grids, grid JSON."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seamark.functions import angles, clock
from seamark.functions.rounding import fixed
from seamark.sources.series_text import sentinel_mask

NODATA = -9999


def _number(v: Column, width: int = 9, decimals: int = 4) -> Column:
    text = F.coalesce(fixed(v, decimals), F.lit("nan"))
    return F.concat(F.repeat(F.lit(" "), F.lit(width) - F.length(text)), text)


def series_lines(df: DataFrame, keys: Sequence[str], values: Sequence[str] = ("value",), ts: str = "ts") -> DataFrame:
    """Fixed-width lines: julian day, calendar parts, values."""
    t = F.col(ts)
    head = F.format_string(
        "%13.8f %4d %2d %2d %2d %2d",
        clock.julian_day(t),
        F.year(t),
        F.month(t),
        F.dayofmonth(t),
        F.hour(t),
        F.minute(t),
    )
    body = [_number(sentinel_mask(F.col(c))) for c in values]
    return df.select(*keys, ts, F.concat_ws(" ", head, *body).alias("line"))


def vector_lines(df: DataFrame, keys: Sequence[str], speed: str = "speed", direction: str = "dir_deg", ts: str = "ts") -> DataFrame:
    """As ``series_lines`` with speed, direction, u and v."""
    s, d = sentinel_mask(F.col(speed)), sentinel_mask(F.col(direction))
    full = df.select(
        *keys, ts, s.alias("speed"), d.alias("dir_deg"), angles.east(s, d).alias("u"), angles.north(s, d).alias("v")
    )
    return series_lines(full, keys, ["speed", "dir_deg", "u", "v"], ts)


def write_lines(lines: DataFrame, path: str, partition: Sequence[str], order: str = "ts") -> None:
    """One directory per series, lines in time order within its files.

    Range partitioning on (series, time) spreads a long series over several
    files whose order is its time order.
    """
    keys = [F.col(c) for c in partition]
    (
        lines.repartitionByRange(*keys, F.col(order))
        .sortWithinPartitions(*partition, order)
        .select(*partition, F.col("line").alias("value"))
        .write.mode("overwrite")
        .partitionBy(*partition)
        .text(path)
    )


def short_number(v: Column) -> Column:
    """Six significant digits without trailing zeros."""
    scale = F.pow(F.lit(10.0), 5 - F.floor(F.log10(F.abs(v))))
    sig = F.when(v == 0, F.lit(0.0)).otherwise(F.rint(v * scale) / scale)
    plain = F.regexp_replace(sig.cast("decimal(30,12)").cast("string"), r"\.?0+$", "")
    return F.when(F.abs(v) < 1, F.coalesce(F.nullif(plain, F.lit("")), F.lit("0"))).otherwise(
        F.when(sig == F.rint(sig), F.format_string("%.0f", sig)).otherwise(plain)
    )


def ascii_rows(
    grid: DataFrame, keys: Sequence[str], *, lat: str = "lat", lon: str = "lon", value: str = "value", nodata: float = NODATA
) -> DataFrame:
    """Data rows north to south, west to east: (keys, row, line).

    A row holds as many cells as the grid is wide.
    """
    v = F.coalesce(F.col(value), F.lit(float(nodata)))
    cells = F.array_sort(F.collect_list(F.struct(F.col(lon).alias("x"), short_number(v).alias("s"))))
    rows = grid.groupBy(*keys, lat).agg(cells.alias("c"))
    return rows.select(
        *keys, F.col(lat).alias("row_lat"), F.array_join(F.transform("c", lambda s: s["s"]), " ").alias("line")
    )


def ascii_header(
    grid: DataFrame, keys: Sequence[str], *, lat: str = "lat", lon: str = "lon", nodata: int = NODATA
) -> DataFrame:
    """Header fields of each grid; ``cellsize`` only when cells are square."""
    g = grid.groupBy(*keys).agg(
        F.count_distinct(lon).alias("ncols"),
        F.count_distinct(lat).alias("nrows"),
        F.min(lon).alias("x0"),
        F.max(lon).alias("x1"),
        F.min(lat).alias("y0"),
        F.max(lat).alias("y1"),
    )

    def step(lo: str, hi: str, n: str) -> Column:
        return F.coalesce(F.try_divide(F.col(hi) - F.col(lo), F.when(F.col(n) > 1, F.col(n) - 1)), F.lit(0.0))

    g = g.withColumn("dx", step("x0", "x1", "ncols")).withColumn("dy", step("y0", "y1", "nrows"))
    square = F.abs(F.col("dx") - F.col("dy")) <= 1e-9 * F.greatest("dx", "dy", F.lit(1.0))
    return g.select(
        *keys,
        "ncols",
        "nrows",
        (F.col("x0") - F.col("dx") / 2).alias("xllcorner"),
        (F.col("y0") - F.col("dy") / 2).alias("yllcorner"),
        F.when(square, F.col("dx")).alias("cellsize"),
        F.when(~square, F.col("dx")).alias("dx"),
        F.when(~square, F.col("dy")).alias("dy"),
        F.lit(nodata).alias("nodata_value"),
    )


def header_lines(header: DataFrame, keys: Sequence[str]) -> DataFrame:
    def line(label: str, c: str, fmt: str) -> Column:
        return F.when(F.col(c).isNotNull(), F.concat(F.lit(label.ljust(13)), F.format_string(fmt, F.col(c))))

    parts = F.array(
        line("ncols", "ncols", "%d"),
        line("nrows", "nrows", "%d"),
        line("xllcorner", "xllcorner", "%.12f"),
        line("yllcorner", "yllcorner", "%.12f"),
        line("cellsize", "cellsize", "%.12f"),
        line("dx", "dx", "%.12f"),
        line("dy", "dy", "%.12f"),
        line("NODATA_value", "nodata_value", "%d"),
    )
    return header.select(*keys, F.posexplode(F.filter(parts, lambda s: s.isNotNull())).alias("n", "line"))


def write_ascii(grid: DataFrame, path: str, keys: Sequence[str], **names) -> None:
    """Header and data rows of every grid, one directory per grid."""
    head = header_lines(ascii_header(grid, keys, **{k: v for k, v in names.items() if k != "value"}), keys)
    body = ascii_rows(grid, keys, **names)
    both = head.select(*keys, F.lit(0).alias("part"), F.col("n").cast("double").alias("pos"), "line").unionByName(
        body.select(*keys, F.lit(1).alias("part"), (-F.col("row_lat")).alias("pos"), "line")
    )
    (
        both.repartition(*keys)
        .sortWithinPartitions(*keys, "part", "pos")
        .select(*keys, F.col("line").alias("value"))
        .write.mode("overwrite")
        .partitionBy(*keys)
        .text(path)
    )


def grid_json(
    grid: DataFrame, keys: Sequence[str] = ("source", "ts"), value: str = "value", *, band_rows: int | None = None
) -> DataFrame:
    """One JSON text per frame with 2-D arrays lats, lons, values (missing = null).

    A frame too large for one text is cut into bands of ``band_rows`` grid rows, with the number
    of the ``band`` as a further key.
    """
    on = list(keys)
    if band_rows is not None:
        grid = grid.withColumn("band", F.floor(F.col("iy") / band_rows))
        on.append("band")
    cell = F.struct("ix", "lat", "lon", F.col(value).alias("v"))
    rows = grid.groupBy(*on, "iy").agg(F.array_sort(F.collect_list(cell)).alias("c"))
    row = F.struct(
        F.col("iy"), F.col("c.lat").alias("lats"), F.col("c.lon").alias("lons"), F.col("c.v").alias("vals")
    )
    frames = rows.groupBy(*on).agg(F.array_sort(F.collect_list(row)).alias("r"))
    text = F.to_json(
        F.struct(F.col("r.lats").alias("lats"), F.col("r.lons").alias("lons"), F.col("r.vals").alias("values")),
        {"ignoreNullFields": "false"},
    )
    return frames.select(*on, text.alias("json"))
