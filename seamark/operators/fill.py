"""Timeline alignment: bounded gap fill, regular grids, sampling interval."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seamark.functions.clock import epoch
from seamark.operators.sequence import CHUNK_SECONDS, group_median, scan, time_grid


def fill_linear(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    columns: str | Sequence[str],
    *,
    limit: int,
    edges: bool = False,
    tie: Sequence[str] = (),
    chunk_seconds: int = CHUNK_SECONDS,
) -> DataFrame:
    """Fill at most ``limit`` missing rows of each gap, by row position.

    Interpolates from the last valid row toward the next one; a trailing gap
    repeats the last value.  With ``edges`` one more row is filled forward and
    the last row of a gap takes the next valid value; a row both rules reach
    takes the forward value.  Several columns are filled in one pass, each on
    its own gaps.
    """
    names = [columns] if isinstance(columns, str) else list(columns)
    out = scan(
        df,
        keys,
        [ts, *tie],
        prior={f"__prev_{c}": F.col(c) for c in names},
        following={f"__next_{c}": F.col(c) for c in names},
        row_number="__pos",
        chunk_seconds=chunk_seconds,
    )
    pos = F.col("__pos")

    def filled(c: str) -> Column:
        value, prev, nxt = F.col(c), F.col(f"__prev_{c}"), F.col(f"__next_{c}")
        prev_rn, next_rn = F.col(f"__prev_{c}__rn"), F.col(f"__next_{c}__rn")
        k, gap = pos - prev_rn, next_rn - prev_rn

        def at(step: Column | int) -> Column:
            return F.when(nxt.isNull(), prev).otherwise(prev + (nxt - prev) * step / gap)

        new = F.when(value.isNotNull(), value).when(k <= limit, at(k))
        if edges:
            new = new.when(k == limit + 1, at(limit)).when(next_rn == pos + 1, nxt)
        return new

    return out.withColumns({c: filled(c) for c in names}).select(*df.columns)


def fill_cubic(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    column: str,
    *,
    limit: int,
    chunk_seconds: int = CHUNK_SECONDS,
) -> DataFrame:
    """As ``fill_linear``, along a local cubic through four valid neighbours.

    Inside a gap the curve runs from the last to the next valid value with
    slopes taken from the valid values on either side of both, by row position;
    at the ends of a series the chord slope is used.
    """
    v = F.col(column)
    one = scan(
        df,
        keys,
        [ts],
        prior={"__pv": v},
        following={"__nv": v},
        row_number="__pos",
        chunk_seconds=chunk_seconds,
    )
    # A valid row together with the valid rows before and after it.
    knot = F.when(
        v.isNotNull(),
        F.struct(
            v.alias("v"),
            F.col("__pos").alias("x"),
            F.col("__pv").alias("pv"),
            F.col("__pv__rn").alias("px"),
            F.col("__nv").alias("nv"),
            F.col("__nv__rn").alias("nx"),
        ),
    )
    two = scan(
        one, keys, [ts], prior={"__a": knot}, following={"__b": knot}, chunk_seconds=chunk_seconds
    )
    a, b = F.col("__a"), F.col("__b")
    gap = b["x"] - a["x"]
    k = F.col("__pos") - a["x"]
    chord = b["v"] - a["v"]
    h0, h2 = a["x"] - a["px"], b["nx"] - b["x"]
    # Three-point slopes on uneven spacing, times the gap.
    start = F.coalesce(((a["v"] - a["pv"]) / h0 * gap + chord / gap * h0) / (h0 + gap) * gap, chord)
    stop = F.coalesce((chord / gap * h2 + (b["nv"] - b["v"]) / h2 * gap) / (gap + h2) * gap, chord)
    t = k / gap
    curve = (
        a["v"] * (2 * t * t * t - 3 * t * t + 1)
        + start * (t * t * t - 2 * t * t + t)
        + b["v"] * (3 * t * t - 2 * t * t * t)
        + stop * (t * t * t - t * t)
    )
    filled = F.when(v.isNotNull(), v).when(k <= limit, curve)
    return two.withColumn(column, filled).select(*df.columns)


KNOTS, KNOT_HALO = 2000, 32


def spline_moments(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Second derivatives at the knots of the cubic spline without kinks of the third
    derivative at the second and last but one knot; of three knots the parabola's, of two none."""
    n = len(x)
    if n < 4:
        return np.full(n, 0.0 if n < 3 else 2 * np.diff(np.diff(y) / np.diff(x))[0] / (x[2] - x[0]))
    h = np.diff(x)
    right = 6 * np.diff(np.diff(y) / h)
    sub, diagonal, above = h[:-1].copy(), 2 * (h[:-1] + h[1:]), h[1:].copy()
    diagonal[0] += h[0] * (h[0] + h[1]) / h[1]
    above[0] -= h[0] ** 2 / h[1]
    diagonal[-1] += h[-1] * (h[-1] + h[-2]) / h[-2]
    sub[-1] -= h[-1] ** 2 / h[-2]
    for i in range(1, n - 2):
        w = sub[i] / diagonal[i - 1]
        diagonal[i] -= w * above[i - 1]
        right[i] -= w * right[i - 1]
    m = np.zeros(n)
    m[n - 2] = right[-1] / diagonal[-1]
    for i in range(n - 4, -1, -1):
        m[i + 1] = (right[i] - above[i] * m[i + 2]) / diagonal[i]
    m[0] = ((h[0] + h[1]) * m[1] - h[0] * m[2]) / h[1]
    m[-1] = ((h[-1] + h[-2]) * m[-2] - h[-1] * m[-3]) / h[-2]
    return m


def spline_at(x: np.ndarray, y: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Values of the spline at places between the first and the last knot, NaN outside."""
    out = np.full(len(at), np.nan)
    if len(x) < 2:
        return out
    m = spline_moments(x, y)
    between = (at > x[0]) & (at < x[-1])
    p = at[between]
    j = np.searchsorted(x, p, "right") - 1
    h, a, b = x[j + 1] - x[j], x[j + 1] - p, p - x[j]
    out[between] = (m[j] * a**3 + m[j + 1] * b**3) / (6 * h) + (y[j] / h - m[j] * h / 6) * a + (y[j + 1] / h - m[j + 1] * h / 6) * b
    return out


def fill_spline(
    df: DataFrame, keys: Sequence[str], ts: str, column: str, *, limit: int, step_seconds: int, chunk_seconds: int = CHUNK_SECONDS
) -> DataFrame:
    """Cubic spline through all valid values of a series, at most ``limit`` steps into a gap.

    Knots are ranked and solved in groups of ``KNOTS`` with ``KNOT_HALO`` more on either side: a
    knot's influence falls to a quarter from knot to knot, so what lies beyond is lost in
    rounding.  Missing rows go to the group of the knot before them.
    """
    valid = F.col(column).isNotNull()
    x = epoch(F.col(ts)) / step_seconds
    marked = scan(
        df.select(*keys, ts, column),
        keys,
        [ts],
        totals={"__r": valid.cast("bigint")},
        prior={"__last": F.when(valid, x)},
        chunk_seconds=chunk_seconds,
    )
    wanted = F.col(column).isNull() & (F.col("__r") > 0) & (x - F.col("__last") <= limit)
    wanted = F.coalesce(wanted, F.lit(False))

    def group(rank: Column) -> Column:
        return F.floor((rank - 1) / KNOTS)

    first = F.greatest(group(F.col("__r") - KNOT_HALO), F.lit(0).cast("bigint"))
    groups = F.when(valid, F.sequence(first, group(F.col("__r") + KNOT_HALO))).otherwise(F.array(group(F.col("__r"))))
    rows = marked.filter(valid | wanted).select(*keys, ts, F.col(column).cast("double").alias(column), x.cast("double").alias("__x"), F.explode(groups).alias("__g"))
    kept = [*keys, ts, column]
    schema = T.StructType([rows.schema[c] for c in kept])

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("__x")
        knots, gaps = pdf[pdf[column].notna()], pdf[pdf[column].isna()]
        value = spline_at(knots["__x"].to_numpy(), knots[column].to_numpy(), gaps["__x"].to_numpy())
        return gaps[kept].assign(**{column: value})

    filled = rows.groupBy(*keys, "__g").applyInPandas(solve, schema)
    filled = filled.withColumn(column, F.when(~F.isnan(column), F.col(column)))
    return marked.filter(~wanted).select(*kept).unionByName(filled).select(*df.columns)


def merged_timeline(
    obs: DataFrame, model: DataFrame, keys: Sequence[str], ts: str, columns: str | Sequence[str]
) -> DataFrame:
    """Observations on the union of both time axes.

    A row stays when its time occurs once or its first value column is present.
    """
    names = [columns] if isinstance(columns, str) else list(columns)
    empty = [F.lit(None).cast("double").alias(c) for c in names]
    both = obs.select(*keys, ts, *[F.col(c).cast("double").alias(c) for c in names]).unionByName(
        model.select(*keys, ts, *empty)
    )
    lone = (
        both.groupBy(*keys, ts)
        .agg(
            F.count(F.lit(1)).alias("__n"),
            F.count(names[0]).alias("__valid"),
            *[F.any_value(c, True).alias(c) for c in names],
        )
        .filter("__n = 1 AND __valid = 0")
        .select(*keys, ts, *names)
    )
    return both.filter(F.col(names[0]).isNotNull()).unionByName(lone)


def regular_grid(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    columns: Sequence[str],
    *,
    step_seconds: int,
    chunk_seconds: int = CHUNK_SECONDS,
) -> DataFrame:
    """Reindex to every step between the first and last time; new rows are NULL."""
    grid = time_grid(df, keys, ts, step_seconds, chunk_seconds)
    return grid.join(df.select(*keys, ts, *columns), [*keys, ts], "left")


def to_equal_interval(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    column: str,
    *,
    step_seconds: int = 360,
    max_gap_hours: float = 6.0,
    method: str = "spline",
    chunk_seconds: int = CHUNK_SECONDS,
) -> DataFrame:
    """Regular grid from the first to the last time with a fill of at most ``max_gap_hours`` a gap.

    Longer gaps are filled up to the limit and NULL beyond it.  ``method`` is 'spline' (cubic,
    over the whole series), 'linear' or 'cubic' (local, through four valid neighbours).
    Only 'linear' goes on past the last valid value.
    """
    grid = regular_grid(
        df, keys, ts, [column], step_seconds=step_seconds, chunk_seconds=chunk_seconds
    )
    limit = int(max_gap_hours * 3600 / step_seconds)
    if method == "spline":
        return fill_spline(grid, keys, ts, column, limit=limit, step_seconds=step_seconds, chunk_seconds=chunk_seconds)
    fill = {"linear": fill_linear, "cubic": fill_cubic}[method]
    return fill(grid, keys, ts, column, limit=limit, chunk_seconds=chunk_seconds)


def with_previous_time(
    df: DataFrame, keys: Sequence[str], ts: str, tie: Sequence[str] = ()
) -> DataFrame:
    """(keys, ts, prev_ts); prev_ts is NULL on the first row of a series."""
    times = df.select(*keys, ts, *tie)
    return scan(times, keys, [ts, *tie], prior={"prev_ts": F.col(ts)}).drop("prev_ts__rn")


def time_gaps(
    df: DataFrame, keys: Sequence[str], ts: str, step_seconds: int
) -> DataFrame:
    """Places where the step differs from the expected one."""
    out = with_previous_time(df, keys, ts)
    width = epoch(F.col(ts)) - epoch(F.col("prev_ts"))
    return out.filter(width != step_seconds).select(
        *keys, F.col("prev_ts").alias("gap_start"), F.col(ts).alias("gap_end"), width.alias("seconds")
    )


def median_interval(
    df: DataFrame, keys: Sequence[str], ts: str, tie: Sequence[str] = ()
) -> DataFrame:
    """Exact median sampling interval in hours per series."""
    out = with_previous_time(df, keys, ts, tie)
    steps = out.select(*keys, (epoch(F.col(ts)) - epoch(F.col("prev_ts"))).alias("__step"))
    return group_median(steps, keys, "__step", "dt_hours").withColumn("dt_hours", F.col("dt_hours") / 3600)
