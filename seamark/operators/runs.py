"""Runs of rows and of intervals.

The length of a run at a row is its distance to the last row outside the run.
``run_states`` folds rows to a state per time chunk and the states along the
series.  Whole islands are rows that share the difference of two running totals
(all rows, flagged rows), which ``scan`` supplies without ordering a whole
series in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seamark.functions.clock import epoch
from seamark.operators.sequence import CHUNK_SECONDS, chunk_of, scan
from seamark.session import dealt

# Chunk of rows without a time, before every other.
BEFORE_TIME = -(1 << 40)


def islands(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    flag: Column,
    *,
    chunk_seconds: int = CHUNK_SECONDS,
    chunk: Column | None = None,
) -> DataFrame:
    """One row per maximal run of flagged rows.

    Gives ``first_<t>``, ``last_<t>`` (t = the time column), ``next_<t>`` (first
    row after the run, NULL at the end) and ``n_rows``.
    """
    t = order[0]
    marked = scan(
        df.select(*keys, *order, F.coalesce(flag, F.lit(False)).cast("int").alias("__flag")),
        keys,
        order,
        totals={"__hits": F.col("__flag")},
        following={"__next": F.col(t)},
        row_number="__pos",
        chunk_seconds=chunk_seconds,
        chunk=chunk,
    )
    return (
        marked.filter("__flag = 1")
        .groupBy(*keys, (F.col("__pos") - F.col("__hits")).alias("__island"))
        .agg(
            F.min(t).alias(f"first_{t}"),
            F.max(t).alias(f"last_{t}"),
            F.max_by(F.struct("__next"), "__pos").alias("__nx"),
            F.count(F.lit(1)).alias("n_rows"),
        )
        .withColumn(f"next_{t}", F.col("__nx")["__next"])
        .drop("__nx", "__island")
    )


def run_states(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    flags: dict[str, Column],
    partials: dict[str, Column] | None = None,
    *,
    steps: bool = True,
    chunk_seconds: int = CHUNK_SECONDS,
) -> DataFrame:
    """Run lengths, sampling steps and any partial aggregates in one pass over the rows.

    Rows are dealt to time chunks once.  Inside a chunk they become one row per step (time
    since the previous row of the chunk, NULL on its first row), which holds the row count
    ``__n``, the partial aggregates and the run state: longest run, first and last row
    without the flag.  Steps are whole seconds, so a chunk of c seconds holds at most
    sqrt(2 c) + 2 different ones (2,279 for 30 days), commonly one or two.  Only these
    rows are ordered along the series, which yields runs across borders and border steps.
    Finish with ``groupBy(keys)`` and ``folded(flags)`` beside merges of the partials.

    Without ``steps`` a chunk is one row and no interval comes out.  Tasks keep the number of shuffle
    partitions: aggregates of irregular steps are many times the rows that AQE would merge them by.

    Rows without a time form a chunk before all others and have no step.
    """
    keys, order, partials = list(keys), list(order), partials or {}
    names = list(flags)
    rows = df.select(
        *(["*"] if partials else [*keys, *order]),
        F.coalesce(chunk_of(F.col(order[0]), chunk_seconds), F.lit(BEFORE_TIME)).alias("__chunk"),
        epoch(F.col(order[0])).alias("__sec"),
        *[F.coalesce(f, F.lit(False)).alias(f"__hit_{n}") for n, f in flags.items()],
    )
    rows = dealt(rows, [*keys, "__chunk"])
    along = Window.partitionBy(*keys, "__chunk").orderBy(*order)
    step = F.col("__sec") - F.lag("__sec").over(along) if steps else F.lit(None).cast("bigint")
    rows = rows.withColumns({"__rn": F.row_number().over(along), "__step": step})
    miss = {n: F.when(~F.col(f"__hit_{n}"), F.col("__rn")) for n in names}
    upto = along.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({f"__run_{n}": F.col("__rn") - F.coalesce(F.max(miss[n]).over(upto), F.lit(0)) for n in names})
    local = rows.groupBy(*keys, "__chunk", *(["__step"] if steps else [])).agg(
        F.count(F.lit(1)).alias("__n"),
        F.max("__sec").alias("__end"),
        F.min("__sec").alias("__start"),
        *[c.alias(n) for n, c in partials.items()],
        *[F.max(f"__run_{n}").alias(f"__best_{n}") for n in names],
        *[F.min(miss[n]).alias(f"__first_{n}") for n in names],
        *[F.max(miss[n]).alias(f"__last_{n}") for n in names],
    )
    # From here on a series is a few rows a chunk, in one place.
    here = Window.partitionBy(*keys, "__chunk")
    past = Window.partitionBy(*keys).orderBy("__chunk").rangeBetween(Window.unboundedPreceding, -1)
    states = local.repartition(*keys).withColumns(
        {
            "__off": F.coalesce(F.sum("__n").over(past), F.lit(0)),
            "__rows": F.sum("__n").over(here),
            **({"__step": F.coalesce("__step", F.min("__start").over(here) - F.max("__end").over(past))} if steps else {}),
            **{f"__first_{n}": F.min(f"__first_{n}").over(here) for n in names},
        }
    )
    back = {n: F.coalesce(F.max(F.col("__off") + F.col(f"__last_{n}")).over(past), F.lit(0)) for n in names}
    # The run that enters a chunk ends before its first row without the flag.
    entering = {n: F.col("__off") + F.coalesce(F.col(f"__first_{n}") - 1, F.col("__rows")) - back[n] for n in names}
    states = states.withColumns({n: F.greatest(f"__best_{n}", entering[n]) for n in names})
    # The row of a chunk without a step inside is its first row alone: it takes the border step.
    return states.select(*keys, "__n", *(["__step"] if steps else []), *partials, *names)


def folded(flags: Sequence[str]) -> list[Column]:
    """Aggregates over ``run_states``: longest run of each flag, and ``step_seconds``, the
    median time between neighbouring rows (NULL for a single row).

    The median counts by step: whole seconds, so at most sqrt(2 s) + 2 entries for a series
    of s seconds, 80,000 for a century."""
    median = F.percentile("__step", F.lit(0.5), F.col("__n")).alias("step_seconds")
    return [*[F.max(n).cast("bigint").alias(n) for n in flags], median]


def longest_runs(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], flags: dict[str, Column], *, chunk_seconds: int = CHUNK_SECONDS
) -> DataFrame:
    """Rows in the longest run of each flag, per series."""
    states = run_states(df, keys, order, flags, steps=False, chunk_seconds=chunk_seconds)
    return states.groupBy(*keys).agg(*[F.max(n).cast("bigint").alias(n) for n in flags])


def outlier_flags(error: Column, x1: Column) -> dict[str, Column]:
    return {"max_pos_rows": error >= 2 * x1, "max_neg_rows": error <= -2 * x1}


def in_hours() -> dict[str, Column]:
    """The longest outlier runs in hours: rows times the median sampling interval."""
    hours = F.col("step_seconds") / 3600
    return {f"max_{d}_hours": F.col(f"max_{d}_rows") * hours for d in ("pos", "neg")}


def outlier_durations(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    error: Column,
    x1: Column,
    *,
    tie: Sequence[str] = (),
    chunk_seconds: int = CHUNK_SECONDS,
) -> DataFrame:
    """Longest runs of e >= 2*x1 and e <= -2*x1, in rows and hours.

    Hours are rows times the median sampling interval of the whole series.
    """
    flags = outlier_flags(error, x1)
    states = run_states(df, keys, [ts, *tie], flags, chunk_seconds=chunk_seconds)
    return states.groupBy(*keys).agg(*folded(list(flags))).withColumns(in_hours()).drop("step_seconds")


def longest_gap(
    df: DataFrame, keys: Sequence[str], ts: str, value: Column, tie: Sequence[str] = ()
) -> DataFrame:
    """Longest run of missing rows: ``gap_pairs`` counts adjacent missing pairs
    (3 missing rows give 2), ``gap_rows`` the rows themselves."""
    runs = longest_runs(df, keys, [ts, *tie], {"gap_rows": value.isNull()})
    return runs.select(
        *keys, "gap_rows", F.greatest(F.col("gap_rows") - 1, F.lit(0)).alias("gap_pairs")
    )


def slack_water(
    df: DataFrame, keys: Sequence[str], *, ts: str = "ts", speed: str = "speed", limit: float = 0.5 * 0.514444
) -> DataFrame:
    """Slack events: runs below the limit, ended by the first row after the run."""
    runs = islands(df, keys, [ts], F.col(speed) < limit)
    end = F.coalesce(F.col(f"next_{ts}"), F.col(f"last_{ts}"))
    return runs.select(
        *keys,
        F.col(f"first_{ts}").alias("start_ts"),
        end.alias("end_ts"),
        ((epoch(end) - epoch(F.col(f"first_{ts}"))) / 3600).alias("hours"),
    )


def merge_intervals(
    df: DataFrame, keys: Sequence[str], start: str, end: str, *, far: str = "9999-12-31"
) -> DataFrame:
    """Union of overlapping or touching intervals per key; NULL end is open.

    Endpoints are turned into +1/-1 steps and the running sum of steps finds the
    covered stretches, so intervals of any length never need a whole-key order.
    """
    last = F.coalesce(F.col(end), F.to_timestamp(F.lit(far)))
    steps = (
        df.select(
            *keys,
            F.explode(
                F.array(
                    F.struct(F.col(start).cast("timestamp").alias("at"), F.lit(1).alias("step")),
                    F.struct(last.cast("timestamp").alias("at"), F.lit(-1).alias("step")),
                )
            ).alias("s"),
        )
        .groupBy(*keys, F.col("s.at").alias("at"))
        .agg(F.sum("s.step").alias("step"))
    )
    level = scan(steps, keys, ["at"], totals={"level": F.col("step")})
    opens = (F.col("level") > 0) & (F.col("level") - F.col("step") == 0)
    closes = (F.col("level") == 0) & (F.col("step") < 0)
    # Opening and closing times alternate, so a block ends at the next of them.
    marks = level.filter(opens | closes).select(*keys, "at", opens.alias("opens"))
    blocks = scan(marks, keys, ["at"], following={"until": F.col("at")}).filter("opens")
    return blocks.select(
        *keys,
        F.col("at").alias(start),
        F.when(F.col("until") < F.to_timestamp(F.lit(far)), F.col("until")).alias(end),
    )


def interval_gaps(
    merged: DataFrame, keys: Sequence[str], start: str, end: str, window_start: Column, window_end: Column
) -> DataFrame:
    """Uncovered stretches between merged intervals, clipped to a window."""
    nxt = scan(merged, keys, [start], following={"next_start": F.col(start)})
    lo = F.greatest(F.col(end), window_start)
    hi = F.least(F.col("next_start"), window_end)
    return nxt.filter(F.col(end).isNotNull() & F.col("next_start").isNotNull() & (lo < hi)).select(
        *keys, lo.alias("gap_start"), hi.alias("gap_end")
    )


def onset_and_thaw(
    daily: DataFrame, keys: Sequence[str], day: str, value: str, *, limit: float = 10.0, run: int = 5
) -> DataFrame:
    """Ice onset and thaw days per series of daily concentrations.

    Onset is the day completing the first ``run`` consecutive days at or above
    the limit.  Thaw is ``run`` rows after the last day at or above it, provided
    that many later rows exist and at most two rows from that day on are missing.
    """
    icy = F.coalesce(F.col(value) >= limit, F.lit(False))
    base = daily.select(*keys, day, F.col(value).alias("__v"), icy.alias("__ice"))
    pos = scan(
        base,
        keys,
        [day],
        totals={"__breaks": (~F.col("__ice")).cast("int"), "__gone": F.col("__v").isNull().cast("int")},
        row_number="__pos",
        chunk_seconds=366 * 86400,
    )
    # Rows of a run are contiguous, so the run-th row is first position + run - 1.
    firsts = (
        pos.filter("__ice")
        .groupBy(*keys, "__breaks")
        .agg(F.min("__pos").alias("first_pos"), F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= run)
        .groupBy(*keys)
        .agg((F.min("first_pos") + run - 1).alias("onset_pos"))
    )
    lasts = pos.groupBy(*keys).agg(
        F.max("__pos").alias("n_rows"),
        F.max("__gone").alias("gone_all"),
        F.max_by(
            F.struct("__pos", "__gone"), F.when(F.col("__ice"), F.col("__pos"))
        ).alias("last_ice"),
    )
    later = F.col("n_rows") - F.col("last_ice")["__pos"]
    missing = F.col("gone_all") - F.col("last_ice")["__gone"]
    marks = lasts.join(firsts, list(keys), "left").select(
        *keys,
        "onset_pos",
        F.when((later >= run) & (missing <= 2), F.col("last_ice")["__pos"] + run).alias("thaw_pos"),
    )
    days = pos.select(*keys, "__pos", F.col(day).alias("__day"))
    return (
        marks.join(days, list(keys))
        .groupBy(*keys)
        .agg(
            F.min(F.when(F.col("__pos") == F.col("onset_pos"), F.col("__day"))).alias("onset"),
            F.min(F.when(F.col("__pos") == F.col("thaw_pos"), F.col("__day"))).alias("thaw"),
        )
    )
