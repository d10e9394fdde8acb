"""High and low waters, current extrema, and one-to-one event pairing."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seamark.functions.clock import epoch
from seamark.operators.sequence import CHUNK_SECONDS, halo
from seamark.session import cut_lineage


def water_level_extrema(
    df: DataFrame,
    keys: Sequence[str],
    *,
    ts: str = "ts",
    value: str = "value",
    step_seconds: int,
    separation_hours: float = 4.0,
    chunk_seconds: int = CHUNK_SECONDS,
) -> DataFrame:
    """Strict local maxima (``high``) and minima (``low``) of a regular series.

    A row qualifies when it beats every row within +-order samples, order =
    max(1, int(separation / step)).  Missing values in that window disqualify;
    the first and the last row have nothing to beat on one side and never
    qualify.  Border rows are copied to the neighbouring chunk, so no task holds
    a whole series.
    """
    order = max(1, int(separation_hours * 3600 / step_seconds))
    reach = order * step_seconds
    wide, chunk, home = halo(df, ts, before=reach, after=reach, chunk_seconds=chunk_seconds)
    wide = wide.withColumn("__s", epoch(F.col(ts)))
    w = Window.partitionBy(*keys, chunk).orderBy("__s")
    past, future = w.rangeBetween(-reach, -1), w.rangeBetween(1, reach)
    near = w.rangeBetween(-reach, reach)
    v = F.col(value)
    marked = wide.select(
        "*",
        F.max(v).over(past).alias("__pmax"),
        F.max(v).over(future).alias("__fmax"),
        F.min(v).over(past).alias("__pmin"),
        F.min(v).over(future).alias("__fmin"),
        (F.count(F.lit(1)).over(near) - F.count(v).over(near)).alias("__missing"),
    ).filter(home & (F.col("__missing") == 0))
    kind = F.when((v > F.col("__pmax")) & (v > F.col("__fmax")), "high").when(
        (v < F.col("__pmin")) & (v < F.col("__fmin")), "low"
    )
    return (
        marked.withColumn("kind", kind)
        .filter("kind IS NOT NULL")
        .select(*keys, ts, value, "kind")
    )


def principal_direction(df: DataFrame, keys: Sequence[str], u: str = "u", v: str = "v") -> DataFrame:
    """Compass direction of the major axis of (u, v), in [0, 180)."""
    ok = F.col(u).isNotNull() & F.col(v).isNotNull()
    angle = 0.5 * F.degrees(
        F.atan2(2 * F.covar_samp(u, v), F.var_samp(v) - F.var_samp(u))
    )
    return df.filter(ok).groupBy(*keys).agg(F.pmod(angle, F.lit(180.0)).alias("principal_dir"))


def current_extrema(
    df: DataFrame,
    keys: Sequence[str],
    *,
    ts: str = "ts",
    speed: str = "speed",
    direction: str = "direction",
    principal: DataFrame,
    step_seconds: int,
    separation_hours: float = 4.0,
) -> DataFrame:
    """Maximum flood (along the principal direction) and ebb (against it)."""
    along = F.col(speed) * F.cos(F.radians(F.col(direction) - F.col("principal_dir")))
    projected = df.join(principal, list(keys)).select(*keys, ts, along.alias("along"))
    found = water_level_extrema(
        projected, keys, ts=ts, value="along", step_seconds=step_seconds, separation_hours=separation_hours
    )
    flood = (F.col("kind") == "high") & (F.col("along") > 0)
    ebb = (F.col("kind") == "low") & (F.col("along") < 0)
    return found.filter(flood | ebb).select(
        *keys, ts, "along", F.when(flood, "flood").otherwise("ebb").alias("kind")
    )


class _Pool:
    """Observed times in order, of which the nearest free one can be taken."""

    def __init__(self, times: np.ndarray, reach: int):
        self.times, self.reach, n = times, reach, len(times)
        # Slots lead on to the next free one; slot 0 of ``down`` and slot n of ``up`` mean none.
        self.down, self.up = list(range(n + 1)), list(range(n + 1))

    @staticmethod
    def _follow(way: list[int], i: int) -> int:
        while way[i] != i:
            way[i] = i = way[way[i]]
        return i

    def claim(self, i: int) -> None:
        self.down[i + 1], self.up[i] = i, i + 1

    def take(self, t: int) -> int:
        """Claim the nearest free time within reach, the earlier on a tie; -1 if there is none."""
        at = int(np.searchsorted(self.times, t, "right"))
        before, after = self._follow(self.down, at) - 1, self._follow(self.up, at)
        gap_before = t - self.times[before] if before >= 0 else self.reach + 1
        gap_after = self.times[after] - t if after < len(self.times) else self.reach + 1
        if min(gap_before, gap_after) > self.reach:
            return -1
        if gap_before <= gap_after:
            # The first free one of those that share this time.
            after = self._follow(self.up, int(np.searchsorted(self.times, self.times[before], "left")))
        self.claim(after)
        return after


def _matched(
    rows: DataFrame, keys: Sequence[str], reach: int, span: int, warm_up: bool
) -> DataFrame:
    """Greedy pairing inside chunks of ``span`` microseconds, one group a chunk.

    Rows have (keys, __chunk, __side, __t, __v): observed events (0), model events (1) and observed events
    that earlier chunks claimed (2, __v their number among equal times).  With ``warm_up`` the claims are
    guessed by pairing the model events before the chunk.  Returns model events with their match (1), the claims
    the chunk started from (2) and those it leaves to the next chunk (3).
    """
    schema = T.StructType(
        [*[rows.schema[k] for k in keys], T.StructField("__chunk", T.LongType()), T.StructField("__side", T.IntegerType())]
        + [T.StructField("__t", T.LongType()), T.StructField("__v", T.DoubleType())]
        + [T.StructField("__ot", T.LongType()), T.StructField("__ov", T.DoubleType())]
    )
    names = [f.name for f in schema.fields]

    def pair(pdf: pd.DataFrame) -> pd.DataFrame:
        chunk = int(pdf["__chunk"].iloc[0])
        start = chunk * span
        sides = [pdf[pdf["__side"] == i].sort_values(["__t", "__v"]) for i in range(3)]
        seen, events, claims = ((x["__t"].to_numpy(), x["__v"].to_numpy()) for x in sides)
        if not (events[0] >= start).any():
            return pdf.iloc[:0].assign(__ot=pdf["__t"], __ov=pdf["__v"])[names]
        times = seen[0]
        number = np.arange(len(times)) - np.searchsorted(times, times, "left")
        pool = _Pool(times, reach)
        if warm_up:
            taken = [pool.take(int(t)) for t in events[0][events[0] < start]]
            known = [i for i in taken if i >= 0 and times[i] >= start - reach]
        else:
            known = [int(i) for i in np.searchsorted(times, claims[0], "left") + claims[1].astype(int)]
            for i in known:
                pool.claim(i)
        out = [(2, times[i], float(number[i]), None, None) for i in known]
        for t, v in zip(*(x[events[0] >= start] for x in events)):
            i = pool.take(int(t))
            if i < 0:
                out.append((1, t, v, None, None))
                continue
            out.append((1, t, v, times[i], seen[1][i]))
            if times[i] >= start + span - reach:
                out.append((3, times[i], float(number[i]), None, None))
        head = [pdf[name].iloc[0] for name in keys]
        return pd.DataFrame([(*head, chunk, *row) for row in out], columns=names, dtype=object)

    # A given number of tasks: the rows are few bytes, so AQE would leave all chunks to one Python worker.
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(tasks, *keys, "__chunk").groupBy(*keys, "__chunk").applyInPandas(pair, schema)


def pair_events(
    model: DataFrame,
    obs: DataFrame,
    keys: Sequence[str],
    *,
    ts: str = "ts",
    value: str = "value",
    tolerance_hours: float = 3.0,
    chunk_seconds: int = CHUNK_SECONDS,
) -> DataFrame:
    """Greedy one-to-one pairing of events, model events taken in time order.

    Each model event takes the nearest unclaimed observed event within the
    tolerance, the earlier one on a tie; events may lie at any distance.  Events of one time are
    taken in the order of their values, events without a time take no part.

    The order matters only through observed events that are claimed already.  A chunk therefore
    needs to know, of all that came before it, which events within the tolerance of its start
    are claimed.  Each chunk first guesses them by pairing the model events of a short time before
    it.  Chunks whose guess differs from what the chunk before them really claimed are paired again from those
    claims until all agree.  In every round the first chunk that disagrees becomes final, and one wrong
    guess goes on only as long as each event loses its choice to the one before, so rounds are few.  A task
    holds the events of one chunk.
    """
    reach = round(tolerance_hours * 3.6e9)
    span = max(chunk_seconds * 1_000_000, 2 * reach, 1)
    warm = 4 * reach

    def index(t: Column) -> Column:
        return ((t - F.pmod(t, F.lit(span))) / span).cast("long")

    def placed(df: DataFrame, side: int, before: int, after: int) -> DataFrame:
        t = F.col("__t")
        rows = df.select(
            *keys, F.lit(side).alias("__side"), F.unix_micros(F.col(ts).cast("timestamp")).alias("__t"), F.col(value).cast("double").alias("__v")
        ).filter("__t IS NOT NULL")
        return rows.withColumn("__chunk", F.explode(F.sequence(index(t - before), index(t + after))))

    rows = placed(model, 1, 0, warm).unionByName(placed(obs, 0, reach, reach + warm))
    place = [*keys, "__chunk"]

    def within(df: DataFrame, chunks: DataFrame, how: str) -> DataFrame:
        named = chunks.select(*[F.col(c).alias(f"__in_{c}") for c in place])
        same = [F.col(c).eqNullSafe(F.col(f"__in_{c}")) for c in place]
        return df.join(named, reduce(Column.__and__, same), how)

    done = cut_lineage(_matched(rows, keys, reach, span, True))
    kept = False
    while True:
        passed_on = done.filter("__side = 3").withColumn("__chunk", F.col("__chunk") + 1)
        both = done.filter("__side = 2").unionByName(passed_on).groupBy(*place, "__t", "__v")
        differ = both.agg(F.sum(F.col("__side") - 2.5).alias("__d")).filter("__d <> 0").select(*place).distinct()
        wrong = cut_lineage(within(differ, done.filter("__side = 1").select(*place).distinct(), "left_semi"))
        if wrong.isEmpty():
            break
        if not kept:
            rows, kept = cut_lineage(rows), True
        claims = passed_on.select(*keys, F.lit(2).alias("__side"), "__t", "__v", "__chunk")
        again = within(rows.unionByName(claims), wrong, "left_semi")
        done = cut_lineage(within(done, wrong, "left_anti").unionByName(_matched(again, keys, reach, span, False)))
    return done.filter("__side = 1").select(
        *keys,
        F.timestamp_micros("__t").alias(ts),
        F.col("__v").alias("model_value"),
        F.timestamp_micros("__ot").alias(f"obs_{ts}"),
        F.col("__ov").alias("obs_value"),
        ((F.col("__t") - F.col("__ot")) / 3.6e9).alias("timing_hours"),
    )


def detection_counts(
    model: DataFrame, obs: DataFrame, matches: DataFrame, keys: Sequence[str], ts: str = "ts"
) -> DataFrame:
    """How many events the model has, the observations have, and were matched."""

    def tally(df: DataFrame, column: str, name: str) -> DataFrame:
        return df.groupBy(*keys).agg(F.count(column).alias(name))

    out = (
        tally(model, ts, "n_model")
        .join(tally(obs, ts, "n_obs"), list(keys), "full_outer")
        .join(tally(matches, f"obs_{ts}", "n_matched"), list(keys), "full_outer")
    )
    return out.fillna(0, ["n_model", "n_obs", "n_matched"])
