"""Harmonic analysis, prediction, residuals, filters and persistence."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seamark.functions import angles, tidal
from seamark.functions.clock import epoch
from seamark.operators.sequence import CHUNK_SECONDS, chunk_of, halo
from seamark.session import spread

HOUR = 3600.0
# Chebyshev nodes that stand for a distant block while filtering.
NODES = 18
# Time chunks whose factors are reduced together before those of a whole series are.
BRANCH = 64


def residual(pairs: DataFrame, tides: DataFrame, keys: Sequence[str], ts: str = "ts", value: str = "obs") -> DataFrame:
    """Non-tidal residual: value minus predicted tide at common times."""
    return pairs.join(tides, [*keys, ts]).withColumn("residual", F.col(value) - F.col("tide"))


def persistence_forecast(
    df: DataFrame,
    keys: Sequence[str],
    *,
    ts: str = "ts",
    obs: str = "obs",
    tide: str = "tide",
    step_seconds: int,
    window_hours: float = 24.0,
    horizon_hours: float = 6.0,
    chunk_seconds: int = CHUNK_SECONDS,
) -> DataFrame:
    """Tide plus the mean residual of the preceding window on a regular series.

    A missing offset is replaced by the last one for at most the horizon; the
    first window of a series has no forecast.
    """
    width = int(window_hours * 3600 / step_seconds)
    hold = int(horizon_hours * 3600 / step_seconds)
    reach = (width + hold) * step_seconds
    wide, chunk, home = halo(
        df.select(*keys, ts, obs, tide), ts, before=reach, after=0, chunk_seconds=chunk_seconds
    )
    w = Window.partitionBy(*keys, chunk).orderBy(ts)
    window = w.rowsBetween(-width, -1)
    res = F.col(obs) - F.col(tide)
    wide = wide.withColumn(
        "__off", F.when(F.count(F.lit(1)).over(window) == width, F.avg(res).over(window))
    )
    kept = F.last("__off", True).over(w.rowsBetween(-(hold - 1), 0))
    return (
        wide.withColumn("offset", kept)
        .filter(home)
        .select(*keys, ts, obs, tide, "offset", (F.col(tide) + F.col("offset")).alias("forecast"))
    )


def _polynomials(u: np.ndarray) -> np.ndarray:
    """Row per place in [-1, 1]: weights of the values at the ``NODES`` Chebyshev nodes."""
    k = np.arange(NODES)
    own = np.cos(np.outer(k, (k + 0.5) * np.pi / NODES))
    own[0] /= 2
    return np.cos(np.outer(np.arccos(np.clip(u, -1, 1)), k)) @ own * (2 / NODES)


def _interval(start: int, stop: int) -> tuple[float, float]:
    return (start + stop - 1) / 2, max((stop - start - 1) / 2, 0.5)


def _kept_bins(n: int, step_seconds: int, cutoff_hours: float) -> int:
    # Tolerance keeps a bin whose frequency equals the cutoff.
    return int(min(n // 2, np.floor(n * step_seconds / 3600.0 / cutoff_hours + 1e-9)))


def fourier_lowpass(
    df: DataFrame,
    keys: Sequence[str],
    *,
    ts: str = "ts",
    value: str = "value",
    step_seconds: int,
    cutoff_hours: float = 25.0,
    block_rows: int = 1024,
) -> DataFrame:
    """Remove every Fourier component with period shorter than the cutoff.

    Equal to zeroing the bins above the cutoff of a full transform of a regular
    gap-free series of any length n.  Keeping the bins up to K is a circular convolution with
    sin((2K+1) a) / (n sin a), a = pi (i-j) / n.  The series is cut into B even blocks of about
    max(block_rows, sqrt(18 n)) rows.  A block and its two neighbours are convolved
    directly, by a transform of their length.  For other blocks the numerator splits into
    factors of i and of j, and 1 / sin a is smooth: 18 sums per block at Chebyshev nodes stand
    for its rows, to about 1e-13 of the largest value.  A task holds three blocks
    and the 18 B sums of its series, and the work per row does not grow with the record.
    Series with missing values or steps are refused.
    """
    t = epoch(F.col(ts))
    count = F.count(F.lit(1))
    whole = (F.count(value) == count) & (F.max(t) - F.min(t) == (count - 1) * step_seconds)
    first = df.groupBy(*keys).agg(
        F.when(whole, count).otherwise(F.raise_error(F.lit("a low-pass needs a regular series without gaps"))).alias("__n"),
        F.min(t).alias("__t0"),
    )
    n = F.col("__n")
    size = F.greatest(F.lit(float(block_rows)), F.sqrt(NODES * n))
    first = first.withColumn("__blocks", F.greatest(F.lit(1), F.floor(n / size)).cast("long"))
    rows = df.select(*keys, ts, value).join(first, list(keys)).select(
        *keys,
        ts,
        F.col(value).cast("double").alias("__v"),
        "__n",
        "__blocks",
        F.floor((epoch(F.col(ts)) - F.col("__t0")) / step_seconds).alias("__i"),
    )
    blocks = F.col("__blocks")
    rows = rows.withColumn("__b", F.expr("__i * __blocks div __n"))
    key_fields = [rows.schema[k] for k in keys]

    def edges(b: int, blocks: int, n: int) -> tuple[int, int]:
        return -(-b * n // blocks), -(-(b + 1) * n // blocks)

    def turn(i: np.ndarray, n: int) -> np.ndarray:
        """exp(1j pi (2K+1) i / n)"""
        odd = 2 * _kept_bins(n, step_seconds, cutoff_hours) + 1
        return np.exp(1j * np.pi * (odd * i % (2 * n)) / n)

    source_schema = T.StructType(
        key_fields
        + [T.StructField("__b", T.LongType())]
        + [T.StructField(c, T.DoubleType()) for c in ("at", "re", "im")]
    )

    def gather(pdf: pd.DataFrame) -> pd.DataFrame:
        n, b, parts = (int(pdf[c].iloc[0]) for c in ("__n", "__b", "__blocks"))
        middle, half = _interval(*edges(b, parts, n))
        i = pdf["__i"].to_numpy()
        q = (pdf["__v"].to_numpy() * turn(i, n).conj()) @ _polynomials((i - middle) / half)
        nodes = middle + half * np.cos((np.arange(NODES) + 0.5) * np.pi / NODES)
        out = pd.DataFrame({"__b": b, "at": nodes, "re": q.real, "im": q.imag})
        for pos, key in enumerate(keys):
            out.insert(pos, key, pdf[key].iloc[0])
        return out

    sources = rows.filter(blocks > 3).groupBy(*keys, "__b").applyInPandas(gather, source_schema)
    targets = first.filter(blocks > 3).select(
        *keys, blocks, F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("__to")
    )
    own = [f"__k_{key}" for key in keys]
    apart = F.pmod(F.col("__b") - F.col("__to"), blocks).between(2, blocks - 2)
    far = targets.join(sources, list(keys)).filter(apart).select(
        *[F.col(k).alias(o) for k, o in zip(keys, own)], F.col("__to").alias("__k_to"), "at", "re", "im"
    )
    around = F.array_distinct(F.array(*[F.pmod(F.col("__b") + d, blocks) for d in (-1, 0, 1)]))
    near = rows.withColumn("__to", F.explode(around))
    out_schema = T.StructType(
        key_fields + [T.StructField(ts, rows.schema[ts].dataType), T.StructField("lowpass", T.DoubleType())]
    )

    def evaluate(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left):
            return pd.DataFrame({f.name: [] for f in out_schema.fields})
        n, to, parts = (int(left[c].iloc[0]) for c in ("__n", "__to", "__blocks"))
        kept = _kept_bins(n, step_seconds, cutoff_hours)
        home = (left["__b"] == to).to_numpy()
        out = left.loc[home, [*keys, ts]]
        if 2 * kept >= n - 1:
            return out.assign(lowpass=left["__v"].to_numpy()[home])
        i = left["__i"].to_numpy()
        place = (i - edges((to - 1) % parts, parts, n)[0]) % n if parts > 3 else i
        span = len(left)
        x = np.zeros(span)
        x[place] = left["__v"].to_numpy()
        d = np.arange(1, span)
        wave = np.concatenate([[(2 * kept + 1) / n], turn(d, n).imag / (n * np.sin(np.pi * d / n))])
        width = 1 << (2 * span - 1).bit_length()
        kernel = np.zeros(width)
        kernel[:span], kernel[width - span + 1 :] = wave, wave[:0:-1]
        y = np.fft.irfft(np.fft.rfft(x, width) * np.fft.rfft(kernel), width)[place[home]]
        if len(right):
            middle, half = _interval(*edges(to, parts, n))
            nodes = middle + half * np.cos((np.arange(NODES) + 0.5) * np.pi / NODES)
            q = right["re"].to_numpy() + 1j * right["im"].to_numpy()
            at_nodes = np.array([(q / np.sin(np.pi * (node - right["at"].to_numpy()) / n)).sum() for node in nodes])
            y += (turn(i[home], n) * (_polynomials((i[home] - middle) / half) @ at_nodes)).imag / n
        return out.assign(lowpass=y)

    return near.groupBy(*keys, "__to").cogroup(far.groupBy(*own, "__k_to")).applyInPandas(evaluate, out_schema)


def spans(df: DataFrame, keys: Sequence[str], ts: str = "ts", value: str = "value") -> DataFrame:
    """First-to-last time of the valid values, in hours, per series."""
    t = epoch(F.col(ts))
    return (
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys)
        .agg(((F.max(t) - F.min(t)) / HOUR).alias("span_hours"), F.count(F.lit(1)).alias("n"))
    )


def within_record(span: DataFrame, keys: Sequence[str], names: Sequence[str] | None = None) -> DataFrame:
    """Constituents with a period no longer than the record, per series."""
    return tidal.each_constituent(span.select(*keys, "span_hours"), names).filter(
        F.col("span_hours") >= 360.0 / F.col("speed")
    )


def resolvable(
    span: DataFrame, keys: Sequence[str], names: Sequence[str] | None = None, *, rayleigh: float = 0.9
) -> DataFrame:
    """Constituents a record can resolve, per series.

    First those with a period no longer than the record; then, of each group of
    neighbours in frequency closer than rayleigh / record length, the one that
    comes first in priority order.  On a line, connected components are runs of
    close neighbours.  At most 37 rows per series enter a window.
    """
    cand = within_record(span, keys, names)
    w = Window.partitionBy(*keys).orderBy("speed", "priority")
    gap = (F.col("speed") - F.lag("speed").over(w)) / 360.0
    fresh = F.when(gap.isNull() | (gap >= rayleigh / F.col("span_hours")), 1).otherwise(0)
    block = F.sum("__fresh").over(w)
    named = cand.withColumn("__fresh", fresh).withColumn("__block", block)
    return (
        named.groupBy(*keys, "__block")
        .agg(F.min_by(F.struct("constituent", "priority", "speed"), "priority").alias("c"))
        .select(*keys, "c.constituent", "c.priority", "c.speed")
    )


def _packed(x: np.ndarray) -> np.ndarray:
    """Upper triangle of the factor R of X = QR, row by row; X may have fewer rows than columns."""
    m = x.shape[1]
    r = np.zeros((m, m))
    top = np.linalg.qr(x, mode="r")
    r[: len(top)] = top
    return r[np.triu_indices(m)]


def _unpacked(upper: Sequence[float], m: int) -> np.ndarray:
    full = np.zeros((m, m))
    full[np.triu_indices(m)] = upper
    return full


def triangular_factors(
    df: DataFrame,
    keys: Sequence[str],
    chosen: DataFrame,
    *,
    ts: str = "ts",
    values: Sequence[str] = ("value",),
    epoch_seconds: float = 0.0,
    trend: bool = True,
    chunk_seconds: int = CHUNK_SECONDS,
) -> DataFrame:
    """(keys, mid, m, n, upper): n rows and the factor R of X = QR per series, its upper triangle as one array.

    X = [1, (trend), cos, sin, ..., values].  Rows are grouped by series and time chunk, so
    each chunk is reduced to one factor wherever its rows lie; the factors of ``BRANCH`` neighbouring
    chunks, and then those of a series, are stacked and reduced again.  R has the condition of X,
    which X'X would square, so close constituents keep their digits.  ``chosen`` holds
    the constituents of each series (at most 37); they meet a chunk once, not its rows.
    The trend counts thousands of hours from the middle of the record, ``mid``.
    """
    hours = (F.unix_micros(F.col(ts).cast("timestamp")) / 1e6 - epoch_seconds) / HOUR
    rows = df.filter(" AND ".join(f"`{v}` IS NOT NULL" for v in values)).select(
        *keys,
        chunk_of(F.col(ts), chunk_seconds).alias("__chunk"),
        hours.alias("__h"),
        *[F.col(v).cast("double").alias(f"__y{i}") for i, v in enumerate(values)],
    )
    basis = chosen.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("priority", "speed"))).alias("c"))
    extent = rows.groupBy(*keys, "__chunk").agg(F.min("__h").alias("lo"), F.max("__h").alias("hi"))
    middle = extent.groupBy(*keys).agg(((F.min("lo") + F.max("hi")) / 2).alias("mid"))
    chunks = extent.select(*keys, "__chunk").join(middle, list(keys)).join(spread(basis), list(keys))
    # Other names than the rows have: both sides derive from one table.
    own = [f"__b_{c}" for c in (*keys, "__chunk")]
    chunks = chunks.select(*[F.col(c).alias(b) for c, b in zip((*keys, "__chunk"), own)], "mid", F.col("c.speed").alias("speeds"))
    schema = T.StructType(
        [rows.schema[k] for k in keys]
        + [
            T.StructField("mid", T.DoubleType()),
            T.StructField("__branch", T.LongType()),
            T.StructField("m", T.IntegerType()),
            T.StructField("n", T.LongType()),
            T.StructField("upper", T.ArrayType(T.DoubleType())),
        ]
    )
    names = [f.name for f in schema.fields]
    lead = 2 if trend else 1

    def fold(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({n: [] for n in names})
        h, mid = left["__h"].to_numpy(), float(right["mid"].iloc[0])
        arg = np.deg2rad(np.outer(h, np.asarray(right["speeds"].iloc[0])))
        waves = 2 * arg.shape[1]
        x = np.empty((len(h), lead + waves + len(values)))
        x[:, 0] = 1.0
        if trend:
            x[:, 1] = (h - mid) / 1000
        x[:, lead : lead + waves : 2] = np.cos(arg)
        x[:, lead + 1 : lead + waves : 2] = np.sin(arg)
        for i in range(len(values)):
            x[:, lead + waves + i] = left[f"__y{i}"].to_numpy()
        head = [left[k].iloc[0] for k in keys]
        branch = int(left["__chunk"].iloc[0]) // BRANCH
        return pd.DataFrame([(*head, mid, branch, x.shape[1], len(x), _packed(x))], columns=names)

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        m = int(pdf["m"].iloc[0])
        stack = np.concatenate([_unpacked(u, m) for u in pdf["upper"]])
        return pd.DataFrame([(*[pdf[c].iloc[0] for c in names[:-2]], pdf["n"].sum(), _packed(stack))], columns=names)

    at = [*keys, "__chunk"]
    partial = rows.groupBy(*at).cogroup(chunks.groupBy(*own)).applyInPandas(fold, schema)
    branches = partial.groupBy(*keys, "__branch").applyInPandas(merge, schema)
    return branches.groupBy(*keys).applyInPandas(merge, schema).drop("__branch")


def normal_equations(df: DataFrame, keys: Sequence[str], chosen: DataFrame, **options) -> DataFrame:
    """Entries (m, pos, s) of the upper triangle of X'X = R'R per series, without trend."""
    factors = triangular_factors(df, keys, chosen, trend=False, **options).drop("mid", "n")

    def square(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            full = [_unpacked(u, m) for u, m in zip(pdf["upper"], pdf["m"])]
            yield pdf.assign(upper=[(r.T @ r)[np.triu_indices(len(r))] for r in full])

    cells = factors.mapInPandas(square, factors.schema)
    return cells.select(*keys, "m", F.posexplode("upper").alias("pos", "s"))


def harmonic_analysis(
    df: DataFrame,
    keys: Sequence[str],
    chosen: DataFrame,
    *,
    ts: str = "ts",
    value: str | Sequence[str] = "value",
    epoch_seconds: float = 0.0,
    trend: bool = True,
) -> DataFrame:
    """Least-squares amplitude, Greenwich-style phase, SNR, mean and slope per constituent.

    Phases are lags in degrees relative to ``epoch_seconds``:
    value = mean + slope (hours - mid) + sum A cos(speed * hours - phase).
    Without ``trend`` the slope is 0.  Several value columns, such as both components of a
    current, are fitted over one shared matrix; ``component`` then names the column.
    """
    values = [value] if isinstance(value, str) else list(value)
    factors = triangular_factors(df, keys, chosen, ts=ts, values=values, epoch_seconds=epoch_seconds, trend=trend)
    names = chosen.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("priority", "constituent", "speed"))).alias("__c")
    )
    ready = factors.join(spread(names), list(keys)).select(
        *keys,
        "mid",
        "m",
        "n",
        F.col("upper").alias("__r"),
        F.col("__c.constituent").alias("__names"),
        F.col("__c.speed").alias("__speeds"),
    )
    schema = T.StructType(
        [ready.schema[k] for k in keys]
        + [T.StructField("component", T.StringType()), T.StructField("constituent", T.StringType())]
        + [T.StructField(n, T.DoubleType()) for n in ("speed", "amplitude", "phase", "snr", "mean", "slope", "mid")]
        + [T.StructField("n", T.LongType())]
    )
    lead = 2 if trend else 1

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # One row per series: its factor of at most 78 x 78.
        for pdf in batches:
            out = []
            for rec in pdf.to_dict("records"):
                n, p = int(rec["n"]), int(rec["m"]) - len(values)
                full = _unpacked(rec["__r"], int(rec["m"]))
                r, qty, rest = full[:p, :p], full[:p, p:], full[p:, p:]
                variance = (np.linalg.pinv(r) ** 2).sum(axis=1)
                for i, component in enumerate(values):
                    beta, *_ = np.linalg.lstsq(r, qty[:, i], rcond=None)
                    missed = (rest[:, i] ** 2).sum() + ((r @ beta - qty[:, i]) ** 2).sum()
                    sigma2 = missed / max(n - p, 1.0)
                    a, b = beta[lead::2], beta[lead + 1 :: 2]
                    amp = np.hypot(a, b)
                    phase = np.degrees(np.arctan2(b, a)) % 360
                    var = sigma2 * variance
                    safe = np.where(amp > 0, amp, 1.0)
                    half = 1.96 * np.sqrt((a**2 * var[lead::2] + b**2 * var[lead + 1 :: 2]) / safe**2)
                    snr = np.where(half > 0, (amp / np.where(half > 0, half, 1.0)), np.inf)
                    slope, mid = (beta[1] / 1000, rec["mid"]) if trend else (0.0, 0.0)
                    for k, name in enumerate(rec["__names"]):
                        out.append(
                            (*[rec[c] for c in keys], component, name, rec["__speeds"][k], amp[k], phase[k],
                             min(snr[k], 1e12), beta[0], slope, mid, n)
                        )
            yield pd.DataFrame(out, columns=[f.name for f in schema.fields])

    fitted = ready.mapInPandas(solve, schema)
    return fitted.drop("component") if isinstance(value, str) else fitted


def current_ellipses(
    df: DataFrame, keys: Sequence[str], chosen: DataFrame, *, ts: str = "ts", u: str = "u", v: str = "v", epoch_seconds: float = 0.0, trend: bool = True
) -> DataFrame:
    """Ellipse per constituent from east and north series, solved over one matrix."""
    both = harmonic_analysis(df, keys, chosen, ts=ts, value=[u, v], epoch_seconds=epoch_seconds, trend=trend)
    return ellipses(both.filter(F.col("component") == u), both.filter(F.col("component") == v), keys)


def predict(
    times: DataFrame,
    constants: DataFrame,
    keys: Sequence[str],
    *,
    ts: str = "ts",
    epoch_seconds: float = 0.0,
    min_snr: float | None = None,
    means: DataFrame | None = None,
) -> DataFrame:
    """Tide at given times from amplitude/phase rows (at most 37 per series).

    The constants of a series become one short array, so each time row is
    evaluated in place and the (large) time table is not multiplied.
    """
    use = constants if min_snr is None else constants.filter(F.col("snr") >= min_snr)
    if means is None and "mean" in constants.columns:
        drift = [F.max(c).alias(c) for c in ("mean", "slope", "mid") if c in constants.columns]
        means = constants.groupBy(*keys).agg(*drift)
    packed = use.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("constituent", "speed", "amplitude", "phase"))).alias("__c")
    )
    if means is not None:
        packed = means.join(spread(packed), list(keys), "left")
    hours = (F.unix_micros(F.col(ts).cast("timestamp")) / 1e6 - epoch_seconds) / HOUR
    wave = F.aggregate(
        F.coalesce("__c", F.array().cast(packed.schema["__c"].dataType)),
        F.lit(0.0),
        lambda acc, c: acc + c["amplitude"] * F.cos(F.radians(c["speed"] * F.col("__h") - c["phase"])),
    )
    base = F.col("mean") if means is not None else F.lit(0.0)
    if means is not None and "slope" in means.columns:
        base = base + F.col("slope") * (F.col("__h") - F.col("mid"))
    return (
        times.withColumn("__h", hours)
        .join(spread(packed), list(keys))
        .withColumn("tide", wave + base)
        .drop("__h", "__c", "mean", "slope", "mid")
    )


def predict_from_constants(
    times: DataFrame,
    amplitudes: DataFrame,
    phases: DataFrame,
    keys: Sequence[str],
    *,
    ts: str = "ts",
    epoch_seconds: float = 0.0,
) -> DataFrame:
    """Prediction using the names present in both the amplitude and phase rows."""
    both = (
        amplitudes.withColumn("constituent", tidal.standard_name(F.col("constituent")))
        .join(
            spread(phases.withColumn("constituent", tidal.standard_name(F.col("constituent")))),
            [*keys, "constituent"],
        )
    )
    both = both.withColumn("speed", tidal.speed_of_name(F.col("constituent"))).filter("speed IS NOT NULL")
    return predict(times, both, keys, ts=ts, epoch_seconds=epoch_seconds)


def compare_constants(
    series: DataFrame, reference: DataFrame, model: DataFrame, keys: Sequence[str], names: Sequence[str] | None = None
) -> DataFrame:
    """All constituents of every series with model minus reference differences."""
    scaffold = tidal.each_constituent(series.select(*keys).distinct(), names)
    ref = reference.select(
        *keys, "constituent", F.col("amplitude").alias("ref_amp"), F.col("phase").alias("ref_phase")
    )
    mod = model.select(
        *keys, "constituent", F.col("amplitude").alias("model_amp"), F.col("phase").alias("model_phase")
    )
    on = [*keys, "constituent"]
    out = scaffold.join(spread(ref), on, "left").join(spread(mod), on, "left")
    amp = F.col("model_amp") - F.col("ref_amp")
    phase = angles.phase_gap(F.col("model_phase"), F.col("ref_phase"))
    vector = angles.phasor_gap(
        F.col("model_amp"), F.col("model_phase"), F.col("ref_amp"), F.col("ref_phase")
    )
    return out.select(
        *on,
        F.col("priority").alias("n"),
        "ref_amp",
        "ref_phase",
        "model_amp",
        "model_phase",
        amp.alias("amp_diff"),
        phase.alias("phase_diff"),
        vector.alias("vector_diff"),
    )


def constituent_table(
    series: DataFrame,
    model: DataFrame,
    keys: Sequence[str],
    *,
    accepted: DataFrame | None = None,
    observed: DataFrame | None = None,
) -> DataFrame:
    """Model constants against accepted ones, or against observed where a series
    has no accepted constants; with exceedance codes."""
    if accepted is None:
        reference = observed
    elif observed is None:
        reference = accepted
    else:
        cols = [*keys, "constituent", "amplitude", "phase"]
        without = observed.join(spread(accepted.select(*keys).distinct()), list(keys), "left_anti")
        reference = accepted.select(*cols).unionByName(without.select(*cols))
    table = compare_constants(series, reference, model, keys)
    return table.withColumn(
        "exceeds",
        tidal.exceedance_codes(F.col("amp_diff"), F.col("phase_diff"), F.col("vector_diff")),
    )


def constituent_summary(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mean vector difference and amplitude/phase RMSE, for all and the major eight."""
    valid = F.col("vector_diff").isNotNull()
    major = valid & F.col("constituent").isin(*tidal.MAJOR_CONSTITUENTS)

    def block(mask: Column, suffix: str) -> list[Column]:
        def rms(c: str) -> Column:
            return F.sqrt(F.avg(F.when(mask, F.col(c) * F.col(c))))

        return [
            F.avg(F.when(mask, F.col("vector_diff"))).alias(f"mean_vector_diff{suffix}"),
            rms("amp_diff").alias(f"rmse_amp{suffix}"),
            rms("phase_diff").alias(f"rmse_phase{suffix}"),
        ]

    return table.groupBy(*keys).agg(
        *block(valid, ""), *block(major, "_major"), F.count_if(valid).alias("n_valid")
    )


def verify_predictions(matched: DataFrame, keys: Sequence[str], ours: str, theirs: str) -> DataFrame:
    """RMSE, mean and largest difference, and correlation of two predictions."""
    from seamark.operators.scores import pearson

    d = F.col(ours) - F.col(theirs)
    return matched.groupBy(*keys).agg(
        F.count(d).alias("n"),
        F.sqrt(F.avg(d * d)).alias("rmse"),
        F.avg(d).alias("mean_diff"),
        F.max(F.abs(d)).alias("max_abs_diff"),
        pearson(F.col(ours), F.col(theirs)).alias("r"),
    )


def ellipses(u_constants: DataFrame, v_constants: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Current ellipse per constituent from the constants of u (east) and v (north).

    Closed form by counter-rotating phasors; ``theta`` is the inclination of the
    major axis from east in [0, 180), ``g`` its phase.
    """
    on = [*keys, "constituent"]
    u = u_constants.select(*on, F.col("amplitude").alias("au"), F.radians("phase").alias("gu"))
    v = v_constants.select(*on, F.col("amplitude").alias("av"), F.radians("phase").alias("gv"))
    e = u.join(spread(v), on)
    au, gu, av, gv = (F.col(c) for c in ("au", "gu", "av", "gv"))
    # w(t) = u + iv = p e^{i wt} + m e^{-i wt}
    p_re = (au * F.cos(gu) + av * F.sin(gv)) / 2
    p_im = (av * F.cos(gv) - au * F.sin(gu)) / 2
    m_re = (au * F.cos(gu) - av * F.sin(gv)) / 2
    m_im = (av * F.cos(gv) + au * F.sin(gu)) / 2
    p, m = F.hypot(p_re, p_im), F.hypot(m_re, m_im)
    ep, em = F.degrees(F.atan2(p_im, p_re)), F.degrees(F.atan2(m_im, m_re))
    theta_raw = F.pmod((ep + em) / 2, F.lit(360.0))
    flip = theta_raw >= 180
    theta = F.when(flip, theta_raw - 180).otherwise(theta_raw)
    g_raw = (em - ep) / 2 + F.when(flip, F.lit(180.0)).otherwise(F.lit(0.0))
    return e.select(
        *on,
        (p + m).alias("major"),
        (p - m).alias("minor"),
        theta.alias("theta"),
        F.pmod(g_raw, F.lit(360.0)).alias("g"),
    )
