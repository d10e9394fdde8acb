"""Skill scores and grading.

All aggregates take errors e = model - obs, skip missing values, use inclusive
thresholds and divide by the number of non-missing errors.  They are plain
declarative aggregates and so reduce before the shuffle: a dominant station
costs one partial row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seamark.functions.rounding import half_even
from seamark.functions import angles
from seamark.operators import runs

# Target error X1 and allowed duration X2 (hours or 0.5) per variable.
DEFAULT_THRESHOLDS = {
    "salt": (3.5, 0.5),
    "temp": (3.0, 0.5),
    "wl": (0.15, 0.5),
    "cu": (0.26, 0.5),
    "cu_dir": (22.5, 0.5),
    "ice_conc": (10.0, 0.5),
}
# Acceptance limits in percent, hours for durations.
CENTRAL_LIMIT = 90.0
OUTLIER_LIMIT = 1.0
DURATION_LIMIT_HOURS = 24.0
WORST_CASE_LIMIT = 0.5
MIN_PAIRS = 5


def ratio(top: Column, bottom: Column) -> Column:
    return F.try_divide(top, bottom)


def percent_of(hit: Column, counted: Column) -> Column:
    """100 * (rows where hit) / (rows where counted is present)."""
    return ratio(100.0 * F.count_if(hit), F.count(counted).cast("double"))


def rmse(e: Column) -> Column:
    return F.sqrt(F.avg(e * e))


def pearson(model: Column, obs: Column) -> Column:
    """Correlation over common rows; NULL when either side is constant."""
    m = F.when(obs.isNotNull(), model)
    o = F.when(model.isNotNull(), obs)
    spread = F.stddev_pop(m) * F.stddev_pop(o)
    constant = (F.max(m) == F.min(m)) | (F.max(o) == F.min(o))
    return F.when(~constant, ratio(F.covar_pop(m, o), spread))


def central_frequency(e: Column, x1: Column) -> Column:
    return percent_of(F.abs(e) <= x1, e)


def positive_outliers(e: Column, x1: Column) -> Column:
    return percent_of(e >= 2 * x1, e)


def negative_outliers(e: Column, x1: Column) -> Column:
    return percent_of(e <= -2 * x1, e)


def timing_central_frequency(hours: Column, window: float = 0.5) -> Column:
    return percent_of(F.abs(hours) <= window, hours)


def worst_case_frequency(model: Column, obs: Column, tide: Column, x1: Column) -> Column:
    """% of errors beyond 2*x1 where model and obs lie on opposite sides of the tide."""
    counts = worst_case_counts(model, obs, tide, x1)
    return ratio(100.0 * counts["__worst"], counts["__scored"].cast("double"))


def worst_case_counts(model: Column, obs: Column, tide: Column, x1: Column) -> dict[str, Column]:
    """Aggregates: worst cases, and errors that have a tide to judge them by."""
    opposite = ((model > tide) & (obs < tide)) | ((model < tide) & (obs > tide))
    e = model - obs
    return {
        "__worst": F.count_if(opposite & (F.abs(e) > 2 * x1)),
        "__scored": F.count(F.when(tide.isNotNull(), e)),
    }


def worst_case_applies(variable: Column, tide_datum: Column, run_datum: Column, system: Column) -> Column:
    """Worst case is scored for tidal water level in matching datums only."""
    return (variable == "wl") & (tide_datum == run_datum) & ~F.lower(system).startswith("l")


def grade(value: Column, limit: float, *, at_least: bool = False) -> Column:
    ok = value >= limit if at_least else value <= limit
    return F.when(value.isNull(), "NA").when(ok, "pass").otherwise("fail")


def thresholds(spark: SparkSession, config: DataFrame | None = None) -> DataFrame:
    """(variable, x1, x2): configured rows over the built-in defaults."""
    rows = [(v, *x) for v, x in DEFAULT_THRESHOLDS.items()]
    default = spark.createDataFrame(rows, "variable string, d1 double, d2 double")
    if config is None:
        return default.select("variable", F.col("d1").alias("x1"), F.col("d2").alias("x2"))
    return default.join(config.select("variable", "x1", "x2"), "variable", "full_outer").select(
        "variable",
        F.coalesce("x1", "d1").alias("x1"),
        F.coalesce("x2", "d2").alias("x2"),
    )


def circular_partials(model: Column, obs: Column) -> dict[str, Column]:
    """Sums of sines, cosines and their products over common rows, by name."""
    ok = model.isNotNull() & obs.isNotNull()
    a, b = F.radians(F.when(ok, model)), F.radians(F.when(ok, obs))
    terms = {"sa": F.sin(a), "ca": F.cos(a), "sb": F.sin(b), "cb": F.cos(b)}
    names = list(terms)
    sums = {"__cn": F.count(a), **{f"__{n}": F.sum(t) for n, t in terms.items()}}
    for i, p in enumerate(names):
        for q in names[i:]:
            sums[f"__{p}_{q}"] = F.sum(terms[p] * terms[q])
    return sums


def circular_from_sums() -> Column:
    """Jammalamadaka-Sarma correlation from ``circular_partials``.

    sin(a - A) expands to sin a cos A - cos a sin A with A the circular mean, so
    one pass over the rows is enough and nothing is joined back.
    """

    def s(name: str) -> Column:
        return F.col(f"__{name}")

    def unit(x: str, y: str) -> tuple[Column, Column]:
        r = F.hypot(s(x), s(y))
        return F.coalesce(ratio(s(x), r), F.lit(0.0)), F.coalesce(ratio(s(y), r), F.lit(1.0))

    (sin_a, cos_a), (sin_b, cos_b) = unit("sa", "ca"), unit("sb", "cb")
    top = (
        s("sa_sb") * cos_a * cos_b
        - s("sa_cb") * cos_a * sin_b
        - s("ca_sb") * sin_a * cos_b
        + s("ca_cb") * sin_a * sin_b
    )
    va = s("sa_sa") * cos_a * cos_a - 2 * s("sa_ca") * sin_a * cos_a + s("ca_ca") * sin_a * sin_a
    vb = s("sb_sb") * cos_b * cos_b - 2 * s("sb_cb") * sin_b * cos_b + s("cb_cb") * sin_b * sin_b
    # Below this spread (about 1e-6 rad) a side counts as constant.
    floor = s("cn") * 1e-12
    return F.when((s("cn") >= 2) & (va > floor) & (vb > floor), top / F.sqrt(va * vb))


def circular_correlation(df: DataFrame, keys: Sequence[str], model: str, obs: str) -> DataFrame:
    sums = df.groupBy(*keys).agg(*[c.alias(n) for n, c in circular_partials(F.col(model), F.col(obs)).items()])
    return sums.select(*keys, circular_from_sums().alias("circular_r"))


def _outlier_block(e: Column, x1: Column) -> list[Column]:
    return [
        half_even(central_frequency(e, x1), 2).alias("central_freq"),
        half_even(positive_outliers(e, x1), 2).alias("pos_outlier_freq"),
        half_even(negative_outliers(e, x1), 2).alias("neg_outlier_freq"),
    ]


GRADED = {
    "central_freq": (CENTRAL_LIMIT, True),
    "pos_outlier_freq": (OUTLIER_LIMIT, False),
    "neg_outlier_freq": (OUTLIER_LIMIT, False),
    "max_pos_hours": (DURATION_LIMIT_HOURS, False),
    "max_neg_hours": (DURATION_LIMIT_HOURS, False),
    "worst_case_freq": (WORST_CASE_LIMIT, False),
    "timing_central_freq": (CENTRAL_LIMIT, True),
}


def graded(df: DataFrame) -> DataFrame:
    """Add ``<score>_pass_fail`` for every graded score present."""
    add = {
        f"{c}_pass_fail": grade(F.col(c), limit, at_least=up)
        for c, (limit, up) in GRADED.items()
        if c in df.columns
    }
    return df.withColumns(add)


def _enough(df: DataFrame, keys: Sequence[str], min_pairs: int) -> DataFrame:
    """Below the minimum every score is NULL and ``status`` says why."""
    short = F.col("n_pairs") < min_pairs
    keep = [*keys, "n_pairs"]
    return df.select(
        *keep,
        *[
            F.when(~short, F.col(c)).alias(c)
            for c in df.columns
            if c not in keep
        ],
        F.when(short, F.lit(f"<{min_pairs} data points")).otherwise("ok").alias("status"),
    )


def _deviations(states: DataFrame, keys: Sequence[str], means: Sequence[str]) -> DataFrame:
    """Add ``<mean>_dev``, the distance of each state's mean from that of its series.

    With it the squares about the means of states add up without cancellation."""
    whole = Window.partitionBy(*keys)
    n = F.col("__pairs")
    return states.withColumns(
        {f"{m}_dev": F.col(m) - ratio(F.sum(n * F.col(m)).over(whole), F.sum(n).over(whole)) for m in means}
    )


def _pooled_mean(mean: str) -> Column:
    return ratio(F.sum(F.col("__pairs") * F.col(mean)), F.sum("__pairs"))


def _pooled_squares(squares: str, left: str, right: str) -> Column:
    """Sum of products about the means of the whole series."""
    return F.sum(F.col(squares) + F.col("__pairs") * F.col(f"{left}_dev") * F.col(f"{right}_dev"))


def _error_partials(e: Column, x1: Column) -> dict[str, Column]:
    n = F.count(e)
    return {
        "__pairs": n,
        "__sq": F.sum(e * e),
        "__e_mean": F.avg(e),
        "__ee": F.var_pop(e) * n,
        "__central": F.count_if(F.abs(e) <= x1),
        "__pos": F.count_if(e >= 2 * x1),
        "__neg": F.count_if(e <= -2 * x1),
    }


def _error_scores() -> list[Column]:
    """Scores that follow from ``_error_partials``, rounded."""
    n = F.sum("__pairs")

    def percent(hits: str) -> Column:
        return half_even(ratio(100.0 * F.sum(hits), n.cast("double")), 2)

    return [
        n.alias("n_pairs"),
        half_even(F.sqrt(ratio(F.sum("__sq"), n)), 2).alias("rmse"),
        half_even(F.sqrt(ratio(_pooled_squares("__ee", "__e_mean", "__e_mean"), n)), 2).alias("bias_std"),
        percent("__central").alias("central_freq"),
        percent("__pos").alias("pos_outlier_freq"),
        percent("__neg").alias("neg_outlier_freq"),
    ]


def _rounded_hours(stats: DataFrame) -> DataFrame:
    hours = {n: half_even(c, 2) for n, c in runs.in_hours().items()}
    return stats.withColumns(hours).drop("max_pos_rows", "max_neg_rows", "step_seconds")


def skill_scalar(
    pairs: DataFrame,
    keys: Sequence[str],
    *,
    ts: str = "ts",
    x1: Column | float,
    tie: Sequence[str] = (),
    tides: DataFrame | None = None,
    speed_rule: bool = False,
    min_pairs: int = MIN_PAIRS,
    extra: dict[str, Column] | None = None,
) -> DataFrame:
    """One graded skill row per series from ``obs`` and ``model`` columns.

    Scores are rounded half-even to 2 decimals and graded on rounded values.
    Bias % divides the *rounded* bias by the mean observation, or the unrounded
    one with ``speed_rule``.  Durations are rows of the longest outlier run times
    the median sampling interval, missing rows kept.  ``tides`` (keys, ts, tide)
    adds the worst-case frequency.  Rows shuffle once, to time chunks; run lengths, interval
    and scores then come from the partial sums of the chunks (``runs.run_states``).
    """
    limit = x1 if isinstance(x1, Column) else F.lit(float(x1))
    extra = extra or {}
    rows = pairs.select(
        *keys,
        ts,
        *tie,
        "obs",
        "model",
        limit.alias("__x1"),
        (F.col("model") - F.col("obs")).alias("__e"),
        *[c.alias(f"__in_{n}") for n, c in extra.items()],
    )
    e, x = F.col("__e"), F.col("__x1")
    n = F.count(e)
    m, o = F.when(e.isNotNull(), F.col("model")), F.when(e.isNotNull(), F.col("obs"))
    partials = {
        **_error_partials(e, x),
        "__m_mean": F.avg(m),
        "__o_mean": F.avg(o),
        "__mm": F.var_pop(m) * n,
        "__oo": F.var_pop(o) * n,
        "__mo": F.covar_pop(m, o) * n,
        **{f"__{f.__name__}_{side}": f(c) for side, c in (("m", m), ("o", o)) for f in (F.min, F.max)},
        "__target": F.max(x),
        **{f"__in_{name}_{f.__name__}": f(f"__in_{name}") for name in extra for f in (F.sum, F.count)},
    }
    if tides is not None:
        rows = rows.join(tides.select(*keys, ts, "tide"), [*keys, ts], "left")
        partials |= worst_case_counts(F.col("model"), F.col("obs"), F.col("tide"), x)
        worst = half_even(ratio(100.0 * F.sum("__worst"), F.sum("__scored").cast("double")), 2)
    else:
        worst = F.lit(None).cast("double")
    flags = runs.outlier_flags(e, x)
    states = runs.run_states(rows, keys, [ts, *tie], flags, partials)
    spread = F.sqrt(_pooled_squares("__mm", "__m_mean", "__m_mean")) * F.sqrt(_pooled_squares("__oo", "__o_mean", "__o_mean"))
    constant = (F.max("__max_m") == F.min("__min_m")) | (F.max("__max_o") == F.min("__min_o"))
    stats = _deviations(states, keys, ["__e_mean", "__m_mean", "__o_mean"]).groupBy(*keys).agg(
        *_error_scores(),
        half_even(F.when(~constant, ratio(_pooled_squares("__mo", "__m_mean", "__o_mean"), spread)), 2).alias("r"),
        _pooled_mean("__e_mean").alias("__bias"),
        _pooled_mean("__o_mean").alias("__mean_obs"),
        F.max("__target").alias("target_error"),
        worst.alias("worst_case_freq"),
        *[half_even(ratio(F.sum(f"__in_{name}_sum"), F.sum(f"__in_{name}_count")), 2).alias(name) for name in extra],
        *runs.folded(list(flags)),
    )
    stats = _rounded_hours(stats)
    base = F.col("__bias") if speed_rule else half_even("__bias", 2)
    out = (
        stats.withColumn("bias", half_even("__bias", 2))
        .withColumn("bias_perc", half_even(ratio(100 * base, F.col("__mean_obs")), 2))
        .drop("__bias", "__mean_obs")
    )
    return graded(_enough(out, keys, min_pairs))


def skill_speed(
    pairs: DataFrame, keys: Sequence[str], *, ts: str = "ts", x1: Column | float, tie: Sequence[str] = ()
) -> DataFrame:
    """Skill row of paired speeds, with the arithmetic mean direction bias."""
    named = pairs.withColumns({"obs": F.col("obs_speed"), "model": F.col("model_speed")})
    return skill_scalar(
        named, keys, ts=ts, x1=x1, tie=tie, speed_rule=True, extra={"bias_dir": F.col("dir_bias")}
    )


def skill_direction(
    pairs: DataFrame, keys: Sequence[str], *, ts: str = "ts", x1: float = 22.5, tie: Sequence[str] = ()
) -> DataFrame:
    """Skill row of signed direction differences with circular mean and correlation."""
    rows = pairs.select(
        *keys, ts, *tie, "model_dir", "obs_dir", F.col("dir_bias").alias("__e"), F.lit(float(x1)).alias("__x1")
    )
    e, x = F.col("__e"), F.col("__x1")
    partials = {
        **_error_partials(e, x),
        "__sin": F.sum(F.sin(F.radians(e))),
        "__cos": F.sum(F.cos(F.radians(e))),
        **circular_partials(F.col("model_dir"), F.col("obs_dir")),
    }
    flags = runs.outlier_flags(e, x)
    states = runs.run_states(rows, keys, [ts, *tie], flags, partials)
    stats = _deviations(states, keys, ["__e_mean"]).groupBy(*keys).agg(
        *_error_scores(),
        half_even(angles.angle_of_sums(F.sum("__sin"), F.sum("__cos")), 2).alias("bias"),
        *[F.sum(name).alias(name) for name in circular_partials(e, e)],
        *runs.folded(list(flags)),
    )
    stats = _rounded_hours(stats)
    out = stats.withColumn("r", half_even(circular_from_sums(), 2))
    return graded(_enough(out.drop(*[c for c in out.columns if c.startswith("__")]), keys, MIN_PAIRS))


def skill_extrema(
    matches: DataFrame, keys: Sequence[str], *, x1: float, min_pairs: int = 1
) -> DataFrame:
    """Amplitude and timing scores of matched high/low waters.

    ``matches`` holds ``obs_value, model_value, timing_hours`` per matched event.
    """
    e = F.col("model_value") - F.col("obs_value")
    t = F.col("timing_hours")
    limit = F.lit(float(x1))
    out = matches.groupBy(*keys).agg(
        F.count(e).alias("n_pairs"),
        half_even(rmse(e), 2).alias("rmse"),
        half_even(F.avg(e), 2).alias("bias"),
        half_even(F.stddev_pop(e), 2).alias("bias_std"),
        *_outlier_block(e, limit),
        half_even(rmse(t), 2).alias("timing_rmse"),
        half_even(timing_central_frequency(t), 2).alias("timing_central_freq"),
    )
    return graded(_enough(out, keys, min_pairs))
