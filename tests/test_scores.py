"""Score definitions: boundary cases, missing values, circular statistics."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from seamark.functions import angles
from seamark.operators import grids, ice, quantiles, scores

K = ["station_id"]
T0 = 1704067200


@pytest.fixture
def pairs(spark):
    def make(obs, model, step=3600):
        rows = [
            ("a", T0 + i * step, None if o is None else float(o), None if m is None else float(m))
            for i, (o, m) in enumerate(zip(obs, model))
        ]
        return spark.createDataFrame(rows, "station_id string, t bigint, obs double, model double").selectExpr(
            "station_id", "timestamp_seconds(t) AS ts", "obs", "model"
        )

    return make


def one(df, *cols):
    return df.agg(*cols).first()


def test_rmse_and_thresholds_are_inclusive(pairs, spark):
    e = F.col("model") - F.col("obs")
    assert one(pairs([1.0, 2, 3, 3], [2.0, 1, 4, 2]), scores.rmse(e))[0] == 1.0
    d = spark.createDataFrame([(0.15,), (-0.15,), (None,)], "e double")
    assert one(d, scores.central_frequency(F.col("e"), F.lit(0.15)))[0] == 100.0
    d = spark.createDataFrame([(2.0,), (-2.0,), (0.0,), (None,)], "e double")
    r = one(d, scores.positive_outliers(F.col("e"), F.lit(1.0)), scores.negative_outliers(F.col("e"), F.lit(1.0)))
    assert r[0] == pytest.approx(100 / 3) and r[1] == pytest.approx(100 / 3)


def test_empty_and_constant_inputs_give_null(pairs, spark):
    d = spark.createDataFrame([(None,)], "e double")
    assert one(d, scores.central_frequency(F.col("e"), F.lit(1.0)))[0] is None
    p = pairs([1.0, 1.0, 1.0], [1.0, 2.0, 3.0])
    assert one(p, scores.pearson(F.col("model"), F.col("obs")))[0] is None


def test_correlation_uses_common_rows(pairs):
    obs = [1.0, 2.0, None, 4.0, 7.0]
    mod = [1.5, None, 9.0, 4.0, 8.0]
    got = one(pairs(obs, mod), scores.pearson(F.col("model"), F.col("obs")))[0]
    assert got == pytest.approx(np.corrcoef([1, 4, 7], [1.5, 4, 8])[0, 1])


@pytest.mark.parametrize(
    "value,limit,up,want",
    [(90.0, 90, True, "pass"), (89.99, 90, True, "fail"), (1.0, 1, False, "pass"), (1.01, 1, False, "fail"), (None, 0.5, False, "NA")],
)
def test_grading_bounds(spark, value, limit, up, want):
    d = spark.createDataFrame([(value,)], "v double")
    assert d.select(scores.grade(F.col("v"), limit, at_least=up)).first()[0] == want


def test_skill_row_below_the_minimum(pairs):
    r = scores.skill_scalar(pairs([1.0, 2, 3, None, 5], [1.0, 2, 3, 4, 5]), K, x1=1.0).first()
    assert r["status"] == "<5 data points" and r["rmse"] is None and r["central_freq_pass_fail"] == "NA"


def test_skill_row_equals_plain_statistics(spark):
    rng = np.random.default_rng(3)
    n = 500
    obs, mod = 1000 + rng.normal(size=n), 1000.3 + rng.normal(size=n)
    rows = [("a", T0 + 36000 * i, float(o), float(m)) for i, (o, m) in enumerate(zip(obs, mod))]
    rows += [("a", T0 + 36000 * n, None, 1.0), ("b", T0, None, 1.0), ("b", T0 + 60, 2.0, None)]
    df = spark.createDataFrame(rows, "station_id string, t bigint, obs double, model double").selectExpr(
        "station_id", "timestamp_seconds(t) AS ts", "obs", "model"
    )
    r = {x["station_id"]: x for x in scores.skill_scalar(df, K, x1=1.0).collect()}
    e = mod - obs
    assert r["a"]["n_pairs"] == n and r["b"]["n_pairs"] == 0 and r["b"]["rmse"] is None
    assert r["a"]["rmse"] == pytest.approx(np.sqrt((e * e).mean()), abs=0.0051)
    assert r["a"]["bias_std"] == pytest.approx(e.std(), abs=0.0051)
    assert r["a"]["r"] == pytest.approx(np.corrcoef(obs, mod)[0, 1], abs=0.0051)
    assert r["a"]["central_freq"] == pytest.approx(100 * (abs(e) <= 1).mean(), abs=0.0051)


def test_skill_rows_shuffle_the_rows_once(spark, pairs):
    df = pairs([1.0] * 8, [2.0] * 8)
    plan = scores.skill_scalar(df, K, x1=1.0)._jdf.queryExecution().sparkPlan().toString()
    done = scores.skill_scalar(df, K, x1=1.0)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and done.count("Exchange hashpartitioning") == 2


def test_bias_percent_uses_the_rounded_bias(pairs):
    obs, mod = [1.0] * 6, [1.004] * 6
    assert scores.skill_scalar(pairs(obs, mod), K, x1=1.0).first()["bias_perc"] == 0.0
    p = pairs(obs, mod).select("station_id", "ts", F.col("obs").alias("obs_speed"), F.col("model").alias("model_speed"), F.lit(1.0).alias("dir_bias"))
    r = scores.skill_speed(p, K, x1=1.0).first()
    assert r["bias_perc"] == pytest.approx(0.4) and r["bias_dir"] == 1.0


def test_threshold_defaults_and_overrides(spark):
    cfg = spark.createDataFrame([("wl", 0.3, None), ("oxygen", 2.0, 0.5)], "variable string, x1 double, x2 double")
    got = {r["variable"]: (r["x1"], r["x2"]) for r in scores.thresholds(spark, cfg).collect()}
    assert got["wl"] == (0.3, 0.5) and got["cu_dir"] == (22.5, 0.5) and got["oxygen"] == (2.0, 0.5)


@pytest.mark.parametrize(
    "model,obs,want",
    [(350, 10, -20), (10, 350, 20), (180, 0, 180), (0, 180, 180), (90, 90, 0), (1, 359, 2), (359, 1, -2), (200, 10, -170)],
)
def test_signed_angle(spark, model, obs, want):
    d = spark.createDataFrame([(float(model), float(obs))], "m double, o double")
    assert d.select(angles.signed_angle(F.col("m"), F.col("o"))).first()[0] == want


def test_circular_mean_and_correlation(spark):
    d = spark.createDataFrame([(350.0,), (10.0,), (None,)], "a double")
    assert one(d, angles.mean_angle(F.col("a")))[0] == pytest.approx(0, abs=1e-9)
    rng = np.random.default_rng(2)
    a = rng.normal(350, 15, 80) % 360
    b = (a + rng.normal(5, 6, 80)) % 360
    rows = [("a", float(x), float(y)) for x, y in zip(a, b)]
    df = spark.createDataFrame(rows, "station_id string, m double, o double")
    ar, br = np.radians(a), np.radians(b)
    am, bm = (math.atan2(np.sin(x).mean(), np.cos(x).mean()) for x in (ar, br))
    want = (np.sin(ar - am) * np.sin(br - bm)).sum() / math.sqrt((np.sin(ar - am) ** 2).sum() * (np.sin(br - bm) ** 2).sum())
    assert scores.circular_correlation(df, K, "m", "o").first()["circular_r"] == pytest.approx(want)
    flat = spark.createDataFrame([("a", 40.0, 10.0), ("a", 40.0, 20.0), ("a", 40.0, 30.0)], "station_id string, m double, o double")
    assert scores.circular_correlation(flat, K, "m", "o").first()["circular_r"] is None


def test_worst_case_is_strict(spark):
    rows = [(2.1, -0.1, 0.0), (2.0, 0.0, 0.0), (0.5, -0.5, 0.0), (None, 1.0, 0.0)]
    d = spark.createDataFrame(rows, "m double, o double, t double")
    assert one(d, scores.worst_case_frequency(F.col("m"), F.col("o"), F.col("t"), F.lit(1.0)))[0] == pytest.approx(100 / 3)


def test_frame_and_pixel_statistics(spark):
    rng = np.random.default_rng(99)
    o, m = rng.normal(0, 5, (4, 3, 4)), rng.normal(0, 5, (4, 3, 4))
    o[rng.random(o.shape) < 0.2] = np.nan
    m[rng.random(m.shape) < 0.2] = np.nan
    rows = [
        (t, i, j, None if np.isnan(o[t, i, j]) else float(o[t, i, j]), None if np.isnan(m[t, i, j]) else float(m[t, i, j]))
        for t in range(4)
        for i in range(3)
        for j in range(4)
    ]
    df = spark.createDataFrame(rows, "ts int, iy int, ix int, obs double, model double")
    for r in grids.frame_statistics(df).collect():
        t = r["ts"]
        assert r["obs_mean"] == pytest.approx(np.nanmean(o[t])) and r["model_std"] == pytest.approx(np.nanstd(m[t]))
        assert r["rmse"] == pytest.approx(np.sqrt(np.nanmean((m[t] - o[t]) ** 2)))
    d = m - o
    n = (~np.isnan(d)).sum(axis=0)
    for r in grids.pixel_statistics(df).collect():
        i, j = r["iy"], r["ix"]
        if n[i, j] < 2:
            assert r["rmse"] is None and r["central_freq"] is None
        else:
            assert r["diff_max"] == pytest.approx(np.nanmax(d[:, i, j]))
            assert r["central_freq"] == pytest.approx((np.abs(d[:, i, j]) <= 3).sum() / n[i, j] * 100)


def test_exact_percentiles_match_numpy(spark):
    rng = np.random.default_rng(1)
    groups = {"a": rng.normal(0, 1, 501), "b": rng.integers(0, 4, 300).astype(float), "c": np.array([7.0])}
    rows = [(k, float(v)) for k, vs in groups.items() for v in vs]
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    for segments in (1, 7, 64):
        out = {r["k"]: r for r in quantiles.exact_percentiles(df, ["k"], "v", [0.25, 0.5, 0.75], segments=segments).collect()}
        for k, vs in groups.items():
            for q in (25, 50, 75):
                assert out[k][f"q{q}"] == pytest.approx(np.percentile(vs, q))


def test_smoothing_matches_local_fits(spark):
    rng = np.random.default_rng(8)
    y = rng.random(20) * 0.5
    vals = [float(v) for v in y]
    vals[4] = None
    rows = [("s", 1577836800 + i * 86400, v) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "station_id string, t bigint, v double").selectExpr("station_id", "timestamp_seconds(t) AS day", "v")
    out = [r["v_smooth"] for r in ice.smooth_daily(df, K, "day", "v").orderBy("day").collect()]
    filled = y.copy()
    filled[4] = y[5]
    x = np.arange(7)
    for i in range(20):
        lo = min(max(i - 3, 0), 13)
        fit = np.polyval(np.polyfit(x, filled[lo : lo + 7], 2), i - lo)
        assert out[i] is None if i == 4 else out[i] == pytest.approx(fit)
