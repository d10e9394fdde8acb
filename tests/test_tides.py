"""Harmonic analysis on synthetic tides."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from seamark.functions import tidal
from seamark.operators import extrema, tides

K = ["station_id"]
T0 = 1704067200


@pytest.fixture
def tide(series):
    t = np.arange(30 * 24 * 10) / 10.0
    y = 1.0 + 0.5 * np.cos(np.radians(28.9841042 * t - 45)) + 0.2 * np.cos(np.radians(15.0410686 * t - 120))
    return series(y, step=360)


def test_constituents_are_recovered(tide):
    chosen = tides.resolvable(tides.spans(tide, K), K)
    out = {r["constituent"]: r for r in tides.harmonic_analysis(tide.repartition(7), K, chosen, epoch_seconds=T0).collect()}
    assert out["M2"]["amplitude"] == pytest.approx(0.5, rel=0.02) and out["M2"]["phase"] == pytest.approx(45, abs=2)
    assert out["K1"]["amplitude"] == pytest.approx(0.2, rel=0.05) and out["K1"]["phase"] == pytest.approx(120, abs=4)
    assert out["M2"]["mean"] == pytest.approx(1.0, abs=0.02)
    assert out["M2"]["snr"] > 2
    # 30 days: S2 is separable, its close neighbours T2, R2 and K2 are not.
    assert "S2" in out and not {"T2", "R2", "K2"} & set(out)


def test_prediction_reproduces_the_signal(tide):
    chosen = tides.resolvable(tides.spans(tide, K), K, ["M2", "K1"])
    sol = tides.harmonic_analysis(tide, K, chosen, epoch_seconds=T0)
    out = tides.predict(tide, sol, K, epoch_seconds=T0)
    worst = out.agg(F.max(F.abs(F.col("tide") - F.col("value")))).first()[0]
    assert worst < 1e-6
    few = tides.predict(tide, sol, K, epoch_seconds=T0, min_snr=1e13)
    assert few.agg(F.max(F.abs(F.col("tide") - 1.0))).first()[0] < 1e-6


def test_trend_is_told_from_slow_constituents(series):
    t = np.arange(200 * 24.0)
    y = 2.0 + 0.001 * t + 0.5 * np.cos(np.radians(28.9841042 * t - 45))
    df = series(y)
    chosen = tides.resolvable(tides.spans(df, K), K, ["M2", "SSA"])
    sol = tides.harmonic_analysis(df, K, chosen, epoch_seconds=T0)
    out = {r["constituent"]: r for r in sol.collect()}
    assert out["M2"]["slope"] == pytest.approx(0.001, rel=1e-3) and out["SSA"]["amplitude"] < 1e-3
    assert out["M2"]["mean"] == pytest.approx(2.0 + 0.001 * out["M2"]["mid"], abs=1e-3)
    tide = tides.predict(df, sol, K, epoch_seconds=T0)
    assert tide.agg(F.max(F.abs(F.col("tide") - F.col("value")))).first()[0] < 1e-3
    flat = tides.harmonic_analysis(df, K, chosen, epoch_seconds=T0, trend=False).first()
    assert flat["slope"] == 0.0


def test_factors_follow_chunks_not_partitions(spark):
    """Interleaved series cost one factor a series and chunk."""
    rows = [(i % 50, T0 + (i // 50) * 3600, float(i % 7)) for i in range(50 * 800)]
    df = spark.createDataFrame(rows, "station_id int, t long, value double").selectExpr("station_id", "timestamp_seconds(t) AS ts", "value").repartition(8)
    chosen = tides.resolvable(tides.spans(df, K), K, ["M2"])
    month = 30 * 86400
    chunks = {(k, t // month) for k, t, _ in rows}
    whole = tides.triangular_factors(df, K, chosen, epoch_seconds=T0)
    plan = whole._jdf.queryExecution().executedPlan().toString()
    assert whole.count() == 50 and len(chunks) <= 100
    assert "MapInPandas" not in plan and plan.count("FlatMapCoGroupsInPandas") == 1


def test_factors_merge_up_the_tree(spark, monkeypatch):
    """Any cut into chunks and branches gives the R of all rows, also with chunks of fewer rows than columns."""
    monkeypatch.setattr(tides, "BRANCH", 3)
    rng = np.random.default_rng(5)
    y = rng.normal(size=24 * 30)
    df = spark.createDataFrame([("a", T0 + i * 3600, float(v)) for i, v in enumerate(y)], "station_id string, t long, value double").selectExpr("station_id", "timestamp_seconds(t) AS ts", "value")
    chosen = tides.resolvable(tides.spans(df, K), K)
    got = tides.triangular_factors(df, K, chosen, epoch_seconds=T0, chunk_seconds=7 * 3600).first()
    speeds = [r["speed"] for r in chosen.orderBy("priority").collect()]
    h = np.arange(len(y))
    waves = [f(np.radians(s * h)) for s in speeds for f in (np.cos, np.sin)]
    x = np.column_stack([np.ones(len(y)), (h - h.mean()) / 1000, *waves, y])
    assert (got["n"], got["m"]) == x.shape
    r = tides._unpacked(got["upper"], got["m"])
    assert np.allclose(r.T @ r, x.T @ x, rtol=1e-10, atol=1e-8)
    # The last diagonal entry is the length of the residual, and the residual is orthogonal to the basis.
    beta = np.linalg.solve(r[:-1, :-1], r[:-1, -1])
    missed = y - x[:, :-1] @ beta
    assert abs(r[-1, -1]) == pytest.approx(np.linalg.norm(missed), rel=1e-9)
    assert np.abs(x[:, :-1].T @ missed).max() < 1e-8


def test_close_constituents_keep_their_digits(spark):
    """S2 and K2 over 20 days are far from separable; the squared matrix would lose twice the digits."""
    h = np.arange(24 * 20)
    amp, lag = {"S2": 0.7, "K2": 0.2}, {"S2": 40.0, "K2": 100.0}
    speed = {"S2": 30.0, "K2": 30.0821373}
    y = sum(amp[c] * np.cos(np.radians(speed[c] * h - lag[c])) for c in amp)
    df = spark.createDataFrame([("a", T0 + int(i) * 3600, float(v)) for i, v in zip(h, y)], "station_id string, t long, value double").selectExpr("station_id", "timestamp_seconds(t) AS ts", "value")
    chosen = spark.createDataFrame([("a", c, i, speed[c]) for i, c in enumerate(amp)], "station_id string, constituent string, priority int, speed double")
    out = {r["constituent"]: r for r in tides.harmonic_analysis(df, K, chosen, epoch_seconds=T0).collect()}
    for c in amp:
        assert out[c]["amplitude"] == pytest.approx(amp[c], abs=1e-11)
        assert out[c]["phase"] == pytest.approx(lag[c], abs=1e-9)


def test_current_harmonics_share_one_matrix(series):
    t = np.arange(40 * 24.0)
    u = 0.3 + 0.8 * np.cos(np.radians(28.9841042 * t - 30))
    v = 0.4 * np.cos(np.radians(28.9841042 * t - 120))
    df = series(u, column="u").join(series(v, column="v"), ["station_id", "ts"])
    chosen = tides.resolvable(tides.spans(df, K, value="u"), K, ["M2"])
    e = tides.current_ellipses(df, K, chosen, epoch_seconds=T0).first()
    assert (e["major"], abs(e["minor"])) == pytest.approx((0.8, 0.4), abs=1e-5)
    assert np.sin(np.radians(e["theta"])) == pytest.approx(0, abs=1e-5)  # 0 and 180 are one axis


def test_same_speed_constituents_collapse(spark):
    span = spark.createDataFrame([("a", 24.0 * 3650)], "station_id string, span_hours double")
    got = {r["constituent"] for r in tides.resolvable(span, K).collect()}
    assert "2MK3" in got and "MO3" not in got and len(got) == 36


def test_short_records_drop_long_periods(spark):
    span = spark.createDataFrame([("a", 24.0 * 20)], "station_id string, span_hours double")
    got = {r["constituent"] for r in tides.within_record(span, K).collect()}
    assert "SA" not in got and "MM" not in got and "M2" in got


def test_phase_difference_wraps_and_missing_stays_missing(spark):
    s = spark.createDataFrame([("a",)], "station_id string")
    ref = spark.createDataFrame([("a", "M2", 1.0, 350.0)], "station_id string, constituent string, amplitude double, phase double")
    mod = spark.createDataFrame([("a", "M2", 1.0, 10.0), ("a", "S2", 1.0, 0.0)], ref.schema)
    out = {r["constituent"]: r for r in tides.compare_constants(s, ref, mod, K).collect()}
    assert len(out) == 37 and out["M2"]["phase_diff"] == 20.0
    assert out["M2"]["vector_diff"] == pytest.approx(2 * np.sin(np.radians(10)))
    assert out["S2"]["vector_diff"] is None and out["S2"]["amp_diff"] is None


def test_ellipse_of_a_rotary_current(spark):
    u = spark.createDataFrame([("a", "M2", 2.0, 0.0)], "station_id string, constituent string, amplitude double, phase double")
    v = spark.createDataFrame([("a", "M2", 1.0, 90.0)], u.schema)
    r = tides.ellipses(u, v, K).first()
    assert (r["major"], r["minor"], r["theta"] % 180) == (pytest.approx(2), pytest.approx(1), pytest.approx(0))
    t = np.linspace(0, 2 * np.pi, 50)
    v2 = spark.createDataFrame([("a", "M2", 2.0, 180.0)], u.schema)
    r = tides.ellipses(u, v2, K).first()
    assert r["minor"] == pytest.approx(0, abs=1e-12) and r["theta"] == pytest.approx(135)
    assert np.abs(np.hypot(2 * np.cos(t), 2 * np.cos(t - np.pi))).max() == pytest.approx(r["major"])


def test_principal_direction_equals_the_eigenvector(spark):
    rng = np.random.default_rng(3)
    a = rng.normal(0, 3, 200)
    b = rng.normal(0, 0.5, 200)
    th = np.radians(30)
    u, v = a * np.sin(th) + b * np.cos(th), a * np.cos(th) - b * np.sin(th)
    df = spark.createDataFrame([("a", float(x), float(y)) for x, y in zip(u, v)], "station_id string, u double, v double")
    w, e = np.linalg.eigh(np.cov(u, v))
    want = np.degrees(np.arctan2(e[0, -1], e[1, -1])) % 180
    assert extrema.principal_direction(df, K).first()["principal_dir"] == pytest.approx(want)


def test_names_and_codes(spark):
    d = spark.createDataFrame([(" lam2 ",), ("rho",), ("m2",), ("zz",)], "n string")
    assert [r[0] for r in d.select(tidal.standard_name(F.col("n"))).collect()] == ["LDA2", "RHO1", "M2", "ZZ"]
    d = spark.createDataFrame([(0.06, -11.0, 0.01), (None, 1.0, 0.06), (0.0, 0.0, 0.0)], "a double, p double, v double")
    got = [r[0] for r in d.select(tidal.exceedance_codes(F.col("a"), F.col("p"), F.col("v"))).collect()]
    assert got == ["AMP,PHASE", "VD", ""]
