"""Ordered operators against plain Python, for several chunk sizes and partitionings."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from seamark.operators import extrema, fill, pairing, runs, sequence, tides

T0 = 1704067200
K = ["station_id"]


def column(df, name, order="ts"):
    return [r[name] for r in df.orderBy(*K, order).collect()]


@pytest.mark.parametrize("chunk", [3600, 5 * 3600, 10**9])
@pytest.mark.parametrize("parts", [1, 7])
def test_scan_does_not_depend_on_chunks_or_partitions(series, chunk, parts):
    rng = np.random.default_rng(3)
    vals = [None if rng.random() < 0.4 else float(rng.integers(0, 9)) for _ in range(60)]
    df = series(vals).repartition(parts)
    out = sequence.scan(
        df,
        K,
        ["ts"],
        totals={"total": F.col("value")},
        prior={"p": F.col("value")},
        following={"f": F.col("value")},
        row_number="rn",
        chunk_seconds=chunk,
    ).orderBy("ts").collect()
    s = pd.Series([np.nan if v is None else v for v in vals])
    prior, nxt = s.ffill().shift(1), s.bfill().shift(-1)
    total = s.fillna(0).cumsum()
    for i, r in enumerate(out):
        assert r["rn"] == i + 1
        assert (r["p"] is None) == np.isnan(prior[i]) and (r["p"] is None or r["p"] == prior[i])
        assert (r["f"] is None) == np.isnan(nxt[i]) and (r["f"] is None or r["f"] == nxt[i])
        if r["total"] is not None:
            assert r["total"] == pytest.approx(total[i])
        else:
            assert s[: i + 1].isna().all()
        if r["p"] is not None:
            assert vals[r["p__rn"] - 1] == r["p"]


def reference_fill(vals):
    s = pd.Series([np.nan if v is None else float(v) for v in vals])
    return s.interpolate(method="linear", limit=3).ffill(limit=1).bfill(limit=1)


@pytest.mark.parametrize("chunk", [2 * 3600, 10**9])
def test_bounded_fill_matches_pandas(series, chunk):
    rng = np.random.default_rng(11)
    cases = [
        [None, None, 1] + [None] * 7 + [2] + [None] * 6,
        [None if rng.random() < 0.7 else float(rng.integers(0, 50)) for _ in range(200)],
    ]
    for vals in cases:
        out = fill.fill_linear(series(vals), K, "ts", "value", limit=3, edges=True, chunk_seconds=chunk)
        got = [np.nan if v is None else v for v in column(out, "value")]
        np.testing.assert_allclose(got, reference_fill(vals).to_numpy())


def test_equal_interval_fills_up_to_the_gap_limit(series):
    vals = [1.0] + [None] * 8 + [10.0]
    out = fill.to_equal_interval(series(vals), K, "ts", "value", step_seconds=3600, max_gap_hours=6, method="linear")
    got = column(out, "value")
    assert got[:7] == pytest.approx([1, 2, 3, 4, 5, 6, 7])
    assert got[7] is None and got[8] is None and got[9] == 10


def test_cubic_fill_follows_a_smooth_curve(series):
    t = np.arange(48)
    y = np.sin(2 * np.pi * t / 24)
    vals = [None if i % 6 in (3, 4) and 6 < i < 42 else float(v) for i, v in enumerate(y)]
    for chunk in (5 * 3600, 10**9):
        line, cubic = (
            np.array(column(fill.to_equal_interval(series(vals), K, "ts", "value", step_seconds=3600, method=m, chunk_seconds=chunk), "value"))
            for m in ("linear", "cubic")
        )
        assert np.abs(cubic - y).max() < 0.5 * np.abs(line - y).max()
    ramp = [0.0, 1.0, None, None, 4.0, None, 6.0]
    out = fill.to_equal_interval(series(ramp), K, "ts", "value", step_seconds=3600, method="cubic")
    assert column(out, "value") == pytest.approx([0, 1, 2, 3, 4, 5, 6])


def test_spline_reproduces_a_cubic_and_stays_inside(series):
    t = np.arange(40.0)
    y = 0.01 * t**3 - 0.2 * t**2 + t
    vals = [None if i in (0, 5, 6, 7, 20, 21, 39) else float(v) for i, v in enumerate(y)]
    got = column(fill.to_equal_interval(series(vals), K, "ts", "value", step_seconds=3600), "value")
    assert got[0] is None and got[39] is None
    assert got[1:39] == pytest.approx(y[1:39])
    long = [0.0, 1.0, 0.0] + [None] * 8 + [3.0, 1.0]
    got = column(fill.to_equal_interval(series(long), K, "ts", "value", step_seconds=3600), "value")
    assert all(v is not None for v in got[3:9]) and got[9] is None and got[10] is None


def test_spline_of_few_knots(series):
    for vals, want in (([1.0, None, 3.0], [1, 2, 3]), ([0.0, None, 4.0, 9.0], [0, 1, 4, 9]), ([None, 5.0, None], [None, 5, None])):
        got = column(fill.to_equal_interval(series(vals), K, "ts", "value", step_seconds=3600), "value")
        assert got == pytest.approx(want)


def test_spline_in_groups_of_knots_equals_one_solution(series, monkeypatch):
    rng = np.random.default_rng(8)
    vals = [None if i and i < 499 and rng.random() < 0.3 else float(rng.normal()) for i in range(500)]
    whole = column(fill.to_equal_interval(series(vals), K, "ts", "value", step_seconds=3600), "value")
    monkeypatch.setattr(fill, "KNOTS", 40)
    parts = column(fill.to_equal_interval(series(vals), K, "ts", "value", step_seconds=3600, chunk_seconds=50 * 3600), "value")
    np.testing.assert_allclose(np.array(parts, float), np.array(whole, float), atol=1e-9)


def test_places_in_the_order_of_all_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, float(rng.integers(0, 40))) for i in range(1000)]
    got = sequence.placed(spark.createDataFrame(rows, "id int, v double").repartition(5), ["v", "id"]).collect()
    want = {i: k + 1 for k, (i, _) in enumerate(sorted(rows, key=lambda r: (r[1], r[0])))}
    assert {r["id"]: r["place"] for r in got} == want


def test_group_median_counts_values(spark):
    df = spark.createDataFrame([("a", 1), ("a", 5), ("a", 5), ("a", 9), ("b", 2), ("b", 3), ("b", None), ("c", None)], "k string, v int")
    assert {r["k"]: r["m"] for r in sequence.group_median(df, ["k"], "v", "m").collect()} == {"a": 5.0, "b": 2.5, "c": None}


def test_median_interval_and_gaps(series):
    df = series([1, 2, 3, None, 5, 6])
    holes = df.filter("value IS NOT NULL")
    assert fill.median_interval(holes, K, "ts").first()["dt_hours"] == 1.0
    gap = fill.time_gaps(holes, K, "ts", 3600).collect()
    assert len(gap) == 1 and gap[0]["seconds"] == 7200


def test_longest_runs_break_on_missing(series):
    e = [3, 3, None, 3, 3, 3, 0, -5, -5, 3]
    df = series(e, column="e")
    for chunk in (3600, 10**9):
        out = runs.outlier_durations(df, K, "ts", F.col("e"), F.lit(1.0), chunk_seconds=chunk).first()
        assert (out["max_pos_rows"], out["max_neg_rows"]) == (3, 2)
        assert out["max_pos_hours"] == 3.0


@pytest.mark.parametrize("chunk", [50, 700, 10**9])
def test_runs_and_interval_equal_plain_loops(spark, chunk):
    rng = np.random.default_rng(chunk)
    rows = []
    for station in ("a", "b", None, "c"):
        size = {"a": 400, "b": 150, None: 60, "c": 1}[station]
        times = np.cumsum(rng.choice([0, 6, 6, 6, 60, 333], size)).tolist()
        errors = [None if x == 9 else float(x) for x in rng.choice([3, 3, 3, 3, -4, -4, 0, 9], size)]
        rows += [(station, 1704067200 + t, i, e) for i, (t, e) in enumerate(zip(times, errors))]
    df = spark.createDataFrame(rows, "station_id string, t bigint, seq int, e double").selectExpr(
        "station_id", "timestamp_seconds(t) AS ts", "seq", "e"
    )
    got = runs.outlier_durations(df.repartition(7), K, "ts", F.col("e"), F.lit(1.5), tie=["seq"], chunk_seconds=chunk)

    def longest(flags):
        best = here = 0
        for f in flags:
            here = here + 1 if f else 0
            best = max(best, here)
        return best

    found = {r["station_id"]: r for r in got.collect()}
    assert len(found) == 4
    for station, r in found.items():
        own = [x for x in rows if x[0] == station]
        assert r["max_pos_rows"] == longest(x[3] is not None and x[3] >= 3 for x in own)
        assert r["max_neg_rows"] == longest(x[3] is not None and x[3] <= -3 for x in own)
        if len(own) > 1:
            step = np.median(np.diff([x[1] for x in own]))
            assert r["max_pos_hours"] == pytest.approx(r["max_pos_rows"] * step / 3600)
        else:
            assert r["max_pos_hours"] is None


def test_rows_without_a_time_come_first(spark):
    rows = [("a", None, 0, 5.0), ("a", None, 1, 5.0), ("a", 1704067200, 2, 5.0), ("a", 1704067260, 3, 0.0)]
    df = spark.createDataFrame(rows, "station_id string, t bigint, seq int, e double").selectExpr(
        "station_id", "timestamp_seconds(t) AS ts", "seq", "e"
    )
    r = runs.outlier_durations(df, K, "ts", F.col("e"), F.lit(1.0), tie=["seq"]).first()
    assert r["max_pos_rows"] == 3 and r["max_pos_hours"] == pytest.approx(3 / 60)
    empty = runs.outlier_durations(df.limit(0), K, "ts", F.col("e"), F.lit(1.0), tie=["seq"])
    assert empty.count() == 0


def test_longest_gap_counts_adjacent_pairs(series):
    out = runs.longest_gap(series([1, None, None, None, 2, None]), K, "ts", F.col("value")).first()
    assert (out["gap_rows"], out["gap_pairs"]) == (3, 2)
    out = runs.longest_gap(series([1, 2]), K, "ts", F.col("value")).first()
    assert (out["gap_rows"], out["gap_pairs"]) == (0, 0)


def test_slack_water_ends_at_the_next_row(series):
    out = runs.slack_water(series([1, 0.1, 0.1, 1, None, 0.2], column="speed"), K).orderBy("start_ts").collect()
    assert [r["hours"] for r in out] == [2.0, 0.0]


def test_merge_intervals_and_gaps(spark):
    rows = [("a", 0, 10), ("a", 5, 12), ("a", 12, 15), ("a", 20, 30), ("a", 40, None), ("b", 1, 2)]
    df = spark.createDataFrame(rows, "station_id string, s bigint, e bigint").selectExpr(
        "station_id", "timestamp_seconds(s) AS s", "timestamp_seconds(e) AS e"
    )
    m = runs.merge_intervals(df, K, "s", "e")
    got = sorted((r["station_id"], r["s"].second, None if r["e"] is None else r["e"].second) for r in m.collect())
    assert got == [("a", 0, 15), ("a", 20, 30), ("a", 40, None), ("b", 1, 2)]
    g = runs.interval_gaps(m, K, "s", "e", F.timestamp_seconds(F.lit(17)), F.timestamp_seconds(F.lit(35)))
    assert sorted((r["gap_start"].second, r["gap_end"].second) for r in g.collect()) == [(17, 20), (30, 35)]


@pytest.mark.parametrize("chunk", [6 * 3600, 30 * 86400])
def test_water_level_extrema(series, chunk):
    t = np.arange(24 * 10)
    y = np.cos(2 * np.pi * t / 12.42)
    vals = list(y)
    vals[62] = None  # next to the maximum at hour 62: it disqualifies the peak
    out = extrema.water_level_extrema(series(vals), K, step_seconds=3600, chunk_seconds=chunk)
    got = {(int(r["ts"].timestamp()) - T0) // 3600: r["kind"] for r in out.collect()}
    want = {}
    for i in range(1, len(vals) - 1):
        lo, hi = max(0, i - 4), min(len(vals), i + 5)
        win = vals[lo:hi]
        if None in win:
            continue
        others = win[: i - lo] + win[i - lo + 1 :]
        if vals[i] > max(others):
            want[i] = "high"
        elif vals[i] < min(others):
            want[i] = "low"
    assert got == want
    assert 62 not in got


def greedy(model, obs, reach):
    claimed, out = set(), []
    for m in model:
        near = [(abs(o - m), o) for o in obs if o not in claimed and abs(o - m) <= reach]
        pick = min(near)[1] if near else None
        if pick is not None:
            claimed.add(pick)
        out.append(pick)
    return out


@pytest.mark.parametrize("seed", range(6))
def test_event_pairing_equals_the_greedy_rule(spark, seed):
    rng = np.random.default_rng(seed)

    def times(n):
        return np.cumsum(rng.integers(41, 75, n)).tolist()  # 4.1 h and more apart, in tenths

    model, obs = times(120), times(120)

    def table(ts):
        return spark.createDataFrame([("a", T0 + int(x) * 360, float(x)) for x in ts], "station_id string, t bigint, value double").selectExpr(
            "station_id", "timestamp_seconds(t) AS ts", "value"
        )

    out = extrema.pair_events(table(model), table(obs), K, chunk_seconds=20 * 3600).orderBy("ts").collect()
    got = [None if r["obs_value"] is None else int(r["obs_value"]) for r in out]
    assert got == greedy(model, obs, 30)


def event_rows(spark, series):
    """Events at tenths of hours, in rows (key, tenths, value)."""
    df = spark.createDataFrame([(k, T0 + int(t) * 360, float(v)) for k, t, v in series], "station_id string, t bigint, value double")
    return df.selectExpr("station_id", "timestamp_seconds(t) AS ts", "value")


def greedy_rows(model, obs, reach):
    """(key, time, observed value) of the greedy rule on rows (key, time, value), with equal times by value."""
    out = []
    for key in {k for k, *_ in model}:
        free = sorted((t, v) for k, t, v in obs if k == key)
        for t, v in sorted((t, v) for k, t, v in model if k == key):
            near = [(abs(o - t), o, i) for i, (o, _) in enumerate(free) if abs(o - t) <= reach]
            out.append((key, t, v, free.pop(min(near)[2])[1] if near else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("hours", [1.0, 3.0])
def test_event_pairing_of_dense_events(spark, seed, hours):
    """Any spacing, equal times included, several series (one without a name), chunks near the tolerance."""
    rng = np.random.default_rng(seed)
    model, obs = ([(k, t, n + i / 1000) for k in ("a", "b", None) for i, t in enumerate(np.cumsum(rng.integers(0, 9, 150)).tolist())] for n in (1, 2))
    out = extrema.pair_events(event_rows(spark, model), event_rows(spark, obs), K, tolerance_hours=hours, chunk_seconds=4 * 3600).collect()
    got = sorted([(r["station_id"], int((r["ts"].timestamp() - T0) / 360), r["model_value"], r["obs_value"]) for r in out], key=repr)
    assert got == greedy_rows(model, obs, hours * 10)


def test_event_pairing_where_one_claim_moves_through_every_chunk(spark):
    """Every model event loses its nearest event to the one before it, so a wrong guess would never end by itself."""
    model = [("a", 0, 0.0), *[("a", 1 + 10 * i, float(i)) for i in range(40)]]
    obs = [("a", 10 * i, float(i)) for i in range(45)]
    out = extrema.pair_events(event_rows(spark, model), event_rows(spark, obs), K, tolerance_hours=1.0, chunk_seconds=8 * 3600).collect()
    got = sorted([("a", int((r["ts"].timestamp() - T0) / 360), r["model_value"], r["obs_value"]) for r in out], key=repr)
    want = greedy_rows(model, obs, 10)
    assert got == want and sum(r[3] == r[2] + 1 for r in want) == 40


def test_event_pairing_of_no_events(spark):
    none, some = event_rows(spark, []), event_rows(spark, [("a", 0, 1.0)])
    assert extrema.pair_events(none, some, K).count() == 0
    r = extrema.pair_events(some, none, K).collect()
    assert [(x["model_value"], x["obs_value"], x["obs_ts"]) for x in r] == [(1.0, None, None)]


def test_asof_nearest(spark):
    left = spark.createDataFrame([("a", 100), ("a", 500), ("a", 1000)], "station_id string, t bigint").selectExpr("station_id", "timestamp_seconds(t) AS ts")
    right = spark.createDataFrame([("a", 60, 1.0), ("a", 140, 2.0), ("a", 690, 3.0)], "station_id string, t bigint, value double").selectExpr(
        "station_id", "timestamp_seconds(t) AS ts", "value"
    )
    for chunk in (150, 10**9):
        out = pairing.asof_nearest(left, right, K, tolerance_seconds=180, chunk_seconds=chunk)
        assert column(out, "matched_value") == [1.0, None, None]


def test_persistence_forecast(series, spark):
    n, off = 60, 0.3
    rows = [("a", T0 + i * 3600, (None if 30 <= i < 58 else float(np.sin(i) + off)), float(np.sin(i))) for i in range(n)]
    df = spark.createDataFrame(rows, "station_id string, t bigint, obs double, tide double").selectExpr("station_id", "timestamp_seconds(t) AS ts", "obs", "tide")
    for chunk in (5 * 3600, 10**9):
        out = tides.persistence_forecast(df, K, step_seconds=3600, chunk_seconds=chunk).orderBy("ts").collect()
        assert all(r["forecast"] is None for r in out[:24])
        assert out[24]["forecast"] == pytest.approx(np.sin(24) + off)
        # Offsets exist while the last 24 rows hold a residual, then for 6 rows more.
        assert out[53]["offset"] == pytest.approx(off)


def test_lowpass_equals_the_full_transform(series):
    rng = np.random.default_rng(5)
    for n in (1, 2, 240, 241, 50, 330, 4999):
        y = np.sin(2 * np.pi * np.arange(n) / 12.42) + 0.01 * np.arange(n) + rng.random(n)
        f = np.fft.rfftfreq(n, d=1.0)
        spec = np.fft.rfft(y)
        spec[f > 1 / 25] = 0
        want = np.fft.irfft(spec, n)
        for rows in (1, 2000):
            out = tides.fourier_lowpass(series(y), K, step_seconds=3600, block_rows=rows)
            np.testing.assert_allclose(column(out, "lowpass"), want, atol=1e-9)


def test_lowpass_of_several_series_and_cutoffs(spark):
    rng = np.random.default_rng(6)
    sizes = {"a": 5000, "b": 2048, "c": 40}
    values = {k: 1e3 + np.cumsum(rng.normal(size=n)) for k, n in sizes.items()}
    rows = [(k, 1704067200 + 360 * i, float(v)) for k, y in values.items() for i, v in enumerate(y)]
    df = spark.createDataFrame(rows, "station_id string, t bigint, value double").selectExpr(
        "station_id", "timestamp_seconds(t) AS ts", "value"
    )
    for cutoff in (0.05, 0.3, 25.0, 1e6):
        out = tides.fourier_lowpass(df.repartition(5), K, step_seconds=360, cutoff_hours=cutoff, block_rows=64).toPandas()
        assert len(out) == len(rows)
        for k, y in values.items():
            spec = np.fft.rfft(y)
            spec[np.fft.rfftfreq(len(y), d=0.1) > 1 / cutoff + 1e-12] = 0
            got = out[out["station_id"] == k].sort_values("ts")["lowpass"].to_numpy()
            np.testing.assert_allclose(got, np.fft.irfft(spec, len(y)), atol=1e-8)


def test_lowpass_refuses_gaps(series):
    for vals in ([1.0, None, 2.0], None):
        df = series([1.0, 2.0, 3.0]).filter("value <> 2") if vals is None else series(vals)
        with pytest.raises(Exception, match="without gaps"):
            tides.fourier_lowpass(df, K, step_seconds=3600).collect()


def test_keep_first_last_and_unique(spark):
    df = spark.createDataFrame([("a", 1, 10.0), ("a", 2, 20.0), ("b", 3, 30.0)], "k string, seq int, v double")
    assert {r["v"] for r in sequence.keep_first(df, ["k"], ["seq"]).collect()} == {10.0, 30.0}
    assert {r["v"] for r in sequence.keep_first(df, ["k"], ["seq"], last=True).collect()} == {20.0, 30.0}
    assert [r["v"] for r in sequence.unique_only(df.select("k", "v"), ["k"]).collect()] == [30.0]


def test_onset_and_thaw(spark):
    vals = [0, 12, 12, 12, 12, 12, 30, 5, None, 2, 1, 0, 0]
    rows = [("a", 1577836800 + i * 86400, None if v is None else float(v)) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "station_id string, t bigint, v double").selectExpr("station_id", "timestamp_seconds(t) AS day", "v")
    out = runs.onset_and_thaw(df, K, "day", "v").first()
    assert (int(out["onset"].timestamp()) - 1577836800) // 86400 == 5
    assert (int(out["thaw"].timestamp()) - 1577836800) // 86400 == 11
