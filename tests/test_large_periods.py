"""Periods: what an explode or arrays make large is merged, not sent through the driver."""

import datetime as dt

from seamark.operators import deployments

DAY = 86400
START = 1704067200


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_boundary_gaps_of_long_short_and_overlapping_periods(spark):
    periods, at = [], START
    for i, days in enumerate([400, 3, 0.5, 40, 0.01, 700]):
        periods.append(("a" if i % 2 else "b", at, at + int(days * DAY)))
        at += int(days * DAY * 0.8) + i * 3600
    obs = [(s, START + k * 40001) for s in "ab" for k in range(2500)]
    p = spark.createDataFrame(periods, "s string, b bigint, e bigint").selectExpr(
        "s", "timestamp_seconds(b) AS period_start", "timestamp_seconds(e) AS period_end"
    )
    o = spark.createDataFrame(obs, "s string, t bigint").selectExpr("s", "timestamp_seconds(t) AS ts")
    out = deployments.boundary_gaps(o, p, ["s"])
    plan = _plan(out)
    assert "Inner, BuildRight" not in plan and "Inner, BuildLeft" not in plan
    got = sorted((r.s, int(r.gap_start.replace(tzinfo=dt.timezone.utc).timestamp()), round(r.hours, 6)) for r in out.selectExpr("s", "CAST(gap_start AS timestamp_ntz) AS gap_start", "hours").collect())
    want = []
    for s in "ab":
        seen = []
        for _, b, e in sorted(q for q in periods if q[0] == s):
            inside = [t for k, t in obs if k == s and b <= t <= e]
            if inside:
                seen.append((min(inside), max(inside)))
        want += [(s, a[1], round((n[0] - a[1]) / 3600, 6)) for a, n in zip(seen, seen[1:])]
    assert got == sorted(want)
