"""Extrema, event pairing, filters and harmonics: queries with SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from seamark.functions import angles, tidal
from seamark.operators import extrema, fill, pairing, scores, tides
from seamark.plans.demo import r6, secs, view
from seamark.plans.registry import query
from seamark.plans.score_queries import SPLINE_CTES, SPLINE_VALUE

K = ["station_id"]
T0 = 1704067200

# Strict extrema within +-4 rows of an hourly gap-free series.
_EXT = """
{n}_b AS (SELECT station_id, t, {v} AS v, count(*) OVER w n, count({v}) OVER w c,
   max({v}) OVER wp pmax, max({v}) OVER wf fmax, min({v}) OVER wp pmin, min({v}) OVER wf fmin,
   min(t) OVER (PARTITION BY station_id) lo, max(t) OVER (PARTITION BY station_id) hi
 FROM {src} WINDOW w AS (PARTITION BY station_id ORDER BY t RANGE BETWEEN 14400 PRECEDING AND 14400 FOLLOWING),
  wp AS (PARTITION BY station_id ORDER BY t RANGE BETWEEN 14400 PRECEDING AND 1 PRECEDING),
  wf AS (PARTITION BY station_id ORDER BY t RANGE BETWEEN 1 FOLLOWING AND 14400 FOLLOWING)),
{n} AS (SELECT station_id, t, v, CASE WHEN v > pmax THEN 'high' ELSE 'low' END AS kind FROM {n}_b
  WHERE n = c AND t <> lo AND t <> hi AND ((v > pmax AND v > fmax) OR (v < pmin AND v < fmin)))"""


def _levels(spark, sf_dir, column):
    return view(spark, sf_dir, "v_tide").select(*K, "ts", F.col(column).alias("value"))


@query(
    "win06_water_level_extrema",
    "WITH " + _EXT.format(n="x", v="obs", src="v_tide")
    + " SELECT station_id, t, round(v, 6) AS value, kind FROM x",
)
def _win06(spark, sf_dir):
    out = extrema.water_level_extrema(_levels(spark, sf_dir, "obs"), K, step_seconds=3600)
    return out.select(*K, secs("ts", "t"), r6("value"), "kind")


_PD = """pd AS (SELECT station_id, fmod(0.5 * degrees(atan2(2 * covar_samp(u, v), var_samp(v) - var_samp(u))) + 180, 180) AS p
  FROM (SELECT station_id, obs_speed * sin(radians(obs_dir)) u, obs_speed * cos(radians(obs_dir)) v FROM v_currents)
  GROUP BY 1)"""


def _currents(spark, sf_dir):
    c = view(spark, sf_dir, "v_currents").select(
        *K, "ts", F.col("obs_speed").alias("speed"), F.col("obs_dir").alias("direction")
    )
    uv = c.select(
        *K,
        angles.east(F.col("speed"), F.col("direction")).alias("u"),
        angles.north(F.col("speed"), F.col("direction")).alias("v"),
    )
    return c, extrema.principal_direction(uv, K)


@query(
    "agg44_principal_direction",
    f"WITH {_PD} SELECT station_id, round(p, 6) AS principal_dir FROM pd",
)
def _agg44(spark, sf_dir):
    return _currents(spark, sf_dir)[1].select(*K, r6("principal_dir"))


@query(
    "win07_current_extrema",
    f"WITH {_PD}, al AS (SELECT c.station_id, t, obs_speed * cos(radians(obs_dir - p)) AS a FROM v_currents c JOIN pd USING (station_id)),"
    + _EXT.format(n="x", v="a", src="al")
    + """ SELECT station_id, t, round(v, 6) AS along, CASE WHEN kind = 'high' THEN 'flood' ELSE 'ebb' END AS kind
        FROM x WHERE (kind = 'high' AND v > 0) OR (kind = 'low' AND v < 0)""",
)
def _win07(spark, sf_dir):
    c, p = _currents(spark, sf_dir)
    out = extrema.current_extrema(c, K, principal=p, step_seconds=3600)
    return out.select(*K, secs("ts", "t"), r6("along"), "kind")


# The SQL pairing covers isolated and chained events: mutual claims resolved by recursion in time order.
_PAIR = (
    "WITH RECURSIVE "
    + _EXT.format(n="mo", v="model", src="v_tide")
    + ","
    + _EXT.format(n="ob", v="obs", src="v_tide")
    + """,
 m AS (SELECT *, row_number() OVER (PARTITION BY station_id, kind ORDER BY t) i FROM mo),
 c AS (SELECT m.station_id, m.kind, m.i, m.t, m.v AS mv, o.t AS ot, o.v AS ov,
   row_number() OVER (PARTITION BY m.station_id, m.kind, m.i ORDER BY abs(o.t - m.t), o.t) pref
   FROM m JOIN ob o ON o.station_id = m.station_id AND o.kind = m.kind AND abs(o.t - m.t) <= 10800),
 p AS (SELECT m.station_id, m.kind, m.i, m.t, m.v AS mv, a.ot AS o1, a.ov AS v1, b.ot AS o2, b.ov AS v2
   FROM m LEFT JOIN c a ON a.station_id = m.station_id AND a.kind = m.kind AND a.i = m.i AND a.pref = 1
          LEFT JOIN c b ON b.station_id = m.station_id AND b.kind = m.kind AND b.i = m.i AND b.pref = 2),
 g AS (SELECT station_id, kind, i, t, mv, o1 AS ot, v1 AS ov FROM p WHERE i = 1
   UNION ALL
   SELECT p.station_id, p.kind, p.i, p.t, p.mv,
     CASE WHEN p.o1 IS DISTINCT FROM g.ot THEN p.o1 ELSE p.o2 END,
     CASE WHEN p.o1 IS DISTINCT FROM g.ot THEN p.v1 ELSE p.v2 END
   FROM g JOIN p ON p.station_id = g.station_id AND p.kind = g.kind AND p.i = g.i + 1)"""
)


def _matches(spark, sf_dir):
    keys = [*K, "kind"]
    m = extrema.water_level_extrema(_levels(spark, sf_dir, "model"), K, step_seconds=3600)
    o = extrema.water_level_extrema(_levels(spark, sf_dir, "obs"), K, step_seconds=3600)
    return m, o, extrema.pair_events(m, o, keys), keys


@query(
    "joi18_event_pairing",
    _PAIR + " SELECT station_id, kind, t, ot AS obs_t, round(ov - mv, 6) AS obs_minus_model FROM g",
)
def _joi18(spark, sf_dir):
    _, _, out, keys = _matches(spark, sf_dir)
    return out.select(
        *keys,
        secs("ts", "t"),
        secs("obs_ts", "obs_t"),
        F.round(F.col("obs_value") - F.col("model_value"), 6).alias("obs_minus_model"),
    )


@query(
    "agg18_skill_extrema",
    _PAIR
    + """ SELECT station_id, kind, count(mv - ov) AS n_pairs, round_even(sqrt(avg((mv-ov)*(mv-ov))), 2) AS rmse,
      round_even(avg(mv - ov), 2) AS bias,
      round_even(100.0 * count(*) FILTER (abs(mv-ov) <= 15e-2) / count(mv-ov), 2) AS central_freq,
      round_even(sqrt(avg(((t-ot)/3600)*((t-ot)/3600))), 2) AS timing_rmse,
      round_even(100.0 * count(*) FILTER (abs((t-ot)/3600) <= 5e-1) / count(ot), 2) AS timing_central_freq
      FROM g GROUP BY 1, 2 HAVING count(mv - ov) > 0""",
)
def _agg18(spark, sf_dir):
    _, _, out, keys = _matches(spark, sf_dir)
    return (
        scores.skill_extrema(out, keys, x1=0.15)
        .filter("n_pairs > 0")
        .select(*keys, "n_pairs", "rmse", "bias", "central_freq", "timing_rmse", "timing_central_freq")
    )


@query(
    "agg19_detection_counts",
    _PAIR
    + """, a AS (SELECT station_id, kind, count(*) n FROM mo GROUP BY 1, 2), b AS (SELECT station_id, kind, count(*) n FROM ob GROUP BY 1, 2),
      d AS (SELECT station_id, kind, count(ot) n FROM g GROUP BY 1, 2)
      SELECT coalesce(a.station_id, b.station_id) AS station_id, coalesce(a.kind, b.kind) AS kind,
       coalesce(a.n, 0) AS n_model, coalesce(b.n, 0) AS n_obs, coalesce(d.n, 0) AS n_matched
      FROM a FULL JOIN b ON a.station_id = b.station_id AND a.kind = b.kind
      LEFT JOIN d ON d.station_id = a.station_id AND d.kind = a.kind""",
)
def _agg19(spark, sf_dir):
    m, o, out, keys = _matches(spark, sf_dir)
    return extrema.detection_counts(m, o, out, keys)


@query(
    "win09_persistence_forecast",
    """WITH r AS (SELECT station_id, t, tide, obs - tide AS res, row_number() OVER (PARTITION BY station_id ORDER BY t) rn FROM v_tide),
     o AS (SELECT *, CASE WHEN rn > 24 THEN avg(res) OVER (PARTITION BY station_id ORDER BY t ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) END AS off FROM r)
     SELECT station_id, t, round(tide + last_value(off IGNORE NULLS) OVER (PARTITION BY station_id ORDER BY t
       ROWS BETWEEN 5 PRECEDING AND CURRENT ROW), 6) AS forecast FROM o""",
)
def _win09(spark, sf_dir):
    t = view(spark, sf_dir, "v_tide")
    out = tides.persistence_forecast(t, K, step_seconds=3600)
    return out.select(*K, secs("ts", "t"), r6("forecast"))


@query(
    "win10_nontidal_residual",
    "SELECT station_id, t, round(obs - tide, 9) AS residual FROM v_tide",
)
def _win10(spark, sf_dir):
    t = view(spark, sf_dir, "v_tide")
    out = tides.residual(t.drop("tide", "model"), t.select(*K, "ts", "tide"), K)
    return out.select(*K, secs("ts", "t"), F.round("residual", 9).alias("residual"))


@query(
    "win11_fourier_lowpass",
    """WITH s AS (SELECT station_id, t, model AS v, count(*) OVER (PARTITION BY station_id) n,
        row_number() OVER (PARTITION BY station_id ORDER BY t) - 1 AS i FROM v_tide),
     k AS (SELECT station_id, n, unnest(range(0, CAST(floor(least(n / 2, n / 25.0)) AS BIGINT) + 1)) AS k
        FROM (SELECT DISTINCT station_id, n FROM s)),
     c AS (SELECT s.station_id, k.k, sum(v * cos(2 * pi() * ((k * i) % s.n) / s.n)) re,
          sum(v * sin(2 * pi() * ((k * i) % s.n) / s.n)) im FROM s JOIN k ON s.station_id = k.station_id GROUP BY 1, 2)
     SELECT s.station_id, s.t, round(sum((CASE WHEN k = 0 OR 2 * k = s.n THEN 1 ELSE 2 END)
        * (re * cos(2 * pi() * ((k * i) % s.n) / s.n) + im * sin(2 * pi() * ((k * i) % s.n) / s.n))) / any_value(s.n), 6) AS lowpass
     FROM s JOIN c ON s.station_id = c.station_id GROUP BY 1, 2""",
)
def _win11(spark, sf_dir):
    s = _levels(spark, sf_dir, "model")
    out = tides.fourier_lowpass(s, K, step_seconds=3600)
    return out.select(*K, secs("ts", "t"), r6("lowpass"))


_CONST = ", ".join(f"('{n}', {i}, {s}e0)" for i, (n, s) in enumerate(tidal.CONSTITUENT_SPEEDS.items(), 1))
_CT = f"ct(constituent, priority, speed) AS (VALUES {_CONST})"
_SPAN = """sp AS (SELECT station_id, (max(t) - min(t)) / 3600 AS span_hours FROM v_tide WHERE obs IS NOT NULL GROUP BY 1)"""
_RES = """cand AS (SELECT station_id, span_hours, ct.* FROM sp JOIN ct ON span_hours >= 360 / speed),
 lg AS (SELECT *, CASE WHEN (speed - lag(speed) OVER w) / 360 < 9e-1 / span_hours THEN 0 ELSE 1 END fresh FROM cand
   WINDOW w AS (PARTITION BY station_id ORDER BY speed, priority)),
 bl AS (SELECT *, sum(fresh) OVER (PARTITION BY station_id ORDER BY speed, priority) b FROM lg),
 ch AS (SELECT station_id, arg_min(constituent, priority) AS constituent, min(priority) AS priority,
     arg_min(speed, priority) AS speed FROM bl GROUP BY station_id, b)"""


@query(
    "har02_period_filter",
    f"""WITH {_CT}, {_SPAN} SELECT station_id, count(*) AS n_constituents, min(speed) AS slowest
      FROM sp JOIN ct ON span_hours >= 360 / speed GROUP BY 1""",
)
def _har02(spark, sf_dir):
    sp = tides.spans(_levels(spark, sf_dir, "obs"), K)
    return tides.within_record(sp, K).groupBy(*K).agg(
        F.count(F.lit(1)).alias("n_constituents"), F.min("speed").alias("slowest")
    )


@query(
    "har03_rayleigh_filter",
    f"WITH {_CT}, {_SPAN}, {_RES} SELECT station_id, constituent, priority, speed FROM ch",
)
def _har03(spark, sf_dir):
    sp = tides.spans(_levels(spark, sf_dir, "obs"), K)
    return tides.resolvable(sp, K)


@query(
    "flt12_record_length_guard",
    f"WITH {_SPAN} SELECT station_id, round(span_hours / 24, 6) AS days FROM sp WHERE span_hours >= 15 * 24",
)
def _flt12(spark, sf_dir):
    sp = tides.spans(_levels(spark, sf_dir, "obs"), K)
    return sp.filter("span_hours >= 360").select(
        *K, F.round(F.col("span_hours") / 24, 6).alias("days")
    )


def _solution(spark, sf_dir, names=None, column="obs", trend=False):
    s = _levels(spark, sf_dir, column)
    chosen = tides.resolvable(tides.spans(s, K), K, names)
    return tides.harmonic_analysis(s, K, chosen, epoch_seconds=T0, trend=trend), chosen


SPEEDS = {"M2": 28.9841042, "K1": 15.0410686}


def _fit_sql(source: str, values: list[str], names: tuple[str, ...] = ("M2", "K1")) -> str:
    """CTEs ``fit`` (station_id, mid, x): least squares of the value columns of ``source`` on
    1, trend, cos and sin, solved by elimination; x[i][j] is unknown i of value j."""
    h = f"((t - {T0}) / 3600)"
    terms = ["1e0", f"({h} - mid) / 1000"]
    for n in names:
        terms += [f"cos(radians({SPEEDS[n]}e0 * {h}))", f"sin(radians({SPEEDS[n]}e0 * {h}))"]
    p = len(terms)
    valid = " AND ".join(f"{v} IS NOT NULL" for v in values)
    columns = ", ".join(f"{t} AS x{i}" for i, t in enumerate(terms))
    rows = ", ".join("[" + ", ".join([f"sum(x{i} * x{j})" for j in range(p)] + [f"sum(x{i} * {v})" for v in values]) + "]" for i in range(p))
    return f"""ms AS (SELECT station_id, (min(t) + max(t)) / 2 / 3600 - {T0} / 3600 AS mid FROM {source} WHERE {valid} GROUP BY 1),
      ds AS (SELECT station_id, mid, {", ".join(values)}, {columns} FROM {source} JOIN ms USING (station_id) WHERE {valid}),
      el AS (SELECT station_id, any_value(mid) AS mid, 1 AS k, [{rows}] AS m FROM ds GROUP BY 1
        UNION ALL SELECT station_id, mid, k + 1, list_transform(m, lambda r, i: CASE WHEN i = k THEN list_transform(r, lambda x: x / r[k])
          ELSE list_transform(r, lambda x, j: x - r[k] * m[k][j] / m[k][k]) END) FROM el WHERE k <= {p}),
      fit AS (SELECT station_id, mid, list_transform(m, lambda r: r[{p + 1}:]) AS x FROM el WHERE k = {p + 1})"""


def _full_fit_sql(source: str, value: str, name: str) -> str:
    """CTEs ``name`` (station_id, mid, n, constituent, speed, a, b, amplitude, phase, snr, mean, slope): least squares
    of ``value`` on 1, trend and all waves of ``ch``, by elimination of [X'X, X'y, I]."""
    h = f"((t - {T0}) / 3600)"
    return f"""{name}_c AS (SELECT station_id, list(speed ORDER BY priority) sp, list(constituent ORDER BY priority) cn FROM ch GROUP BY 1),
      {name}_m AS (SELECT station_id, (min(t) + max(t)) / 2 / 3600 - {T0} / 3600 AS mid FROM {source} WHERE {value} IS NOT NULL GROUP BY 1),
      {name}_x AS (SELECT station_id, t, CAST(2 + 2 * len(sp) AS INTEGER) AS p, list_concat([1e0, ({h} - mid) / 1000],
          flatten(list_transform(sp, lambda s: [cos(radians(s * {h})), sin(radians(s * {h}))])), [CAST({value} AS DOUBLE)]) AS x
        FROM {source} JOIN {name}_m USING (station_id) JOIN {name}_c USING (station_id) WHERE {value} IS NOT NULL),
      {name}_s AS (SELECT station_id, p, i, j, sum(x[i] * x[j]) AS s FROM (SELECT *, unnest(range(1, p + 2)) AS j
          FROM (SELECT *, unnest(range(1, p + 2)) AS i FROM {name}_x)) GROUP BY 1, 2, 3, 4),
      {name}_g AS (SELECT station_id, p, i, list(s ORDER BY j) AS g FROM {name}_s GROUP BY 1, 2, 3),
      {name}_r AS (SELECT station_id, p, i, list_concat(g, list_transform(range(1, p + 1), lambda u: CASE WHEN u = i THEN 1e0 ELSE 0e0 END)) AS r
        FROM {name}_g),
      {name}_e AS (SELECT station_id, p, 1 AS k, list(r ORDER BY i) AS m FROM {name}_r WHERE i <= p GROUP BY 1, 2
        UNION ALL SELECT station_id, p, k + 1, list_transform(m, lambda r, i: CASE WHEN i = k THEN list_transform(r, lambda v: v / r[k])
          ELSE list_transform(r, lambda v, j: v - r[k] * m[k][j] / m[k][k]) END) FROM {name}_e WHERE k <= p),
      {name}_b AS (SELECT e.station_id, e.p, m, list_transform(m, lambda r: r[e.p + 1]) AS beta, y.r[1] AS sy, y.r[e.p + 1] AS yy, y.r AS xy
        FROM {name}_e e JOIN {name}_r y ON y.station_id = e.station_id AND y.i = e.p + 1 WHERE e.k = e.p + 1),
      {name}_q AS (SELECT x.station_id, count(*) AS n, sum((x.x[x.p + 1] - list_dot_product(x.x[1:x.p], beta)) ** 2) AS missed
        FROM {name}_x x JOIN {name}_b USING (station_id) GROUP BY 1),
      {name}_k AS (SELECT station_id, p, m, beta, mid, n, missed / greatest(n - p, 1) AS sigma2, unnest(range(1, CAST(len(sp) + 1 AS BIGINT))) AS w, sp, cn
        FROM {name}_b JOIN {name}_q USING (station_id) JOIN {name}_m USING (station_id) JOIN {name}_c USING (station_id)),
      {name}_w AS (SELECT station_id, mid, n, sigma2, cn[w] AS constituent, sp[w] AS speed, beta[2 * w + 1] AS a, beta[2 * w + 2] AS b,
          m[2 * w + 1][p + 2 * w + 2] AS va, m[2 * w + 2][p + 2 * w + 3] AS vb, beta[1] AS mean, beta[2] / 1000 AS slope FROM {name}_k),
      {name} AS (SELECT *, sqrt(a * a + b * b) AS amplitude, fmod(degrees(atan2(b, a)) + 360, 360) AS phase,
          (a * a + b * b) / (196e-2 * sqrt(sigma2 * (a * a * va + b * b * vb))) AS snr FROM {name}_w)"""


# One constituent: the 3 x 3 normal equations solved by Cramer's rule.
def _solve_m2(column: str, name: str, where: str = "") -> str:
    return f"""{name}_s AS (SELECT station_id, count(*) n, sum(c) sc, sum(s) ss, sum(c*c) cc, sum(c*s) cs, sum(s*s) s2,
   sum(y) sy, sum(c*y) cy, sum(s*y) sy2 FROM (SELECT station_id, {column} AS y,
     cos(radians(28.9841042e0 * ((t - {T0}) / 3600))) c, sin(radians(28.9841042e0 * ((t - {T0}) / 3600))) s
     FROM v_tide WHERE {column} IS NOT NULL) GROUP BY 1),
 {name}_d AS (SELECT *, n*(cc*s2-cs*cs) - sc*(sc*s2-cs*ss) + ss*(sc*cs-cc*ss) det FROM {name}_s),
 {name} AS (SELECT station_id,
   (sy*(cc*s2-cs*cs) - sc*(cy*s2-cs*sy2) + ss*(cy*cs-cc*sy2)) / det AS mean,
   (n*(cy*s2-cs*sy2) - sy*(sc*s2-cs*ss) + ss*(sc*sy2-cy*ss)) / det AS a,
   (n*(cc*sy2-cy*cs) - sc*(sc*sy2-cy*ss) + sy*(sc*cs-cc*ss)) / det AS b FROM {name}_d WHERE det <> 0)"""


@query(
    "har01_harmonic_m2",
    f"""WITH {_SPAN}, {_solve_m2("obs", "h")}
     SELECT h.station_id, 'M2' AS constituent, round(sqrt(a*a+b*b), 5) AS amplitude,
       round(fmod(degrees(atan2(b, a)) + 360, 360), 4) AS phase, round(mean, 5) AS mean
     FROM h JOIN sp USING (station_id) WHERE span_hours >= 360 / 28.9841042e0""",
)
def _har01(spark, sf_dir):
    sol, _ = _solution(spark, sf_dir, ["M2"])
    return sol.select(
        *K,
        "constituent",
        F.round("amplitude", 5).alias("amplitude"),
        F.round("phase", 4).alias("phase"),
        F.round("mean", 5).alias("mean"),
    )


@query(
    "har01_normal_equations",
    f"""WITH {_CT}, {_SPAN}, {_RES},
     x AS (SELECT v.station_id, v.t, v.obs AS y, ch.constituent, cos(radians(speed * ((t - {T0}) / 3600))) c
        FROM v_tide v JOIN ch ON v.station_id = ch.station_id WHERE obs IS NOT NULL)
     SELECT station_id, round(sum(y * c), 4) AS total FROM x GROUP BY 1""",
)
def _har01n(spark, sf_dir):
    s = _levels(spark, sf_dir, "obs")
    chosen = tides.resolvable(tides.spans(s, K), K)
    cells = tides.normal_equations(s, K, chosen, epoch_seconds=T0)
    # Column j, row i of the upper triangle; keep cosine rows of the last column.
    m = F.col("m")
    col_of = F.sequence(F.lit(1), m - 2, F.lit(2))
    want = F.transform(col_of, lambda i: i * m - (i * (i - 1) / 2).cast("int") + (m - 1 - i))
    return (
        cells.filter(F.array_contains(want, F.col("pos")))
        .groupBy(*K)
        .agg(F.round(F.sum("s"), 4).alias("total"))
    )


@query(
    "har01_harmonic_trend",
    f"""WITH RECURSIVE {_SPAN}, {_fit_sql("v_tide", ["obs"])}, n(constituent, i, speed) AS (VALUES ('M2', 3, 28.9841042e0), ('K1', 5, 15.0410686e0))
     SELECT station_id, constituent, round(sqrt(x[i][1] ** 2 + x[i + 1][1] ** 2), 5) AS amplitude,
       round(x[1][1], 5) AS mean, round(x[2][1], 4) AS slope_per_1000_hours
     FROM fit JOIN sp USING (station_id), n WHERE span_hours >= 360 / 15.0410686e0 AND span_hours >= 360 * 9e-1 / (28.9841042e0 - 15.0410686e0)""",
)
def _har01t(spark, sf_dir):
    sol, chosen = _solution(spark, sf_dir, ["M2", "K1"], trend=True)
    both = chosen.groupBy(*K).count().filter("count = 2")
    return sol.join(both, K, "left_semi").select(
        *K, "constituent", F.round("amplitude", 5).alias("amplitude"), F.round("mean", 5).alias("mean"), F.round(F.col("slope") * 1000, 4).alias("slope_per_1000_hours")
    )


@query(
    "har01_harmonic_analysis_full",
    f"""WITH RECURSIVE {_CT}, {_SPAN}, {_RES}, {_full_fit_sql("v_tide", "obs", "fit")}
     SELECT station_id, constituent, speed, n, mid, round(amplitude, 6) AS amplitude, round(phase, 3) AS phase, round(snr, 4) AS snr,
       round(mean, 6) AS mean, round(slope, 9) AS slope FROM fit""",
)
def _har01f(spark, sf_dir):
    sol, _ = _solution(spark, sf_dir, trend=True)
    digits = {"amplitude": 6, "phase": 3, "snr": 4, "mean": 6, "slope": 9}
    return sol.withColumns({c: F.round(c, d) for c, d in digits.items()})


@query(
    "har04_tide_prediction",
    f"""WITH {_SPAN}, {_solve_m2("obs", "h")}
     SELECT v.station_id, v.t, round(mean + a * cos(radians(28.9841042e0 * ((t - {T0}) / 3600)))
        + b * sin(radians(28.9841042e0 * ((t - {T0}) / 3600))), 5) AS tide
     FROM v_tide v JOIN h USING (station_id) JOIN sp USING (station_id) WHERE span_hours >= 360 / 28.9841042e0""",
)
def _har04(spark, sf_dir):
    sol, _ = _solution(spark, sf_dir, ["M2"])
    times = view(spark, sf_dir, "v_tide").select(*K, "ts")
    out = tides.predict(times, sol, K, epoch_seconds=T0)
    return out.select(*K, secs("ts", "t"), F.round("tide", 5).alias("tide"))


# Harmonic constants derived from customers: amplitude and phase per constituent.
_HC = f"""hc AS (SELECT c_custkey AS station_id, constituent, priority, speed,
   ((c_custkey * 31 + priority * 17) % 200) / 1e2 AS ra, CAST((c_custkey * 7 + priority * 53) % 360 AS DOUBLE) AS rp,
   ((c_custkey * 29 + priority * 19) % 200) / 1e2 AS ma, CAST((c_custkey * 11 + priority * 47) % 360 AS DOUBLE) AS mp
   FROM customer JOIN ct ON (c_custkey + priority) % 3 <> 0)"""


def _constants(spark, sf_dir):
    from seamark.plans.demo import table

    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("station_id"))
    hc = tidal.each_constituent(c).filter((F.col("station_id") + F.col("priority")) % 3 != 0)
    k, p = F.col("station_id"), F.col("priority")

    def side(amp, phase):
        return hc.select(
            *K, "constituent", "speed", (amp % 200 / 100.0).alias("amplitude"), (phase % 360).cast("double").alias("phase")
        )

    return side(k * 31 + p * 17, k * 7 + p * 53), side(k * 29 + p * 19, k * 11 + p * 47)


@query(
    "har05_predict_from_constants",
    f"""WITH {_CT}, {_HC} SELECT o.o_orderkey, round(coalesce(sum(ra * cos(radians(speed *
        ((CAST(floor(epoch(o_orderdate)) AS BIGINT) - 788918400) / 3600) - rp))), 0), 4) AS tide
     FROM orders o JOIN hc ON hc.station_id = o.o_custkey GROUP BY 1""",
)
def _har05(spark, sf_dir):
    from seamark.plans.demo import table

    ref, _ = _constants(spark, sf_dir)
    times = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("station_id"), "o_orderkey", F.col("o_orderdate").alias("ts")
    )
    out = tides.predict_from_constants(
        times,
        ref.select(*K, "constituent", "amplitude"),
        ref.select(*K, "constituent", "phase"),
        K,
        epoch_seconds=788918400,
    )
    return out.select("o_orderkey", F.round("tide", 4).alias("tide"))


_CMP = f"""{_CT}, {_HC}, tb AS (SELECT c_custkey AS station_id, ct.constituent, ct.priority AS n, ra, rp,
   CASE WHEN priority % 5 <> 0 THEN ma END AS ma, CASE WHEN priority % 5 <> 0 THEN mp END AS mp
   FROM customer JOIN ct ON TRUE LEFT JOIN (SELECT station_id, constituent, ra, rp, ma, mp FROM hc) q
   ON q.station_id = c_custkey AND q.constituent = ct.constituent),
 df AS (SELECT *, ma - ra AS ad, fmod(mp - rp + 180 + 360, 360) - 180 AS pd FROM tb),
 vd AS (SELECT *, CASE WHEN ma IS NOT NULL AND ra IS NOT NULL THEN sqrt(greatest(ma*ma + ra*ra - 2*ma*ra*cos(radians(pd)), 0)) END AS v FROM df)"""


def _table(spark, sf_dir):
    ref, mod = _constants(spark, sf_dir)
    keep = [n for n, i, _ in tidal.constituents() if i % 5]
    return ref, mod.filter(F.col("constituent").isin(keep))


@query(
    "har06_compare_constants",
    f"""WITH {_CMP} SELECT station_id, constituent, n, round(ad, 6) AS amp_diff, round(pd, 6) AS phase_diff,
       round(v, 6) AS vector_diff FROM vd""",
)
def _har06(spark, sf_dir):
    ref, mod = _table(spark, sf_dir)
    from seamark.plans.demo import table

    series = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("station_id"))
    out = tides.compare_constants(series, ref, mod, K)
    return out.select(*K, "constituent", "n", r6("amp_diff"), r6("phase_diff"), r6("vector_diff"))


@query(
    "har07_constituent_table",
    f"""WITH {_CMP} SELECT station_id, constituent, round(v, 6) AS vector_diff,
       concat_ws(',', CASE WHEN abs(ad) > 5e-2 THEN 'AMP' END, CASE WHEN abs(pd) > 10 THEN 'PHASE' END,
         CASE WHEN v > 5e-2 THEN 'VD' END) AS exceeds FROM vd""",
)
def _har07(spark, sf_dir):
    from seamark.plans.demo import table

    ref, mod = _table(spark, sf_dir)
    series = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("station_id"))
    even = F.col("station_id") % 2 == 0
    out = tides.constituent_table(
        series, mod, K, accepted=ref.filter(even), observed=ref
    )
    return out.select(*K, "constituent", r6("vector_diff"), "exceeds")


@query(
    "agg43_constituent_summary",
    f"""WITH {_CMP}, j AS (SELECT *, constituent IN ('M2','S2','N2','K2','K1','O1','P1','Q1') AS mj FROM vd WHERE v IS NOT NULL)
     SELECT station_id, round(avg(v), 6) AS mean_vector_diff, round(sqrt(avg(ad*ad)), 6) AS rmse_amp,
       round(avg(v) FILTER (mj), 6) AS mean_vector_diff_major, round(sqrt(avg(pd*pd) FILTER (mj)), 6) AS rmse_phase_major,
       count(*) AS n_valid FROM j GROUP BY 1""",
)
def _agg43(spark, sf_dir):
    from seamark.plans.demo import table

    ref, mod = _table(spark, sf_dir)
    series = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("station_id"))
    t = tides.compare_constants(series, ref, mod, K)
    s = tides.constituent_summary(t, K)
    return s.select(
        *K, r6("mean_vector_diff"), r6("rmse_amp"), r6("mean_vector_diff_major"), r6("rmse_phase_major"), "n_valid"
    )


@query(
    "agg42_prediction_verification",
    """SELECT station_id, count(obs - model) AS n, round(sqrt(avg((obs-model)*(obs-model))), 6) AS rmse,
       round(avg(obs - model), 6) AS mean_diff, round(max(abs(obs - model)), 6) AS max_abs_diff,
       round(corr(obs, CASE WHEN obs IS NOT NULL THEN model END), 6) AS r FROM v_tide GROUP BY 1""",
)
def _agg42(spark, sf_dir):
    t = view(spark, sf_dir, "v_tide")
    # Predictions a minute apart still match within the tolerance.
    theirs = t.select(*K, (F.col("ts") + F.expr("INTERVAL 60 SECONDS")).alias("ts"), "model")
    ours = t.select(*K, "ts", "obs")
    m = pairing.asof_nearest(ours, theirs, K, value="model", tolerance_seconds=180)
    out = tides.verify_predictions(m, K, "obs", "matched_model")
    return out.select(*K, "n", r6("rmse"), r6("mean_diff"), r6("max_abs_diff"), r6("r"))


@query(
    "har08_current_ellipses",
    f"""WITH {_CT}, {_HC}, q AS (SELECT station_id, constituent, ra AS au, radians(rp) AS gu, ma AS av, radians(mp) AS gv FROM hc),
     w AS (SELECT *, sqrt(((au*cos(gu)+av*sin(gv))/2)**2 + ((av*cos(gv)-au*sin(gu))/2)**2) p,
       sqrt(((au*cos(gu)-av*sin(gv))/2)**2 + ((av*cos(gv)+au*sin(gu))/2)**2) m FROM q)
     SELECT station_id, constituent, round(p + m, 6) AS major, round(p - m, 6) AS minor FROM w""",
)
def _har08(spark, sf_dir):
    ref, mod = _constants(spark, sf_dir)
    out = tides.ellipses(ref, mod, K)
    return out.select(*K, "constituent", r6("major"), r6("minor"))


_UV = """uv AS (SELECT station_id, t, obs_speed * sin(radians(obs_dir)) AS u, obs_speed * cos(radians(obs_dir)) AS v FROM v_currents)"""


@query(
    "har08_current_harmonics",
    f"""WITH RECURSIVE {_UV}, {_fit_sql("uv", ["u", "v"])}, n(constituent, i) AS (VALUES ('M2', 3), ('K1', 5)),
     l AS (SELECT station_id FROM uv WHERE u IS NOT NULL GROUP BY 1 HAVING max(t) - min(t) >= 3600 * 360 / 15.0410686e0),
     ab AS (SELECT station_id, constituent, x[i][1] AS ac, x[i + 1][1] AS sc, x[i][2] AS cv, x[i + 1][2] AS sv FROM fit JOIN l USING (station_id), n),
     w AS (SELECT *, sqrt(((ac + sv) / 2) ** 2 + ((cv - sc) / 2) ** 2) AS p, sqrt(((ac - sv) / 2) ** 2 + ((cv + sc) / 2) ** 2) AS q FROM ab)
     SELECT station_id, constituent, round(p + q, 5) AS major, round(p - q, 5) AS minor FROM w""",
)
def _har08h(spark, sf_dir):
    s, d = F.col("obs_speed"), F.col("obs_dir")
    uv = view(spark, sf_dir, "v_currents").select(*K, "ts", angles.east(s, d).alias("u"), angles.north(s, d).alias("v"))
    chosen = tides.resolvable(tides.spans(uv, K, value="u"), K, ["M2", "K1"])
    both = chosen.groupBy(*K).count().filter("count = 2")
    out = tides.current_ellipses(uv, K, chosen.join(both, K, "left_semi"), epoch_seconds=T0)
    return out.select(*K, "constituent", F.round("major", 5).alias("major"), F.round("minor", 5).alias("minor"))


@query(
    "har09_station_residual",
    f"""WITH RECURSIVE {_SPAN}, {_fit_sql("v_tide", ["obs"], ("M2",))}
     SELECT v.station_id, v.t, round(x[1][1] + x[2][1] * ((t - {T0}) / 3600 - mid) / 1000 + x[3][1] * cos(radians(28.9841042e0 * ((t - {T0}) / 3600)))
       + x[4][1] * sin(radians(28.9841042e0 * ((t - {T0}) / 3600))), 5) AS tide,
       round(obs - (x[1][1] + x[2][1] * ((t - {T0}) / 3600 - mid) / 1000 + x[3][1] * cos(radians(28.9841042e0 * ((t - {T0}) / 3600)))
       + x[4][1] * sin(radians(28.9841042e0 * ((t - {T0}) / 3600)))), 5) AS residual
     FROM v_tide v JOIN fit USING (station_id) JOIN sp USING (station_id) WHERE span_hours >= 360""",
)
def _har09r(spark, sf_dir):
    """Analyse long records, predict with constituents of SNR 2 or more, and take the residual."""
    obs = _levels(spark, sf_dir, "obs")
    long_enough = tides.spans(obs, K).filter("span_hours >= 360")
    sol = tides.harmonic_analysis(obs, K, tides.resolvable(long_enough, K, ["M2"]), epoch_seconds=T0)
    out = tides.predict(obs, sol, K, epoch_seconds=T0, min_snr=2.0)
    return out.select(*K, secs("ts", "t"), F.round("tide", 5).alias("tide"), F.round(F.col("value") - F.col("tide"), 5).alias("residual"))


_TABLE_SQL = """ref AS (SELECT station_id, constituent, o.amplitude AS oa, o.phase AS og, m.amplitude AS ma, m.phase AS mg
       FROM o JOIN m USING (station_id, constituent)),
     df AS (SELECT *, ma - oa AS da, (mg - og + 540) - 360 * floor((mg - og + 540) / 360) - 180 AS dg,
       sqrt(greatest(ma * ma + oa * oa - 2 * ma * oa * cos(radians(mg - og)), 0)) AS vd FROM ref)"""


def _summary_sql(mask: str, suffix: str) -> str:
    return f"""round(avg(vd) FILTER ({mask}), 5) AS mean_vector_diff{suffix}, round(sqrt(avg(da * da) FILTER ({mask})), 5) AS rmse_amp{suffix},
       round(sqrt(avg(dg * dg) FILTER ({mask})), 3) AS rmse_phase{suffix}"""


_MAJOR = ", ".join(f"'{c}'" for c in tidal.MAJOR_CONSTITUENTS)


@query(
    "har09_station_tidal_analysis",
    f"""WITH RECURSIVE {SPLINE_CTES.format(source="v_tide", value="obs")},
     eq AS (SELECT station_id, t, {SPLINE_VALUE} AS obs FROM e), {_CT},
     sp AS (SELECT station_id, (max(t) - min(t)) / 3600 AS span_hours FROM eq WHERE obs IS NOT NULL GROUP BY 1 HAVING span_hours >= 360),
     {_RES}, {_full_fit_sql("eq", "obs", "o")}, {_full_fit_sql("v_tide", "model", "m")}, {_TABLE_SQL}
     SELECT station_id, {_summary_sql("true", "")}, {_summary_sql(f"constituent IN ({_MAJOR})", "_major")}, count(*) AS n_valid
     FROM df JOIN sp USING (station_id) GROUP BY 1""",
)
def _har09(spark, sf_dir):
    """Equal interval, solve once, predict, residual, table and summary for all stations."""
    obs = fill.to_equal_interval(
        _levels(spark, sf_dir, "obs"), K, "ts", "value", step_seconds=3600
    )
    mod = _levels(spark, sf_dir, "model")
    long_enough = tides.spans(obs, K).filter("span_hours >= 360")
    chosen = tides.resolvable(long_enough, K)
    ref = tides.harmonic_analysis(obs, K, chosen, epoch_seconds=T0)
    ours = tides.harmonic_analysis(mod, K, chosen, epoch_seconds=T0)
    t = tides.constituent_table(long_enough, ours, K, observed=ref)
    out = tides.constituent_summary(t, K)
    return out.withColumns({c: F.round(c, 3 if c.startswith("rmse_phase") else 5) for c in out.columns if c[:4] in ("mean", "rmse")})
