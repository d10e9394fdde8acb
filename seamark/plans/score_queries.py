"""Pairing, scores, runs: queries with SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from seamark.functions.rounding import half_even
from seamark.functions import angles, clock
from seamark.operators import fill, pairing, runs, scores, sequence
from seamark.plans.demo import r6, secs, view
from seamark.plans.registry import query

K = ["station_id"]


def E():
    return F.col("model") - F.col("obs")


def X1():
    return F.lit(1.0)


def _one(name: str, agg, sql: str) -> None:
    """Single score per station over the ready pairs."""

    @query(name, f"SELECT station_id, round({sql}, 6) AS score FROM v_pairs GROUP BY station_id")
    def run(spark, sf_dir):
        return (
            view(spark, sf_dir, "v_pairs")
            .groupBy(*K)
            .agg(F.round(agg(), 6).alias("score"))
        )


_one("agg01_rmse", lambda: scores.rmse(E()), "sqrt(avg((model-obs)*(model-obs)))")
_one(
    "agg02_pearson_r",
    lambda: scores.pearson(F.col("model"), F.col("obs")),
    "corr(CASE WHEN obs IS NOT NULL THEN model END, obs)",
)
_one("agg03_mean_bias", lambda: F.avg(E()), "avg(model-obs)")
_one("agg04_bias_std", lambda: F.stddev_pop(E()), "stddev_pop(model-obs)")
_one(
    "agg05_central_frequency",
    lambda: scores.central_frequency(E(), X1()),
    "100.0*count(*) FILTER (abs(model-obs) <= 1)/count(model-obs)",
)
_one(
    "agg06_positive_outliers",
    lambda: scores.positive_outliers(E(), X1()),
    "100.0*count(*) FILTER (model-obs >= 2)/count(model-obs)",
)
_one(
    "agg07_negative_outliers",
    lambda: scores.negative_outliers(E(), X1()),
    "100.0*count(*) FILTER (model-obs <= -2)/count(model-obs)",
)

_RUN_SQL = """
WITH e AS (SELECT *, model-obs AS e FROM v_pairs),
n AS (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY t, seq) rn,
        t - lag(t) OVER (PARTITION BY station_id ORDER BY t, seq) dt FROM e),
f AS (SELECT *, rn - row_number() OVER (PARTITION BY station_id, coalesce(e {op}, false) ORDER BY t, seq) isl FROM n),
r AS (SELECT station_id, isl, count(*) c FROM f WHERE e {op} GROUP BY 1, 2),
m AS (SELECT station_id, max(c) c FROM r GROUP BY 1),
d AS (SELECT station_id, median(dt) / 3600 h FROM n GROUP BY 1)
SELECT d.station_id, coalesce(m.c, 0) AS n_rows, round(coalesce(m.c, 0) * d.h, 6) AS hours
FROM d LEFT JOIN m USING (station_id)"""


def _duration(spark, sf_dir, side):
    p = view(spark, sf_dir, "v_pairs")
    return runs.outlier_durations(p, K, "ts", E(), X1(), tie=["seq"]).select(
        *K, F.col(f"max_{side}_rows").alias("n_rows"), r6(f"max_{side}_hours", "hours")
    )


query("agg08_max_positive_duration", _RUN_SQL.format(op=">= 2"))(lambda s, d: _duration(s, d, "pos"))
query("agg09_max_negative_duration", _RUN_SQL.format(op="<= -2"))(lambda s, d: _duration(s, d, "neg"))

_WOF = """100.0 * count(*) FILTER (((model > tide AND obs < tide) OR (model < tide AND obs > tide))
   AND abs(model-obs) > 2 * 2e-2) / nullif(count(model-obs), 0)"""


@query(
    "agg10_worst_case_frequency",
    f"SELECT station_id, round({_WOF}, 6) AS score FROM v_tide GROUP BY station_id",
)
def _agg10(spark, sf_dir):
    t = view(spark, sf_dir, "v_tide")
    pairs, tides = t.drop("tide"), t.select(*K, "ts", "tide")
    return (
        pairing.with_tide(pairs, tides, K)
        .groupBy(*K)
        .agg(
            F.round(
                scores.worst_case_frequency(
                    F.col("model"), F.col("obs"), F.col("tide"), F.lit(0.02)
                ),
                6,
            ).alias("score")
        )
    )


@query(
    "agg11_timing_central_frequency",
    """SELECT station_id, round(100.0 * count(*) FILTER (abs((t - cycle_t) / 3600.0 - 60) <= 36e0)
       / count(*), 6) AS score FROM v_forecast GROUP BY station_id""",
)
def _agg11(spark, sf_dir):
    f = view(spark, sf_dir, "v_forecast")
    err = pairing.hours_between(F.col("ts"), F.col("cycle")) - 60
    return f.groupBy(*K).agg(
        F.round(scores.timing_central_frequency(err, window=36.0), 6).alias("score")
    )


@query(
    "agg12_grading",
    """WITH s AS (SELECT station_id,
         round_even(100.0*count(*) FILTER (abs(model-obs) <= 1)/count(model-obs), 2) AS central_freq,
         round_even(100.0*count(*) FILTER (model-obs >= 2)/count(model-obs), 2) AS pos_outlier_freq
       FROM v_pairs GROUP BY station_id)
       SELECT station_id, CASE WHEN central_freq >= 90 THEN 'pass' ELSE 'fail' END AS central_freq_pass_fail,
         CASE WHEN pos_outlier_freq <= 1 THEN 'pass' ELSE 'fail' END AS pos_outlier_freq_pass_fail FROM s""",
)
def _agg12(spark, sf_dir):
    p = view(spark, sf_dir, "v_pairs")
    s = p.groupBy(*K).agg(
        half_even(scores.central_frequency(E(), X1()), 2).alias("central_freq"),
        half_even(scores.positive_outliers(E(), X1()), 2).alias("pos_outlier_freq"),
    )
    return scores.graded(s).select(*K, "central_freq_pass_fail", "pos_outlier_freq_pass_fail")


_PAIRED = """m AS (SELECT station_id, t, any_value(model) AS model FROM v_model
   GROUP BY 1, 2 HAVING count(*) = 1),
o AS (SELECT station_id, t, obs FROM v_obs WHERE obs IS NOT NULL),
p AS (SELECT m.station_id, m.t, m.model, o.obs, m.model - o.obs AS e
      FROM m LEFT JOIN o ON m.station_id = o.station_id AND m.t = o.t)"""


@query(
    "joi01_pair_scalar",
    f"WITH {_PAIRED} SELECT station_id, t, model, obs, round(e, 6) AS bias FROM p",
)
def _joi01(spark, sf_dir):
    p = pairing.pair_scalar(view(spark, sf_dir, "v_obs"), view(spark, sf_dir, "v_model"), K)
    return p.select(*K, secs("ts", "t"), "model", "obs", r6("bias"))


# Bounded fill on the merged timeline, positional: used by WIN01, JOI02, JOI03.
_FILL = """
b AS (SELECT station_id, t, obs FROM {obs} UNION ALL SELECT station_id, t, NULL FROM {model}),
c AS (SELECT *, count(*) OVER (PARTITION BY station_id, t) n FROM b),
l AS (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY t, obs) rn FROM c
      WHERE n = 1 OR obs IS NOT NULL),
s AS (SELECT *, last_value(obs IGNORE NULLS) OVER w1 pv,
        last_value(CASE WHEN obs IS NOT NULL THEN rn END IGNORE NULLS) OVER w1 pr,
        first_value(obs IGNORE NULLS) OVER w2 nv,
        first_value(CASE WHEN obs IS NOT NULL THEN rn END IGNORE NULLS) OVER w2 nr
      FROM l WINDOW w1 AS (PARTITION BY station_id ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                    w2 AS (PARTITION BY station_id ORDER BY rn ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
filled AS (SELECT station_id, t,
    CASE WHEN obs IS NOT NULL THEN obs
         WHEN rn - pr <= 3 THEN CASE WHEN nv IS NULL THEN pv ELSE pv + (nv - pv) * (rn - pr) / (nr - pr) END
         WHEN rn - pr = 4 THEN CASE WHEN nv IS NULL THEN pv ELSE pv + (nv - pv) * 3 / (nr - pr) END
         WHEN nr = rn + 1 THEN nv END AS obs FROM s)"""


@query(
    "win01_bounded_gap_fill",
    "WITH "
    + _FILL.format(obs="v_obs", model="v_model")
    + " SELECT station_id, t, round(obs, 6) AS obs FROM filled",
)
def _win01(spark, sf_dir):
    out = pairing.filled_observations(
        view(spark, sf_dir, "v_obs"), view(spark, sf_dir, "v_model"), K, "ts", "obs"
    )
    return out.select(*K, secs("ts", "t"), r6("obs"))


@query(
    "win02_merged_timeline",
    """WITH b AS (SELECT station_id, t, obs FROM v_obs UNION ALL SELECT station_id, t, NULL FROM v_model),
       c AS (SELECT *, count(*) OVER (PARTITION BY station_id, t) n FROM b)
       SELECT station_id, t, obs FROM c WHERE n = 1 OR obs IS NOT NULL""",
)
def _win02(spark, sf_dir):
    out = fill.merged_timeline(
        view(spark, sf_dir, "v_obs"), view(spark, sf_dir, "v_model"), K, "ts", "obs"
    )
    return out.select(*K, secs("ts", "t"), "obs")


_ANGLE = """(CASE WHEN (model_dir - obs_dir) BETWEEN 0 AND 180 OR (model_dir - obs_dir) BETWEEN -360 AND -180
  THEN 1 ELSE -1 END * least(abs(model_dir - obs_dir) % 360, 360 - abs(model_dir - obs_dir) % 360))"""


@query(
    "joi02_pair_vector",
    """WITH so AS (SELECT station_id, t, obs_speed AS obs FROM v_currents WHERE seq % 7 <> 0),
    """
    + _FILL.format(obs="so", model="v_currents")
    + """,
    sp AS (SELECT station_id, t, obs AS obs_speed FROM filled),"""
    + """
    b2 AS (SELECT station_id, t, obs_speed, obs_dir FROM v_currents WHERE seq % 7 <> 0
           UNION ALL SELECT station_id, t, NULL, NULL FROM v_currents),
    c2 AS (SELECT *, count(*) OVER (PARTITION BY station_id, t) n FROM b2),
    l2 AS (SELECT *, obs_dir AS obs, row_number() OVER (PARTITION BY station_id ORDER BY t, obs_speed, obs_dir) rn
           FROM c2 WHERE n = 1 OR obs_speed IS NOT NULL),
    s2 AS (SELECT *, last_value(obs IGNORE NULLS) OVER w1 pv,
        last_value(CASE WHEN obs IS NOT NULL THEN rn END IGNORE NULLS) OVER w1 pr,
        first_value(obs IGNORE NULLS) OVER w2 nv,
        first_value(CASE WHEN obs IS NOT NULL THEN rn END IGNORE NULLS) OVER w2 nr
      FROM l2 WINDOW w1 AS (PARTITION BY station_id ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                    w2 AS (PARTITION BY station_id ORDER BY rn ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
    dr AS (SELECT station_id, t,
      CASE WHEN obs IS NOT NULL THEN obs
         WHEN rn - pr <= 3 THEN CASE WHEN nv IS NULL THEN pv ELSE pv + (nv - pv) * (rn - pr) / (nr - pr) END
         WHEN rn - pr = 4 THEN CASE WHEN nv IS NULL THEN pv ELSE pv + (nv - pv) * 3 / (nr - pr) END
         WHEN nr = rn + 1 THEN nv END AS obs_dir FROM s2),
    j AS (SELECT m.station_id, m.t, m.model_speed, m.model_dir, sp.obs_speed, dr.obs_dir
      FROM v_currents m LEFT JOIN sp USING (station_id, t) LEFT JOIN dr USING (station_id, t))
    SELECT station_id, t, round(obs_speed, 6) AS obs_speed, round(obs_dir, 6) AS obs_dir,
      round(model_speed - obs_speed, 6) AS speed_bias, round("""
    + _ANGLE
    + """, 6) AS dir_bias FROM j""",
)
def _joi02(spark, sf_dir):
    c = view(spark, sf_dir, "v_currents")
    p = pairing.pair_vector(c.filter("seq % 7 <> 0"), c, K)
    return p.select(
        *K, secs("ts", "t"), r6("obs_speed"), r6("obs_dir"), r6("speed_bias"), r6("dir_bias")
    )


@query(
    "joi03_pair_horizon",
    """WITH f AS (SELECT station_id, CAST(floor(t / 3600) * 3600 AS BIGINT) AS t, cycle_t, max(model) AS model
         FROM v_forecast GROUP BY 1, 2, 3)
       SELECT f.station_id, f.t, f.cycle_t, f.model, s.value AS obs
       FROM f LEFT JOIN v_series s ON f.station_id = s.station_id AND f.t = s.t""",
)
def _joi03(spark, sf_dir):
    from seamark.operators import horizon

    f = (
        view(spark, sf_dir, "v_forecast")
        .withColumn("ts", F.date_trunc("hour", "ts"))
        .groupBy(*K, "ts", "cycle")
        .agg(F.max("model").alias("model"))
    )
    out = horizon.pair_with_observations(f, view(spark, sf_dir, "v_series"), K, value="value")
    return out.select(*K, secs("ts", "t"), secs("cycle", "cycle_t"), "model", "obs")


@query(
    "joi05_asof_nearest",
    """WITH l AS (SELECT station_id, t + 77 AS t FROM v_series),
       c AS (SELECT l.station_id, l.t, o.t AS rt, o.obs, row_number() OVER
           (PARTITION BY l.station_id, l.t ORDER BY abs(o.t - l.t), o.t, o.obs) rn
         FROM l JOIN (SELECT station_id, t, max(obs) AS obs FROM
             (SELECT user_id AS station_id, CAST(floor(epoch(ts)) AS BIGINT) AS t, value AS obs FROM events)
             GROUP BY 1, 2) o
           ON o.station_id = l.station_id AND abs(o.t - l.t) <= 900)
       SELECT l.station_id, l.t, c.rt AS matched_t, c.obs AS matched_obs
       FROM l LEFT JOIN c ON l.station_id = c.station_id AND l.t = c.t AND c.rn = 1""",
)
def _joi05(spark, sf_dir):
    left = view(spark, sf_dir, "v_series").select(
        *K, (F.col("ts") + F.expr("INTERVAL 77 SECONDS")).alias("ts")
    )
    right = (
        view(spark, sf_dir, "v_forecast").groupBy(*K, "ts").agg(F.max("obs").alias("obs"))
    )
    out = pairing.asof_nearest(left, right, K, value="obs", tolerance_seconds=900)
    return out.select(*K, secs("ts", "t"), secs("matched_ts", "matched_t"), "matched_obs")


@query(
    "joi06_three_way_tide",
    """SELECT station_id, t, round(obs - tide, 9) AS obs_anomaly, round(model - tide, 9) AS model_anomaly
       FROM v_tide WHERE obs IS NOT NULL""",
)
def _joi06(spark, sf_dir):
    t = view(spark, sf_dir, "v_tide")
    out = pairing.with_tide(
        t.filter("obs IS NOT NULL").drop("tide"), t.select(*K, "ts", "tide"), K
    )
    return out.select(
        *K,
        secs("ts", "t"),
        F.round(F.col("obs") - F.col("tide"), 9).alias("obs_anomaly"),
        F.round(F.col("model") - F.col("tide"), 9).alias("model_anomaly"),
    )


def skill_sql(pairs: str, bias_base: str, extra: str = "", x1: str = "1", order: str = "t") -> str:
    """Skill row over a CTE p(station_id, t, tie, obs, model, e)."""
    return f"""WITH {pairs},
n AS (SELECT *, row_number() OVER w rn, t - lag(t) OVER w dt FROM p WINDOW w AS (PARTITION BY station_id ORDER BY {order})),
fp AS (SELECT station_id, rn - row_number() OVER (PARTITION BY station_id ORDER BY rn) g FROM n WHERE e >= 2*{x1}),
fn AS (SELECT station_id, rn - row_number() OVER (PARTITION BY station_id ORDER BY rn) g FROM n WHERE e <= -2*{x1}),
mp AS (SELECT station_id, max(c) c FROM (SELECT station_id, g, count(*) c FROM fp GROUP BY 1, 2) GROUP BY 1),
mn AS (SELECT station_id, max(c) c FROM (SELECT station_id, g, count(*) c FROM fn GROUP BY 1, 2) GROUP BY 1),
a AS (SELECT station_id, count(e) AS n_pairs, sqrt(avg(e*e)) rmse,
  corr(CASE WHEN obs IS NOT NULL THEN model END, obs) r, avg(e) bias,
  avg(CASE WHEN e IS NOT NULL THEN obs END) mo, stddev_pop(e) sd,
  100.0*count(*) FILTER (abs(e) <= {x1})/nullif(count(e),0) cf,
  100.0*count(*) FILTER (e >= 2*{x1})/nullif(count(e),0) pof,
  100.0*count(*) FILTER (e <= -2*{x1})/nullif(count(e),0) nof, median(dt)/3600 h{extra} FROM n GROUP BY 1),
q AS (SELECT a.*, round_even(cf, 2) cf2, round_even(pof, 2) pof2, round_even(nof, 2) nof2,
  round_even(coalesce(mp.c, 0)*h, 2) ph, round_even(coalesce(mn.c, 0)*h, 2) nh
  FROM a LEFT JOIN mp USING (station_id) LEFT JOIN mn USING (station_id)),
z AS (SELECT station_id, n_pairs, CASE WHEN n_pairs >= 5 THEN 'ok' ELSE '<5 data points' END AS status,
  CASE WHEN n_pairs >= 5 THEN round_even(rmse, 2) END AS rmse,
  CASE WHEN n_pairs >= 5 THEN round_even(r, 2) END AS r,
  CASE WHEN n_pairs >= 5 THEN round_even(bias, 2) END AS bias,
  CASE WHEN n_pairs >= 5 THEN round_even(100*{bias_base}/mo, 2) END AS bias_perc,
  CASE WHEN n_pairs >= 5 THEN round_even(sd, 2) END AS bias_std,
  CASE WHEN n_pairs >= 5 THEN cf2 END AS central_freq,
  CASE WHEN n_pairs >= 5 THEN pof2 END AS pos_outlier_freq,
  CASE WHEN n_pairs >= 5 THEN nof2 END AS neg_outlier_freq,
  CASE WHEN n_pairs >= 5 THEN ph END AS max_pos_hours,
  CASE WHEN n_pairs >= 5 THEN nh END AS max_neg_hours FROM q)
SELECT *, CASE WHEN central_freq IS NULL THEN 'NA' WHEN central_freq >= 90 THEN 'pass' ELSE 'fail' END AS central_freq_pass_fail,
  CASE WHEN max_pos_hours IS NULL THEN 'NA' WHEN max_pos_hours <= 24 THEN 'pass' ELSE 'fail' END AS max_pos_hours_pass_fail
FROM z"""


_SKILL_COLS = (
    "station_id n_pairs status rmse r bias bias_perc bias_std central_freq pos_outlier_freq "
    "neg_outlier_freq max_pos_hours max_neg_hours central_freq_pass_fail max_pos_hours_pass_fail"
).split()


@query("agg13_skill_scalar", skill_sql(_PAIRED, "round_even(bias, 2)"))
def _agg13(spark, sf_dir):
    p = pairing.pair_scalar(view(spark, sf_dir, "v_obs"), view(spark, sf_dir, "v_model"), K)
    return scores.skill_scalar(p, K, x1=1.0).select(*_SKILL_COLS)


@query(
    "agg14_skill_speed",
    skill_sql(
        "p AS (SELECT station_id, t, obs_speed AS obs, model_speed AS model, model_speed - obs_speed AS e FROM v_currents)",
        "bias",
        x1="26e-2",
    ),
)
def _agg14(spark, sf_dir):
    c = view(spark, sf_dir, "v_currents")
    p = pairing.pair_vector(c, c, K, fill=False)
    return scores.skill_speed(p, K, x1=0.26).select(*_SKILL_COLS)


@query(
    "agg15_skill_direction",
    f"""WITH p AS (SELECT *, {_ANGLE} AS e, radians(model_dir) a, radians(obs_dir) b FROM v_currents
        WHERE obs_dir IS NOT NULL),
    m AS (SELECT station_id, atan2(avg(sin(a)), avg(cos(a))) am, atan2(avg(sin(b)), avg(cos(b))) bm FROM p GROUP BY 1),
    c AS (SELECT station_id, sum(sin(a-am)*sin(b-bm)) / sqrt(sum(sin(a-am)**2)*sum(sin(b-bm)**2)) cr
          FROM p JOIN m USING (station_id) GROUP BY 1)
    SELECT station_id, count(e) AS n_pairs, round_even(sqrt(avg(e*e)), 2) AS rmse,
      round_even(degrees(atan2(avg(sin(radians(e))), avg(cos(radians(e))))), 2) AS bias,
      round_even(any_value(cr), 2) AS r,
      round_even(100.0*count(*) FILTER (abs(e) <= 22.5)/count(e), 2) AS central_freq
    FROM p JOIN c USING (station_id) GROUP BY station_id""",
)
def _agg15(spark, sf_dir):
    c = view(spark, sf_dir, "v_currents")
    p = pairing.pair_vector(c, c, K, fill=False)
    return scores.skill_direction(p, K).select(
        *K, "n_pairs", "rmse", "bias", "r", "central_freq"
    )


@query(
    "agg16_circular_mean",
    """SELECT station_id, round(degrees(atan2(avg(sin(radians(model_dir))), avg(cos(radians(model_dir))))), 6) AS mean_dir
       FROM v_currents GROUP BY station_id""",
)
def _agg16(spark, sf_dir):
    return (
        view(spark, sf_dir, "v_currents")
        .groupBy(*K)
        .agg(F.round(angles.mean_angle(F.col("model_dir")), 6).alias("mean_dir"))
    )


@query(
    "agg17_circular_correlation",
    """WITH p AS (SELECT station_id, radians(model_dir) a, radians(obs_dir) b FROM v_currents WHERE obs_dir IS NOT NULL),
    m AS (SELECT station_id, atan2(avg(sin(a)), avg(cos(a))) am, atan2(avg(sin(b)), avg(cos(b))) bm FROM p GROUP BY 1)
    SELECT station_id, round(sum(sin(a-am)*sin(b-bm)) / sqrt(sum(sin(a-am)**2)*sum(sin(b-bm)**2)), 6) AS circular_r
    FROM p JOIN m USING (station_id) GROUP BY station_id""",
)
def _agg17(spark, sf_dir):
    c = view(spark, sf_dir, "v_currents")
    return scores.circular_correlation(c, K, "model_dir", "obs_dir").select(*K, r6("circular_r"))


@query(
    "agg40_longest_gap",
    """WITH n AS (SELECT station_id, obs, row_number() OVER (PARTITION BY station_id ORDER BY t, seq) rn FROM v_pairs),
    g AS (SELECT station_id, rn - row_number() OVER (PARTITION BY station_id ORDER BY rn) k FROM n WHERE obs IS NULL),
    m AS (SELECT station_id, max(c) c FROM (SELECT station_id, k, count(*) c FROM g GROUP BY 1, 2) GROUP BY 1)
    SELECT s.station_id, coalesce(c, 0) AS gap_rows, greatest(coalesce(c, 0) - 1, 0) AS gap_pairs
    FROM (SELECT DISTINCT station_id FROM v_pairs) s LEFT JOIN m USING (station_id)""",
)
def _agg40(spark, sf_dir):
    p = view(spark, sf_dir, "v_pairs")
    return runs.longest_gap(p, K, "ts", F.col("obs"), tie=["seq"])


@query(
    "win03_equal_interval",
    """WITH b AS (SELECT station_id, min(t) lo, max(t) hi FROM v_series GROUP BY 1),
    g AS (SELECT station_id, unnest(range(lo, hi + 1, 3600)) AS t FROM b),
    l AS (SELECT g.*, value AS obs, row_number() OVER (PARTITION BY g.station_id ORDER BY g.t) rn
          FROM g LEFT JOIN v_series s ON s.station_id = g.station_id AND s.t = g.t),
    s AS (SELECT *, last_value(obs IGNORE NULLS) OVER w1 pv,
        last_value(CASE WHEN obs IS NOT NULL THEN rn END IGNORE NULLS) OVER w1 pr,
        first_value(obs IGNORE NULLS) OVER w2 nv,
        first_value(CASE WHEN obs IS NOT NULL THEN rn END IGNORE NULLS) OVER w2 nr
      FROM l WINDOW w1 AS (PARTITION BY station_id ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                    w2 AS (PARTITION BY station_id ORDER BY rn ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING))
    SELECT station_id, t, round(CASE WHEN obs IS NOT NULL THEN obs WHEN rn - pr <= 6
      THEN CASE WHEN nv IS NULL THEN pv ELSE pv + (nv - pv) * (rn - pr) / (nr - pr) END END, 10) AS value FROM s""",
)
def _win03(spark, sf_dir):
    out = fill.to_equal_interval(
        view(spark, sf_dir, "v_series"), K, "ts", "value", step_seconds=3600, method="linear"
    )
    return out.select(*K, secs("ts", "t"), F.round("value", 10).alias("value"))


@query(
    "win04_regular_resample",
    """WITH b AS (SELECT station_id, min(t) lo, max(t) hi FROM v_series GROUP BY 1),
    g AS (SELECT station_id, unnest(range(lo, hi + 1, 3600)) AS t FROM b)
    SELECT g.station_id, g.t, s.value FROM g LEFT JOIN v_series s ON s.station_id = g.station_id AND s.t = g.t""",
)
def _win04(spark, sf_dir):
    out = fill.regular_grid(
        view(spark, sf_dir, "v_series"), K, "ts", ["value"], step_seconds=3600
    )
    return out.select(*K, secs("ts", "t"), "value")


@query(
    "win04_time_gaps",
    """WITH g AS (SELECT station_id, t, lag(t) OVER (PARTITION BY station_id ORDER BY t) p FROM v_series)
    SELECT station_id, p AS gap_start, t AS gap_end, t - p AS seconds FROM g WHERE t - p <> 3600""",
)
def _win04b(spark, sf_dir):
    out = fill.time_gaps(view(spark, sf_dir, "v_series"), K, "ts", 3600)
    return out.select(*K, secs("gap_start"), secs("gap_end"), "seconds")


@query(
    "win05_median_interval",
    """WITH g AS (SELECT station_id, t - lag(t) OVER (PARTITION BY station_id ORDER BY t) d FROM v_series)
    SELECT station_id, round(median(d) / 3600, 6) AS dt_hours FROM g GROUP BY 1""",
)
def _win05(spark, sf_dir):
    return fill.median_interval(view(spark, sf_dir, "v_series"), K, "ts").select(
        *K, r6("dt_hours")
    )


@query(
    "win17_keep_first_last",
    """SELECT station_id, CAST(floor(t / 86400) AS BIGINT) AS day, arg_min(model, seq) AS first_model,
       arg_max(model, seq) AS last_model FROM v_model GROUP BY 1, 2""",
)
def _win17(spark, sf_dir):
    m = view(spark, sf_dir, "v_model").select(
        *K, F.floor(clock.epoch(F.col("ts")) / 86400).alias("day"), "seq", "model"
    )
    first = sequence.keep_first(m, [*K, "day"], ["seq"]).select(
        *K, "day", F.col("model").alias("first_model")
    )
    last = sequence.keep_first(m, [*K, "day"], ["seq"], last=True).select(
        *K, "day", F.col("model").alias("last_model")
    )
    return first.join(last, [*K, "day"])


@query(
    "win08_slack_water",
    """WITH n AS (SELECT station_id, t, obs_speed < 5e-1 * 514444e-6 AS f,
        row_number() OVER w rn, lead(t) OVER w nx FROM v_currents WINDOW w AS (PARTITION BY station_id ORDER BY t)),
    g AS (SELECT *, rn - row_number() OVER (PARTITION BY station_id ORDER BY rn) k FROM n WHERE f),
    r AS (SELECT station_id, k, min(t) s, max(t) l, arg_max(coalesce(nx, t), t) e FROM g GROUP BY 1, 2)
    SELECT station_id, s AS start_t, e AS end_t, round((e - s) / 3600, 6) AS hours FROM r""",
)
def _win08(spark, sf_dir):
    c = view(spark, sf_dir, "v_currents")
    out = runs.slack_water(c, K, speed="obs_speed")
    return out.select(*K, secs("start_ts", "start_t"), secs("end_ts", "end_t"), r6("hours"))


# CTEs up to ``e``: knots of an hourly series, second derivatives by the tridiagonal solution, and the
# interval every hour lies in; SPLINE_VALUE is the value filled over at most six hours.
SPLINE_CTES = """b AS (SELECT station_id, min(t) lo, max(t) hi FROM {source} GROUP BY 1),
    g AS (SELECT station_id, unnest(range(lo, hi + 1, 3600)) AS t FROM b),
    l AS (SELECT g.*, {value} AS obs, CAST(row_number() OVER (PARTITION BY g.station_id ORDER BY g.t) AS DOUBLE) rn
          FROM g LEFT JOIN {source} s ON s.station_id = g.station_id AND s.t = g.t),
    kn AS (SELECT station_id, list(rn ORDER BY rn) xs, list(obs ORDER BY rn) ys, CAST(count(*) AS INTEGER) n FROM l WHERE obs IS NOT NULL GROUP BY 1),
    hd AS (SELECT *, list_transform(range(1, n), lambda i: xs[i + 1] - xs[i]) h, list_transform(range(1, n), lambda i: (ys[i + 1] - ys[i]) / (xs[i + 1] - xs[i])) d FROM kn),
    tri AS (SELECT *, list_transform(range(2, n), lambda i: CASE WHEN i = n - 1 THEN h[i - 1] - h[i] * h[i] / h[i - 1] ELSE h[i - 1] END) lo,
        list_transform(range(2, n), lambda i: 2 * (h[i - 1] + h[i]) + CASE WHEN i = 2 THEN h[1] * (h[1] + h[2]) / h[2] ELSE 0 END
          + CASE WHEN i = n - 1 THEN h[i] * (h[i] + h[i - 1]) / h[i - 1] ELSE 0 END) di,
        list_transform(range(2, n), lambda i: CASE WHEN i = 2 THEN h[2] - h[1] * h[1] / h[2] ELSE h[i] END) up,
        list_transform(range(2, n), lambda i: 6 * (d[i] - d[i - 1])) r FROM hd),
    fw AS (SELECT station_id, 1 AS i, [up[1] / di[1]] AS cs, [r[1] / di[1]] AS ds FROM tri WHERE n >= 4
      UNION ALL SELECT f.station_id, i + 1, list_append(cs, up[i + 1] / (di[i + 1] - lo[i + 1] * cs[i])), list_append(ds, (r[i + 1] - lo[i + 1] * ds[i]) / (di[i + 1] - lo[i + 1] * cs[i]))
        FROM fw f JOIN tri USING (station_id) WHERE i < n - 2),
    bk AS (SELECT station_id, n - 2 AS i, cs, ds, [ds[n - 2]] AS ms FROM fw JOIN tri USING (station_id) WHERE i = n - 2
      UNION ALL SELECT station_id, i - 1, cs, ds, list_prepend(ds[i - 1] - cs[i - 1] * ms[1], ms) FROM bk WHERE i > 1),
    mo AS (SELECT station_id, list_concat([((h[1] + h[2]) * ms[1] - h[1] * ms[2]) / h[2]], list_append(ms, ((h[n - 1] + h[n - 2]) * ms[n - 2] - h[n - 1] * ms[n - 3]) / h[n - 2])) AS m
        FROM bk JOIN tri USING (station_id) WHERE i = 1
      UNION ALL SELECT station_id, CASE n WHEN 3 THEN list_transform([1, 2, 3], lambda i: 2 * (d[2] - d[1]) / (xs[3] - xs[1])) ELSE [0e0, 0e0] END FROM hd WHERE n < 4),
    w AS (SELECT l.*, count(obs) OVER (PARTITION BY station_id ORDER BY rn) j FROM l),
    e AS (SELECT w.*, xs[j] x0, xs[j + 1] x1, ys[j] y0, ys[j + 1] y1, m[j] m0, m[j + 1] m1, xs[j + 1] - xs[j] q FROM w JOIN kn USING (station_id) JOIN mo USING (station_id))"""
SPLINE_VALUE = """CASE WHEN obs IS NOT NULL THEN obs WHEN rn - x0 <= 6 THEN (m0 * (x1 - rn) ** 3 + m1 * (rn - x0) ** 3) / (6 * q)
      + (y0 / q - m0 * q / 6) * (x1 - rn) + (y1 / q - m1 * q / 6) * (rn - x0) END"""


@query(
    "win03_equal_interval_spline",
    "WITH RECURSIVE "
    + SPLINE_CTES.format(source="v_series", value="value")
    + f" SELECT station_id, t, round({SPLINE_VALUE} * sqrt(2e0), 6) AS scaled_value FROM e",
)
def _win03s(spark, sf_dir):
    out = fill.to_equal_interval(view(spark, sf_dir, "v_series"), K, "ts", "value", step_seconds=3600)
    scaled = F.round(F.col("value") * F.sqrt(F.lit(2.0)), 6)
    return out.select(*K, secs("ts", "t"), scaled.alias("scaled_value"))


@query(
    "win03_equal_interval_cubic",
    """WITH b AS (SELECT station_id, min(t) lo, max(t) hi FROM v_series GROUP BY 1),
    g AS (SELECT station_id, unnest(range(lo, hi + 1, 3600)) AS t FROM b),
    l AS (SELECT g.*, value AS obs, row_number() OVER (PARTITION BY g.station_id ORDER BY g.t) rn
          FROM g LEFT JOIN v_series s ON s.station_id = g.station_id AND s.t = g.t),
    kn AS (SELECT station_id, rn, obs, lag(obs) OVER w pv, lag(rn) OVER w px, lead(obs) OVER w nv, lead(rn) OVER w nx, lead(obs, 2) OVER w nnv, lead(rn, 2) OVER w nnx
           FROM l WHERE obs IS NOT NULL WINDOW w AS (PARTITION BY station_id ORDER BY rn)),
    f AS (SELECT l.*, k.obs a, k.rn ax, k.nv b, k.nx bx, k.nx - k.rn gap, (l.rn - k.rn) / (k.nx - k.rn) AS s,
            coalesce(((k.obs - k.pv) / (k.rn - k.px) * (k.nx - k.rn) + (k.nv - k.obs) / (k.nx - k.rn) * (k.rn - k.px)) / (k.nx - k.px) * (k.nx - k.rn), k.nv - k.obs) m1,
            coalesce(((k.nv - k.obs) / (k.nx - k.rn) * (k.nnx - k.nx) + (k.nnv - k.nv) / (k.nnx - k.nx) * (k.nx - k.rn)) / (k.nnx - k.rn) * (k.nx - k.rn), k.nv - k.obs) m2
          FROM l LEFT JOIN kn k ON k.station_id = l.station_id AND k.rn < l.rn AND k.nx > l.rn AND l.obs IS NULL)
    SELECT station_id, t, round(CASE WHEN obs IS NOT NULL THEN obs WHEN rn - ax <= 6 THEN a * (2*s*s*s - 3*s*s + 1) + m1 * (s*s*s - 2*s*s + s)
      + b * (3*s*s - 2*s*s*s) + m2 * (s*s*s - s*s) END * sqrt(2e0), 7) AS scaled_value FROM f""",
)
def _win03c(spark, sf_dir):
    out = fill.to_equal_interval(
        view(spark, sf_dir, "v_series"), K, "ts", "value", step_seconds=3600, method="cubic"
    )
    # Scaled by an irrational factor: dyadic fractions would sit on rounding ties.
    scaled = F.round(F.col("value") * F.sqrt(F.lit(2.0)), 7)
    return out.select(*K, secs("ts", "t"), scaled.alias("scaled_value"))
