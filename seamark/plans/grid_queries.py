"""Grids, ice, horizons and roll-ups: queries with SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from seamark.functions import clock
from seamark.operators import grids, horizon, ice, pairing, rollup, runs, spatial
from seamark.plans.demo import r6, secs, table, view
from seamark.plans.registry import query
from seamark.plans.space_queries import KM

_E = "model - obs"


def _cf(op: str, e: str = _E) -> str:
    return f"100.0 * count(*) FILTER ({op}) / nullif(count({e}), 0)"


@query(
    "agg20_frame_statistics",
    f"""SELECT t, round(avg(obs), 6) AS obs_mean, round(stddev_pop(model), 6) AS model_std, round(avg({_E}), 6) AS bias,
      CASE WHEN count(obs) > 5 AND count(model) > 5 THEN round_even(corr(CASE WHEN obs IS NOT NULL THEN model END, obs), 3) END AS r,
      CASE WHEN count(obs) > 5 AND count(model) > 5 THEN round(sqrt(avg(({_E})*({_E}))), 6) END AS rmse,
      round({_cf(f'abs({_E}) <= 3')}, 6) AS central_freq, round({_cf(f'{_E} >= 6')}, 6) AS pos_outlier_freq
      FROM v_grid GROUP BY t""",
)
def _agg20(spark, sf_dir):
    s = grids.frame_statistics(view(spark, sf_dir, "v_grid"))
    return s.select(
        secs("ts", "t"), r6("obs_mean"), r6("model_std"), r6("bias"), "r", r6("rmse"), r6("central_freq"), r6("pos_outlier_freq")
    )


@query(
    "agg21_pixel_statistics",
    f"""SELECT iy, ix, round(sqrt(avg(({_E})*({_E}))), 6) AS rmse, round(avg({_E}), 6) AS diff_mean, round(max({_E}), 6) AS diff_max,
      round(min({_E}), 6) AS diff_min, round({_cf(f'abs({_E}) <= 3')}, 6) AS central_freq, round({_cf(f'{_E} <= -6')}, 6) AS neg_outlier_freq
      FROM v_grid GROUP BY 1, 2 HAVING count({_E}) >= 2""",
)
def _agg21(spark, sf_dir):
    s = grids.pixel_statistics(view(spark, sf_dir, "v_grid")).filter("rmse IS NOT NULL")
    return s.select(
        "iy", "ix", r6("rmse"), r6("diff_mean"), r6("diff_max"), r6("diff_min"), r6("central_freq"), r6("neg_outlier_freq")
    )


@query(
    "agg22_daily_mean",
    """SELECT user_id % 20 AS iy, event_id % 15 AS ix, strftime(ts, '%Y-%m-%d') AS day, round(avg(value), 6) AS value
       FROM events GROUP BY 1, 2, 3""",
)
def _agg22(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(
        (F.col("user_id") % 20).alias("iy"), (F.col("event_id") % 15).alias("ix"), "ts", "value"
    )
    return grids.daily_mean(e).select("iy", "ix", F.col("day").cast("string").alias("day"), r6("value"))


@query(
    "agg23_radar_daily_vectors",
    """WITH x AS (SELECT station_id % 3 AS iy, seq % 5 AS ix, CAST(floor(t / 86400) AS BIGINT) AS d, obs_speed * sin(radians(obs_dir)) u,
         obs_speed * cos(radians(obs_dir)) v FROM v_currents),
       m AS (SELECT iy, ix, d, CASE WHEN count(u) >= 4 THEN avg(u) END u, CASE WHEN count(u) >= 4 THEN avg(v) END v FROM x GROUP BY 1, 2, 3)
       SELECT iy, ix, d AS day, round(u, 6) AS u, round(sqrt(u*u + v*v), 6) AS speed,
         round(fmod(degrees(atan2(u, v)) + 360, 360), 6) AS direction FROM m""",
)
def _agg23(spark, sf_dir):
    c = view(spark, sf_dir, "v_currents").select(
        (F.col("station_id") % 3).alias("iy"),
        (F.col("seq") % 5).alias("ix"),
        "ts",
        (F.col("obs_speed") * F.sin(F.radians("obs_dir"))).alias("u"),
        (F.col("obs_speed") * F.cos(F.radians("obs_dir"))).alias("v"),
    )
    out = grids.radar_daily_vectors(c, min_hours=4)
    return out.select("iy", "ix", F.unix_date("day").cast("bigint").alias("day"), r6("u"), r6("speed"), r6("direction"))


@query(
    "agg24_file_climatology",
    """WITH f AS (SELECT l_linenumber, l_partkey, avg(l_quantity) q, CASE WHEN count(*) FILTER (l_orderkey % 50 = 0) = 0
         THEN avg(l_discount) END d FROM lineitem GROUP BY 1, 2)
       SELECT l_partkey AS node_id, round(avg(q), 6) AS temp, round(CASE WHEN count(d) = count(*) THEN avg(d) END, 6) AS salt
       FROM f GROUP BY 1""",
)
def _agg24(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("node_id"),
        F.col("l_linenumber").alias("file"),
        F.col("l_quantity").alias("temp"),
        F.when(F.col("l_orderkey") % 50 == 0, float("inf")).otherwise(F.col("l_discount")).alias("salt"),
    )
    out = grids.climatology(li, "node_id", ["temp", "salt"])
    return out.select("node_id", r6("temp"), r6("salt"))


_CLIM = """cl AS (SELECT iy, ix, month(to_timestamp(t)::TIMESTAMP) AS mo, day(to_timestamp(t)::TIMESTAMP) AS dy, avg(obs) AS clim FROM v_ice GROUP BY 1, 2, 3, 4),
  ic AS (SELECT v.*, clim FROM v_ice v LEFT JOIN cl ON cl.iy = v.iy AND cl.ix = v.ix
     AND cl.mo = month(to_timestamp(t)::TIMESTAMP) AND cl.dy = day(to_timestamp(t)::TIMESTAMP))"""


def _ice(spark, sf_dir):
    v = view(spark, sf_dir, "v_ice")
    clim = v.groupBy("iy", "ix", F.month("ts").alias("month"), F.dayofmonth("ts").alias("dom")).agg(
        F.avg("obs").alias("clim")
    )
    return ice.attach_climatology(v, clim, ["iy", "ix"])


@query(
    "joi17_climatology_join",
    f"WITH {_CLIM} SELECT t, iy, ix, round(clim, 6) AS clim FROM ic",
)
def _joi17(spark, sf_dir):
    return _ice(spark, sf_dir).select(secs("ts", "t"), "iy", "ix", r6("clim"))


@query(
    "agg25_ice_daily",
    f"""SELECT t, round(avg(obs), 6) AS obs_mean, round(stddev_pop(model), 6) AS model_std,
      round(100.0 * count(*) FILTER (obs >= 10) / nullif(count(*) FILTER (obs >= 0), 0), 6) AS obs_extent_raw,
      CASE WHEN count(obs) >= 2 AND count(model) >= 2 THEN round(sqrt(avg(({_E})*({_E}))), 6) END AS rmse_all,
      CASE WHEN count(CASE WHEN obs + model >= 1 THEN {_E} END) >= 2 THEN
        round(sqrt(avg(CASE WHEN obs + model >= 1 THEN ({_E})*({_E}) END)), 6) END AS rmse_either
      FROM v_ice GROUP BY t""".replace(
        "round(100.0 * count(*) FILTER (obs >= 10) / nullif(count(*) FILTER (obs >= 0), 0), 6) AS obs_extent_raw",
        "coalesce(round(100.0 * count(*) FILTER (obs >= 10) / nullif(count(*) FILTER (obs >= 0), 0), 6), 0) AS obs_extent",
    ),
)
def _agg25(spark, sf_dir):
    s = ice.daily_scores(view(spark, sf_dir, "v_ice"))
    return s.select(secs("ts", "t"), r6("obs_mean"), r6("model_std"), r6("obs_extent"), r6("rmse_all"), r6("rmse_either"))


_CM = """SELECT t, count(*) FILTER (obs >= 10 AND model >= 10) h, count(*) FILTER (obs < 10 AND model >= 10) f,
   count(*) FILTER (obs >= 10 AND model < 10) m FROM v_ice GROUP BY t"""


@query(
    "agg26_ice_contingency",
    f"""WITH c AS ({_CM}) SELECT t, coalesce(round(h / nullif(h + f + m, 0), 6), 0) AS csi, coalesce(round(f / nullif(h + f + m, 0), 6), 0) AS false_alarms,
       coalesce(round(m / nullif(h + f + m, 0), 6), 0) AS misses, coalesce(round((f + m) / nullif(h + f + m, 0), 6), 0) AS extent_error FROM c""",
)
def _agg26(spark, sf_dir):
    s = ice.daily_scores(view(spark, sf_dir, "v_ice"))
    return s.select(secs("ts", "t"), r6("csi"), r6("false_alarms"), r6("misses"), r6("extent_error"))


@query(
    "agg27_ice_skill_score",
    f"""WITH {_CLIM} SELECT t, CASE WHEN count(obs) >= 2 AND count(model) >= 2 THEN round(1 - avg(({_E})*({_E}))
        / nullif(avg((model - clim)*(model - clim)), 0), 6) END AS skill_score FROM ic GROUP BY t""",
)
def _agg27(spark, sf_dir):
    return ice.daily_scores(_ice(spark, sf_dir)).select(secs("ts", "t"), r6("skill_score"))


@query(
    "agg28_ice_pixels",
    f"""WITH p AS (SELECT iy, ix, round(avg({_E}) FILTER (obs + model >= 1), 6) AS diff_mean, count(*) FILTER (obs >= 10) AS od,
        count(*) FILTER (model >= 10) AS md, count(*) FILTER (obs >= 10 AND model >= 10) h, count(*) FILTER (obs < 10 AND model >= 10) f,
        count(*) FILTER (obs >= 10 AND model < 10) m FROM v_ice GROUP BY 1, 2)
      SELECT iy, ix, diff_mean, nullif(od, 0) AS obs_ice_days, nullif(md, 0) AS model_ice_days,
        round(100.0 * h / nullif(h + f + m, 0), 6) AS hit_percent, round(100.0 * m / nullif(h + f + m, 0), 6) AS miss_percent,
        round(100.0 * f / nullif(h + f + m, 0), 6) AS false_alarm_percent FROM p""",
)
def _agg28(spark, sf_dir):
    s = ice.pixel_scores(view(spark, sf_dir, "v_ice"))
    return s.select(
        "iy", "ix", r6("diff_mean"), "obs_ice_days", "model_ice_days", r6("hit_percent"), r6("miss_percent"), r6("false_alarm_percent")
    )


@query(
    "agg29_ice_stations",
    f"""SELECT iy * 15 + ix AS station_id, CASE WHEN count({_E}) > 5 THEN round_even(corr(CASE WHEN obs IS NOT NULL THEN model END, obs), 2) END AS r,
      round_even(sqrt(avg(({_E})*({_E}))), 2) AS rmse, round_even(avg({_E}), 2) AS bias, round_even(avg(obs), 2) AS obs_mean FROM v_ice GROUP BY 1""",
)
def _agg29(spark, sf_dir):
    p = view(spark, sf_dir, "v_ice").withColumn("station_id", F.col("iy") * 15 + F.col("ix"))
    return ice.station_scores(p, ["station_id"]).select("station_id", "r", "rmse", "bias", "obs_mean")


@query(
    "agg30_neighbourhood_ensemble",
    """WITH q AS (SELECT s_suppkey AS station_id, 30 + (s_suppkey * 7 % 50) / 1e1 + 1e-3 AS lat, -80 + (s_suppkey * 13 % 97) / 1e2 AS lon FROM supplier),
      nb AS (SELECT station_id, node_id, row_number() OVER (PARTITION BY station_id ORDER BY d, node_id) AS rank FROM
        (SELECT q.station_id, n.node_id, (n.lat - q.lat)*(n.lat - q.lat) + (n.lon - q.lon)*(n.lon - q.lon) d FROM q JOIN v_nodes n
          ON abs(n.lat - q.lat) < 5e-1 AND abs(n.lon - q.lon) < 5e-1)),
      vl AS (SELECT l_partkey AS node_id, date_trunc('month', l_shipdate) AS m, avg(l_quantity) AS value FROM lineitem GROUP BY 1, 2),
      mn AS (SELECT station_id, m, avg(value) FILTER (rank <= 1) m1, avg(value) FILTER (rank <= 9) m9, avg(value) FILTER (rank <= 25) m25
         FROM nb JOIN vl USING (node_id) WHERE rank <= 25 GROUP BY 1, 2),
      ob AS (SELECT l_suppkey AS station_id, date_trunc('month', l_shipdate) AS m, avg(l_quantity) AS obs FROM lineitem GROUP BY 1, 2)
      SELECT station_id, round(sqrt(avg((m1-obs)*(m1-obs))), 6) AS rmse_1, round(sqrt(avg((m9-obs)*(m9-obs))), 6) AS rmse_9,
        round(sqrt(avg((m25-obs)*(m25-obs))), 6) AS rmse_25 FROM mn JOIN ob USING (station_id, m) GROUP BY 1""",
)
def _agg30(spark, sf_dir):
    s = F.col("s_suppkey")
    stations = table(spark, sf_dir, "supplier").select(
        s.alias("station_id"), (30 + (s * 7 % 50) / 10.0 + 1e-3).alias("lat"), (-80 + (s * 13 % 97) / 100.0).alias("lon")
    )
    nb = spatial.nearest(
        stations, view(spark, sf_dir, "v_nodes"), node_id="node_id", k=25, box_deg=0.5, planar=True
    ).filter("node_id IS NOT NULL")
    li = table(spark, sf_dir, "lineitem")
    month = F.date_trunc("month", "l_shipdate").alias("ts")
    values = li.groupBy(F.col("l_partkey").alias("node_id"), month).agg(F.avg("l_quantity").alias("value"))
    obs = li.groupBy(F.col("l_suppkey").alias("station_id"), month).agg(F.avg("l_quantity").alias("obs"))
    out = ice.neighbourhood_scores(
        nb.select("station_id", "node_id", "rank"), values, obs, ["station_id"], node_id="node_id"
    )
    return out.select("station_id", r6("rmse_1"), r6("rmse_9"), r6("rmse_25"))


_CLS = f"""cc AS (SELECT iy, ix, CASE WHEN model < 25 THEN '0-25%' WHEN model < 50 THEN '25-50%' WHEN model < 75 THEN '50-75%' ELSE '75-100%' END AS class,
   {_E} AS e FROM v_ice WHERE ({_E}) IS NOT NULL UNION ALL SELECT iy, ix, '0-100%', {_E} FROM v_ice WHERE ({_E}) IS NOT NULL),
 cr AS (SELECT iy, ix, class, sqrt(avg(e*e)) AS rmse FROM cc GROUP BY 1, 2, 3)"""


@query(
    "agg31_ice_class_rmse",
    f"""WITH {_CLS} SELECT class, round(quantile_cont(rmse, 25e-2), 6) AS q25, round(quantile_cont(rmse, 5e-1), 6) AS q50,
       round(quantile_cont(rmse, 75e-2), 6) AS q75 FROM cr GROUP BY 1""",
)
def _agg31(spark, sf_dir):
    return ice.class_distribution(view(spark, sf_dir, "v_ice")).select("class", r6("q25"), r6("q50"), r6("q75"))


_DAYS = f"""c AS ({_CM}), dd AS (SELECT t, CAST(floor(t / 86400 / 365) AS BIGINT) AS season, h / nullif(h+f+m, 0) AS csi FROM c)"""


@query(
    "agg36_ice_rollup",
    f"""WITH c AS (SELECT t, count(*) FILTER (obs >= 10 AND model >= 10) h, count(*) FILTER (obs < 10 AND model >= 10) f,
        count(*) FILTER (obs >= 10 AND model < 10) m, CASE WHEN count(obs) >= 2 AND count(model) >= 2 THEN sqrt(avg(({_E})*({_E}))) END ra
        FROM v_ice GROUP BY t)
      SELECT CAST(floor(t / 31536000) AS BIGINT) AS season, round(avg(h / nullif(h+f+m, 0)), 6) AS csi,
        round(avg(f / nullif(h+f+m, 0)), 6) AS false_alarms, round(avg(ra) FILTER (ra > 0), 6) AS rmse_all FROM c GROUP BY 1""",
)
def _agg36(spark, sf_dir):
    d = ice.daily_scores(view(spark, sf_dir, "v_ice")).withColumn(
        "season", F.floor(clock.epoch(F.col("ts")) / 31536000)
    )
    out = ice.seasonal_rollup(d, ["season"])
    return out.select("season", r6("csi"), r6("false_alarms"), r6("rmse_all"))


# Daily mean concentration per cell row, for onset, thaw and smoothing.
_DM = """dm AS (SELECT iy AS station_id, t, CASE WHEN (t / 86400) % 37 = 5 THEN NULL ELSE avg(model) - (1 + cos(t / 86400 / 58e0)) * 22 END AS v
   FROM v_ice GROUP BY 1, 2)"""


def _daily(spark, sf_dir):
    day = clock.epoch(F.col("ts")) / 86400
    return (
        view(spark, sf_dir, "v_ice")
        .groupBy(F.col("iy").alias("station_id"), "ts")
        .agg(F.avg("model").alias("m"))
        .select(
            "station_id",
            "ts",
            F.when(day % 37 != 5, F.col("m") - (1 + F.cos(day / 58.0)) * 22).alias("v"),
        )
    )


@query(
    "win12_onset_and_thaw",
    f"""WITH {_DM}, n AS (SELECT *, row_number() OVER w rn, count(*) OVER (PARTITION BY station_id) n,
         sum(CASE WHEN v >= 10 THEN 1 ELSE 0 END) OVER (PARTITION BY station_id ORDER BY t ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) s
         FROM dm WINDOW w AS (PARTITION BY station_id ORDER BY t)),
      o AS (SELECT station_id, min(t) AS onset FROM n WHERE s = 5 GROUP BY 1),
      l AS (SELECT station_id, max(rn) AS i FROM n WHERE v >= 10 GROUP BY 1),
      m AS (SELECT n.station_id, l.i, max(n.n) n, count(*) FILTER (n.v IS NULL AND n.rn >= l.i) miss FROM n JOIN l USING (station_id) GROUP BY 1, 2),
      th AS (SELECT n.station_id, n.t AS thaw FROM m JOIN n ON n.station_id = m.station_id AND n.rn = m.i + 5 WHERE m.n - m.i >= 5 AND miss <= 2)
      SELECT s.station_id, o.onset, th.thaw FROM (SELECT DISTINCT station_id FROM dm) s LEFT JOIN o USING (station_id) LEFT JOIN th USING (station_id)""",
)
def _win12(spark, sf_dir):
    out = runs.onset_and_thaw(_daily(spark, sf_dir), ["station_id"], "ts", "v")
    return out.select("station_id", secs("onset"), secs("thaw"))


# 42 times the weights of a parabola through seven points, by place in the window.
_PARABOLA_42 = (
    (32, 15, 3, -4, -6, -3, 5),
    (15, 12, 9, 6, 3, 0, -3),
    (3, 9, 12, 12, 9, 3, -6),
    (-4, 6, 12, 14, 12, 6, -4),
    (-6, 3, 9, 12, 12, 9, 3),
    (-3, 0, 3, 6, 9, 12, 15),
    (5, -3, -6, -4, 3, 15, 32),
)


def _smoothing_sql() -> str:
    """The fitted parabola of seven points at the middle, or at the place of an edge row in the first or last window."""

    def fit(place: int) -> str:
        terms = (f"{w}e0 * {'lag' if p < place else 'lead'}(f, {abs(p - place)}) OVER w" for p, w in enumerate(_PARABOLA_42[place]))
        return f"({' + '.join(terms)}) / 42"

    cases = [(f"i = {k + 1}", k) for k in range(3)] + [(f"n - i = {k}", 6 - k) for k in range(3)]
    return "CASE WHEN n < 10 THEN f " + " ".join(f"WHEN {when} THEN {fit(k)}" for when, k in cases) + f" ELSE {fit(3)} END"


@query(
    "win13_savgol_smoothing",
    f"""WITH {_DM}, z AS (SELECT station_id, t, v / 100 AS v FROM dm),
      fl AS (SELECT station_id, t, v, coalesce(first_value(v IGNORE NULLS) OVER (PARTITION BY station_id ORDER BY t ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),
         last_value(v IGNORE NULLS) OVER (PARTITION BY station_id ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS f,
         row_number() OVER (PARTITION BY station_id ORDER BY t) AS i, count(*) OVER (PARTITION BY station_id) AS n FROM z),
      sm AS (SELECT station_id, t, v, {_smoothing_sql()} AS s FROM fl WINDOW w AS (PARTITION BY station_id ORDER BY t))
      SELECT station_id, t, round(CASE WHEN v IS NOT NULL THEN least(s, 1) END, 6) AS v_smooth FROM sm""",
)
def _win13(spark, sf_dir):
    d = _daily(spark, sf_dir).withColumn("v", F.col("v") / 100)
    out = ice.smooth_daily(d, ["station_id"], "ts", "v")
    return out.select("station_id", secs("ts", "t"), r6("v_smooth"))


@query(
    "joi14_common_frame_times",
    """WITH o AS (SELECT * FROM v_grid WHERE obs IS NOT NULL AND (iy + ix) % 2 = 0), m AS (SELECT * FROM v_grid WHERE model IS NOT NULL AND iy % 3 = 0)
       SELECT t, count(*) AS n_cells FROM o WHERE t IN (SELECT t FROM m) GROUP BY t""",
)
def _joi14(spark, sf_dir):
    g = view(spark, sf_dir, "v_grid")
    o = g.filter("obs IS NOT NULL AND (iy + ix) % 2 = 0")
    m = g.filter("model IS NOT NULL AND iy % 3 = 0")
    kept, _ = grids.common_times(o, m)
    return kept.groupBy("ts").agg(F.count(F.lit(1)).alias("n_cells")).select(secs("ts", "t"), "n_cells")


@query(
    "joi15_hourly_frame_lookup",
    """WITH h AS (SELECT unnest(range(1704067200, 1704067200 + 720 * 3600, 3600)) AS t),
       e AS (SELECT CAST(floor(t / 3600) * 3600 AS BIGINT) AS t, count(*) AS n FROM v_forecast GROUP BY 1)
       SELECT h.t, e.n FROM h LEFT JOIN e USING (t)""",
)
def _joi15(spark, sf_dir):
    e = (
        view(spark, sf_dir, "v_forecast")
        .groupBy(F.date_trunc("hour", "ts").alias("ts"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    start = F.timestamp_seconds(F.lit(1704067200))
    out = grids.hourly_frames(e, start, F.timestamp_seconds(F.lit(1704067200 + 719 * 3600)))
    return out.select(secs("ts", "t"), "n")


@query(
    "joi16_same_day_pairs",
    """WITH d AS (SELECT station_id, CAST(floor(t / 86400) AS BIGINT) AS day, max(value) AS obs FROM v_series GROUP BY 1, 2)
       SELECT s.station_id, s.t, d.obs, s.value AS model FROM v_series s JOIN d ON d.station_id = s.station_id AND d.day = CAST(floor(s.t / 86400) AS BIGINT)""",
)
def _joi16(spark, sf_dir):
    s = view(spark, sf_dir, "v_series")
    daily = s.groupBy("station_id", F.date_trunc("day", "ts").alias("ts")).agg(F.max("value").alias("obs"))
    out = pairing.same_day_pairs(daily, s.withColumnRenamed("value", "model"), ["station_id"])
    return out.select("station_id", secs("ts", "t"), "obs", "model")


@query(
    "flt13_conditional_mask",
    "SELECT t, iy, ix, CASE WHEN NOT coalesce(model < 25, false) THEN obs END AS obs FROM v_grid",
)
def _flt13(spark, sf_dir):
    g = view(spark, sf_dir, "v_grid")
    return g.select(secs("ts", "t"), "iy", "ix", grids.mask_where(F.col("obs"), F.col("model"), 25).alias("obs"))


@query(
    "grd08_difference_frames",
    f"SELECT t, iy, ix, round({_E}, 6) AS diff FROM v_grid WHERE obs IS NOT NULL AND model IS NOT NULL",
)
def _grd08(spark, sf_dir):
    g = view(spark, sf_dir, "v_grid")
    o = g.select("ts", "iy", "ix", F.col("obs").alias("value"))
    m = g.select("ts", "iy", "ix", F.col("model").alias("value"))
    out = grids.difference_frames(grids.pair_frames(o, m))
    return out.select(secs("ts", "t"), "iy", "ix", r6("diff"))


@query(
    "grd09_surface_skill",
    f"""WITH o AS (SELECT t, iy, ix, obs FROM v_grid WHERE iy % 2 = 0), m AS (SELECT t, iy, ix, model FROM v_grid WHERE ix % 3 <> 0),
       o2 AS (SELECT * FROM o WHERE t IN (SELECT t FROM m)), m2 AS (SELECT * FROM m WHERE t IN (SELECT t FROM o)),
       p AS (SELECT coalesce(o2.iy, m2.iy) iy, coalesce(o2.ix, m2.ix) ix, obs, model FROM o2 FULL JOIN m2 ON o2.t = m2.t AND o2.iy = m2.iy AND o2.ix = m2.ix)
       SELECT iy, ix, CASE WHEN count({_E}) >= 2 THEN round(sqrt(avg(({_E})*({_E}))), 6) END AS rmse FROM p GROUP BY 1, 2""",
)
def _grd09(spark, sf_dir):
    g = view(spark, sf_dir, "v_grid")
    o = g.filter("iy % 2 = 0").select("ts", "iy", "ix", F.col("obs").alias("value"))
    m = g.filter("ix % 3 <> 0").select("ts", "iy", "ix", F.col("model").alias("value"))
    _, pixels = grids.surface_skill(o, m)
    return pixels.select("iy", "ix", r6("rmse"))


@query(
    "grd10_concat_frames",
    """SELECT 'a' AS source, t, count(*) AS n FROM v_grid WHERE obs IS NOT NULL GROUP BY t
       UNION ALL SELECT 'b', t, count(*) FROM v_grid WHERE model IS NOT NULL GROUP BY t""",
)
def _grd10(spark, sf_dir):
    g = view(spark, sf_dir, "v_grid")
    a = g.filter("obs IS NOT NULL").select(F.lit("a").alias("source"), "ts", "iy", "ix", F.col("obs").alias("value"))
    b = g.filter("model IS NOT NULL").select(F.lit("b").alias("source"), "ts", "iy", "ix", F.col("model").alias("value"))
    out = grids.concat_frames(a, b).groupBy("source", "ts").agg(F.count(F.lit(1)).alias("n"))
    return out.select("source", secs("ts", "t"), "n")


@query(
    "grd06_time_thinning",
    """WITH d AS (SELECT t, row_number() OVER (ORDER BY t) - 1 AS i FROM (SELECT DISTINCT t FROM v_series))
       SELECT s.t, count(*) AS n_rows FROM v_series s JOIN d USING (t) WHERE d.i % 6 = 0 GROUP BY s.t""",
)
def _grd06(spark, sf_dir):
    out = grids.every_nth_time(view(spark, sf_dir, "v_series"), 6)
    return out.groupBy("ts").agg(F.count(F.lit(1)).alias("n_rows")).select(secs("ts", "t"), "n_rows")


# Two days of hourly surface values of every node, with gaps.
_SURF = """fv AS (SELECT node_id, 1704067200 + hr * 3600 AS t, vi, CASE WHEN (node_id * 7 + hr * 3 + vi) % 11 = 0 THEN NULL
     ELSE h * (vi + 1) / 10 + lat + hr * (vi - 2) / 1e2 - node_id % 13 * (vi % 2) / 1e1 END AS value FROM v_nodes, range(48) a(hr), range(5) b(vi))"""
_CELLS = f"""bx AS (SELECT round(min(lat), 2) - 25e-2 AS y0, round(max(lat), 2) + 25e-2 AS y1, round(min(lon), 2) - 25e-2 AS x0, round(max(lon), 2) + 25e-2 AS x1 FROM v_nodes),
     yy AS (SELECT unnest(range(0, CAST(ceil((y1 - y0) / 1e-1 - 1e-9) AS BIGINT))) AS iy FROM bx), xx AS (SELECT unnest(range(0, CAST(ceil((x1 - x0) / 1e-1 - 1e-9) AS BIGINT))) AS ix FROM bx),
     ce AS (SELECT iy, ix, round(y0 + iy * 1e-1, 2) AS lat, round(x0 + ix * 1e-1, 2) AS lon FROM bx, yy, xx),
     ne AS (SELECT s.iy, s.ix, s.lat, s.lon, n.node_id, n.lat AS nlat, n.lon AS nlon, {KM} AS d,
       row_number() OVER (PARTITION BY s.iy, s.ix ORDER BY round({KM} / 1e-3), n.node_id) AS r FROM ce s CROSS JOIN v_nodes n WHERE n.wet = 1),
     nb AS (SELECT *, r <= 8 AND d <= 20 AS cl FROM ne WHERE r <= 16),
     nc AS (SELECT * FROM nb WHERE cl),
     ou AS (SELECT DISTINCT iy, ix, TRUE AS out FROM (SELECT i.iy, i.ix, i.r FROM nc i JOIN nc j ON i.iy = j.iy AND i.ix = j.ix GROUP BY i.iy, i.ix, i.r
       HAVING bool_and((i.nlon - i.lon) * (j.nlat - j.lat) - (i.nlat - i.lat) * (j.nlon - j.lon) > 0 OR ((i.nlon - i.lon) * (j.nlat - j.lat) - (i.nlat - i.lat) * (j.nlon - j.lon) = 0 AND (i.nlon - i.lon) * (j.nlon - j.lon) + (i.nlat - i.lat) * (j.nlat - j.lat) > 0)))),
     ns AS (SELECT nb.*, bool_or(cl) OVER c AND ou.out IS NULL AS inside, min(d) OVER c AS dm FROM nb LEFT JOIN ou ON nb.iy = ou.iy AND nb.ix = ou.ix WINDOW c AS (PARTITION BY nb.iy, nb.ix)),
     wt AS (SELECT iy, ix, node_id, CASE WHEN dm = 0 THEN CASE WHEN d = 0 THEN 1e0 ELSE 0e0 END ELSE 1 / (d * d) END AS w FROM ns WHERE cl OR NOT inside),
     hv AS (SELECT iy, ix, t, {", ".join(f"sum(w * value) FILTER (vi = {i} AND value IS NOT NULL) / sum(w) FILTER (vi = {i} AND value IS NOT NULL) AS {n}" for i, n in enumerate(grids.SURFACE))}
       FROM wt JOIN fv USING (node_id) WHERE w > 0 GROUP BY 1, 2, 3)"""


def _surface(spark, sf_dir):
    nodes = view(spark, sf_dir, "v_nodes")
    hr, vi, i = F.col("hr"), F.col("vi"), F.col("node_id")
    steps = nodes.withColumn("hr", F.explode(F.sequence(F.lit(0), F.lit(47)))).withColumn("vi", F.explode(F.sequence(F.lit(0), F.lit(4))))
    value = F.col("h") * (vi + 1) / 10 + F.col("lat") + hr * (vi - 2) / 100.0 - i % 13 * (vi % 2) / 10.0
    values = steps.select(
        "node_id",
        F.lit(0).alias("layer"),
        F.timestamp_seconds(F.lit(1704067200) + hr * 3600).alias("ts"),
        F.element_at(F.array(*[F.lit(n) for n in grids.SURFACE]), vi + 1).alias("var"),
        F.when((i * 7 + hr * 3 + vi) % 11 != 0, value).alias("value"),
    )
    targets = spatial.regular_lattice(nodes, step=0.1)
    return grids.surface_products(values, nodes, targets, radius_km=20.0, resolution_km=1e-3)


@query(
    "grd11_surface_products",
    f"WITH {_SURF}, {_CELLS} SELECT iy, ix, t, {', '.join(f'round({n}, 5) AS {n}' for n in grids.SURFACE)}, round(sqrt(ssu * ssu + ssv * ssv), 5) AS speed FROM hv",
)
def _grd11(spark, sf_dir):
    """Hourly surface fields of five variables on the lattice, and the current's speed."""
    names = [*grids.SURFACE, "speed"]
    return _surface(spark, sf_dir).select("iy", "ix", secs("ts", "t"), *[F.round(n, 5).alias(n) for n in names])


@query(
    "grd11_surface_daily",
    f"""WITH {_SURF}, {_CELLS}, dy AS (SELECT iy, ix, CAST(floor(t / 86400) AS BIGINT) AS day, {', '.join(f'avg({n}) AS {n}' for n in grids.SURFACE)} FROM hv GROUP BY 1, 2, 3)
      SELECT iy, ix, day, {', '.join(f'round({n}, 5) AS {n}' for n in grids.SURFACE)}, round(sqrt(ssu * ssu + ssv * ssv), 5) AS speed, round(fmod(degrees(atan2(ssu, ssv)) + 360, 360), 3) AS direction FROM dy""",
)
def _grd11d(spark, sf_dir):
    out = grids.daily_products(_surface(spark, sf_dir))
    day = F.datediff("day", F.lit("1970-01-01").cast("date")).cast("bigint").alias("day")
    return out.select("iy", "ix", day, *[F.round(n, 5).alias(n) for n in [*grids.SURFACE, "speed"]], F.round("direction", 3).alias("direction"))


def _forecast(spark, sf_dir):
    return horizon.add_lead(view(spark, sf_dir, "v_forecast"), 48)


_LEAD = """ld AS (SELECT *, CAST(floor((t - cycle_t) / 3600) AS BIGINT) AS lead_hour FROM v_forecast),
  lb AS (SELECT *, CAST(least((floor(lead_hour / 6) + 1) * 6, 48) AS BIGINT) AS hour_bin, model - obs AS e FROM ld WHERE lead_hour BETWEEN 0 AND 48)"""


@query(
    "scl19_lead_bins",
    f"WITH {_LEAD} SELECT seq, lead_hour, hour_bin FROM lb",
)
def _scl19(spark, sf_dir):
    return _forecast(spark, sf_dir).select("seq", "lead_hour", "hour_bin")


@query(
    "agg32_horizon_scores",
    f"""WITH {_LEAD}, g AS (SELECT hour_bin, cycle_t, count(e) n, round_even(sqrt(avg(e*e)), 2) rmse, round_even(avg(e), 2) mean_error,
        round_even(100.0 * count(*) FILTER (abs(e) <= 10) / count(e), 2) cf FROM lb GROUP BY GROUPING SETS ((hour_bin), (cycle_t)))
      SELECT hour_bin, cycle_t, n, rmse, mean_error, CASE WHEN n > 20 THEN cf END AS central_freq FROM g WHERE n > 10""",
)
def _agg32(spark, sf_dir):
    out = horizon.horizon_scores(_forecast(spark, sf_dir), x1=10.0)
    return out.select("hour_bin", secs("cycle", "cycle_t"), "n", "rmse", "mean_error", "central_freq")


@query(
    "flt10_minimum_group_size",
    f"WITH {_LEAD} SELECT station_id, count(e) AS n FROM lb GROUP BY 1 HAVING count(e) > 10",
)
def _flt10(spark, sf_dir):
    f = _forecast(spark, sf_dir)
    e = F.col("model") - F.col("obs")
    return f.groupBy("station_id").agg(F.count(e).alias("n")).filter("n > 10")


@query(
    "agg33_station_cycle_matrix",
    """SELECT station_id, CAST(floor(seq % 20 / 5) AS BIGINT) AS cycle, round_even(100.0 * count(*) FILTER (abs(model - obs) <= 10) / count(model - obs), 2) AS central_freq
       FROM v_forecast GROUP BY 1, 2""",
)
def _agg33(spark, sf_dir):
    f = view(spark, sf_dir, "v_forecast").withColumn("cycle", F.floor(F.col("seq") % 20 / 5))
    return horizon.station_cycle_matrix(f, ["station_id"], x1=10.0)


@query(
    "agg33_station_cycle_pivot",
    """SELECT station_id, round_even(100.0 * count(*) FILTER (seq % 2 = 0 AND abs(model - obs) <= 10) / nullif(count(*) FILTER (seq % 2 = 0), 0), 2) AS "0",
        round_even(100.0 * count(*) FILTER (seq % 2 = 1 AND abs(model - obs) <= 10) / nullif(count(*) FILTER (seq % 2 = 1), 0), 2) AS "1"
       FROM v_forecast GROUP BY 1""",
)
def _agg33p(spark, sf_dir):
    f = view(spark, sf_dir, "v_forecast").withColumn("cycle", F.col("seq") % 2)
    return horizon.station_cycle_matrix(f, ["station_id"], x1=10.0, cycles=[0, 1])


@query(
    "joi04_merge_cycle",
    """SELECT station_id, t, cycle_t, seq, model FROM v_forecast WHERE seq % 3 <> 0 AND cycle_t NOT IN (SELECT cycle_t FROM v_forecast WHERE seq % 100 = 0)
       UNION ALL SELECT station_id, t, cycle_t, seq, model + 1 FROM v_forecast WHERE seq % 100 = 0""",
)
def _joi04(spark, sf_dir):
    f = view(spark, sf_dir, "v_forecast").select("station_id", "ts", "cycle", "seq", "model")
    new = f.filter("seq % 100 = 0").withColumn("model", F.col("model") + 1)
    out = pairing.replace_cycle(f.filter("seq % 3 <> 0"), new, ["cycle"])
    return out.select("station_id", secs("ts", "t"), secs("cycle", "cycle_t"), "seq", "model")


@query(
    "joi04_merge_wide",
    """WITH a AS (SELECT t, max(model) AS c1 FROM v_forecast WHERE seq % 2 = 0 GROUP BY 1), b AS (SELECT t, max(model) AS c2 FROM v_forecast WHERE seq % 3 = 0 GROUP BY 1)
       SELECT coalesce(a.t, b.t) AS t, c1, c2 FROM a FULL JOIN b ON a.t = b.t""",
)
def _joi04w(spark, sf_dir):
    f = view(spark, sf_dir, "v_forecast")
    a = f.filter("seq % 2 = 0").groupBy("ts").agg(F.max("model").alias("c1"))
    a = a.withColumn("c2", F.lit(0.0))
    b = f.filter("seq % 3 = 0").groupBy("ts").agg(F.max("model").alias("c2"))
    return pairing.merge_horizon_wide(a, b, ["ts"], "c2").select(secs("ts", "t"), "c1", "c2")


@query(
    "agg34_system_rollup",
    """WITH p AS (SELECT l_returnflag AS system, l_linestatus AS variable, (l_discount - 5e-2) * 20 + (l_tax - 4e-2) * 10 AS e FROM lineitem)
       SELECT system, variable, count(e) AS n_pairs, round(avg(CASE WHEN abs(e) / 5e-1 <= 1 THEN 1e0 ELSE 0 END), 6) AS central_share,
         round(sqrt(avg((e / 5e-1) * (e / 5e-1))), 6) AS rmse_over_x1 FROM p GROUP BY ROLLUP (system, variable) HAVING system IS NOT NULL""",
)
def _agg34(spark, sf_dir):
    p = table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("system"),
        F.col("l_linestatus").alias("variable"),
        ((F.col("l_discount") - 0.05) * 20 + (F.col("l_tax") - 0.04) * 10).alias("bias"),
    )
    out = rollup.system_rollup(p, "system", "variable", F.lit(0.5))
    return out.select("system", "variable", "n_pairs", r6("central_share"), r6("rmse_over_x1"))


@query(
    "agg34_scorecard",
    """WITH p AS (SELECT l_returnflag AS system, l_linestatus AS variable, (l_discount - 5e-2) * 20 AS e FROM lineitem)
       SELECT system, CASE WHEN count(*) FILTER (variable = 'O') > 10 THEN round(100.0 * count(*) FILTER (variable = 'O' AND abs(e) <= 55e-2) / nullif(count(*) FILTER (variable = 'O'), 0), 6) END AS "O",
        CASE WHEN count(*) FILTER (variable = 'F') > 10 THEN round(100.0 * count(*) FILTER (variable = 'F' AND abs(e) <= 55e-2) / nullif(count(*) FILTER (variable = 'F'), 0), 6) END AS "F" FROM p GROUP BY 1""",
)
def _agg34s(spark, sf_dir):
    p = table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("system"), F.col("l_linestatus").alias("variable"), ((F.col("l_discount") - 0.05) * 20).alias("bias")
    )
    s = rollup.system_scores(p, ["system", "variable"], F.lit(0.55))
    return rollup.scorecard(
        s.select("system", "variable", r6("central_freq")), "system", "variable", "central_freq", ["O", "F"]
    )


@query(
    "agg35_all_systems",
    """SELECT source, min(t) AS start, max(t) AS end_t, count(*) AS n_rows FROM (SELECT 'series' AS source, t FROM v_series UNION ALL SELECT 'forecast', t FROM v_forecast) GROUP BY 1""",
)
def _agg35(spark, sf_dir):
    a = view(spark, sf_dir, "v_series").select(F.lit("series").alias("source"), "ts")
    b = view(spark, sf_dir, "v_forecast").select(F.lit("forecast").alias("source"), "ts")
    out = rollup.all_systems([a, b], ["source"], "ts", "ts")
    return out.select("source", secs("start"), secs("end", "end_t"), "n_rows")


@query(
    "set03_mismatched_days",
    """WITH o AS (SELECT DISTINCT CAST(floor(epoch(o_orderdate) / 86400) * 86400 AS BIGINT) AS t FROM orders), m AS (SELECT DISTINCT CAST(floor(epoch(l_shipdate) / 86400) * 86400 AS BIGINT) AS t FROM lineitem)
       SELECT t, 'obs' AS only_in FROM (SELECT t FROM o EXCEPT SELECT t FROM m) UNION ALL SELECT t, 'model' FROM (SELECT t FROM m EXCEPT SELECT t FROM o)""",
)
def _set03(spark, sf_dir):
    o, m = (
        table(spark, sf_dir, t).select(F.date_trunc("day", F.col(c).cast("timestamp")).alias("ts"))
        for t, c in (("orders", "o_orderdate"), ("lineitem", "l_shipdate"))
    )
    out = ice.mismatched_days(o, m, "ts")
    return out.select(secs("ts", "t"), "only_in")


# Forecast length and cycle hours per system (fixed values of the demo).
_CFG = [(0, 24, [0, 6, 12, 18]), (1, 48, [0, 12]), (2, 60, [3, 9, 15, 21])]


def _config(spark):
    return spark.createDataFrame(_CFG, "system bigint, forecast_hours int, cycle_hours array<int>")


@query(
    "scl20_nearest_cycle",
    """WITH c(system, fh, h) AS (VALUES (0,24,0),(0,24,6),(0,24,12),(0,24,18),(1,48,0),(1,48,12),(2,60,3),(2,60,9),(2,60,15),(2,60,21))
       SELECT event_id, arg_min(h, (abs(h - hour(ts)), h)) AS cycle_hour, any_value(fh) AS forecast_hours FROM events JOIN c ON c.system = event_id % 3 GROUP BY 1""",
)
def _scl20(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "ts", (F.col("event_id") % 3).alias("system"))
    return horizon.nearest_cycle(e, _config(spark)).select("event_id", "cycle_hour", "forecast_hours")


@query(
    "scl21_contributing_cycles",
    """WITH c(system, fh, h) AS (VALUES (0,24,0),(0,24,6),(0,24,12),(0,24,18),(1,48,0),(1,48,12),(2,60,3),(2,60,9),(2,60,15),(2,60,21)),
       x AS (SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS t, fh, h, d FROM events JOIN c ON c.system = event_id % 3, range(0, 4) r(d)),
       y AS (SELECT event_id, t, fh, CAST(floor(t / 86400) * 86400 AS BIGINT) - d * 86400 + h * 3600 AS cycle_t FROM x)
       SELECT event_id, count(*) AS n_cycles, min(cycle_t) AS first_cycle FROM y WHERE t - cycle_t >= 0 AND (t - cycle_t) / 3600 <= fh GROUP BY 1""",
)
def _scl21(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "ts", (F.col("event_id") % 3).alias("system"))
    out = horizon.contributing_cycles(e, _config(spark))
    return out.groupBy("event_id").agg(
        F.count(F.lit(1)).alias("n_cycles"), F.min(F.unix_seconds("cycle")).alias("first_cycle")
    )


@query(
    "set05_distinct_cycles",
    "SELECT DISTINCT strftime(to_timestamp(cycle_t)::TIMESTAMP, '%Y%m%d%H') AS cycle FROM v_forecast",
)
def _set05(spark, sf_dir):
    f = view(spark, sf_dir, "v_forecast").select(F.date_format("cycle", "yyyyMMddHH").alias("cycle"))
    return horizon.ordered_cycles(f, "cycle")
