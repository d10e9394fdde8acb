"""Sources, provider rules, sinks: queries with SQL.

Files are stood in for by lines and payloads that Spark derives from the given
tables; the tests read and write real files.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from seamark.functions import angles, clock, geo, rounding, text, tidal
from seamark.operators import scores, sequence, stations
from seamark.plans.demo import LINE_HEAD, line_field, r6, secs, table, view
from seamark.plans.registry import query
from seamark.plans.score_queries import skill_sql
from seamark.sinks import tables as sink_tables
from seamark.sinks import text as sink_text
from seamark.sources import control_files, model, payloads, polygons, providers, series_text, tables

K = ["station_id"]
_TS = "CAST(floor(epoch({0})) AS BIGINT)"


def _pairs(spark, sf_dir):
    return view(spark, sf_dir, "v_pairs")


def _lines(spark, sf_dir, values):
    """Formatted series lines of the line items."""
    p = _pairs(spark, sf_dir)
    return sink_text.series_lines(p, ["station_id", "seq"], values).select(
        "station_id", "seq", F.col("line").alias("value")
    )


@query(
    "src01_series_text",
    "SELECT station_id, seq, t, round(model, 4) AS value FROM v_pairs",
)
def _src01(spark, sf_dir):
    out = series_text.parse_series(_lines(spark, sf_dir, ["model"]), keep=("station_id", "seq"))
    return out.select("station_id", "seq", secs("ts", "t"), F.round("value", 4).alias("value"))


@query(
    "src02_paired_text",
    "SELECT seq, t, obs, round(model, 4) AS model FROM v_pairs",
)
def _src02(spark, sf_dir):
    cols = {"obs": 6, "model": 7}
    out = series_text.parse_series(_lines(spark, sf_dir, ["obs", "model"]), cols, keep=("seq",))
    return out.select("seq", secs("ts", "t"), "obs", F.round("model", 4).alias("model"))


@query(
    "src26_cycle_lines",
    "SELECT seq, t, t - t % 21600 AS cycle_t, round(model, 4) AS value FROM v_pairs",
)
def _src26(spark, sf_dir):
    lines = _lines(spark, sf_dir, ["model"])
    cycle = F.timestamp_seconds(F.floor(F.unix_seconds("ts") / 21600) * 21600)
    out = series_text.for_cycle(lines, cycle, keep=("seq",))
    return out.select("seq", secs("ts", "t"), secs("cycle", "cycle_t"), F.round("value", 4).alias("value"))


_NAMES = ["cb_nowcast_temperature", "cb_forecast_a_currents_dir", "cb_forecast_b_currents", "cb_hindcast_water_level_hw", "cb_forecast_salinity", "other"]
_NAME_SQL = "CASE o_orderkey % 6 " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(_NAMES)) + " END"


@query(
    "src03_tag_from_file_name",
    f"""WITH f AS (SELECT o_custkey AS "ID", o_orderkey, {_NAME_SQL} AS nm FROM orders),
     t AS (SELECT *, CASE WHEN nm LIKE '%water_level_hw%' THEN 'Water Level high tide' WHEN nm LIKE '%temperature%' THEN 'Temperature'
       WHEN nm LIKE '%currents_dir%' THEN 'Current direction' WHEN nm LIKE '%currents%' THEN 'Current speed' WHEN nm LIKE '%salinity%' THEN 'Salinity' ELSE 'Other' END AS variable,
       CASE WHEN nm LIKE '%nowcast%' THEN 'Nowcast' WHEN nm LIKE '%forecast_a%' THEN 'Forecast (A)' WHEN nm LIKE '%forecast_b%' THEN 'Forecast (B)'
       WHEN nm LIKE '%forecast%' THEN 'Forecast' WHEN nm LIKE '%hindcast%' THEN 'Hindcast' ELSE 'Unknown' END AS "cast" FROM f)
     SELECT "ID" AS station_id, variable, "cast" AS cast_kind, max(o_orderkey) AS last_row FROM t GROUP BY 1, 2, 3""",
)
def _src03(spark, sf_dir):
    name = F.element_at(F.array(*[F.lit(n) for n in _NAMES]), (F.col("o_orderkey") % 6 + 1).cast("int"))
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("station_id"), "o_orderkey", name.alias("source_file"))
    tagged = tables.tag_rows(rows)
    last = sequence.keep_first(tagged, ["station_id", "variable", "cast"], ["o_orderkey"], last=True)
    return last.select("station_id", "variable", F.col("cast").alias("cast_kind"), F.col("o_orderkey").alias("last_row"))


@query(
    "src04_error_thresholds",
    """WITH d(variable, d1, d2) AS (VALUES ('salt',3.5,0.5),('temp',3.0,0.5),('wl',0.15,0.5),('cu',0.26,0.5),('cu_dir',22.5,0.5),('ice_conc',10.0,0.5)),
      c AS (SELECT CASE l_linenumber WHEN 1 THEN 'wl' WHEN 2 THEN 'temp' WHEN 3 THEN 'oxygen' ELSE 'cu' END AS variable, round(avg(l_discount), 4) AS x1, round(avg(l_tax), 4) AS x2 FROM lineitem GROUP BY 1)
      SELECT coalesce(d.variable, c.variable) AS variable, CAST(coalesce(c.x1, d.d1) AS DOUBLE) AS x1, CAST(coalesce(c.x2, d.d2) AS DOUBLE) AS x2
      FROM d FULL JOIN c ON c.variable = d.variable""",
)
def _src04(spark, sf_dir):
    n = F.col("l_linenumber")
    cfg = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.when(n == 1, "wl").when(n == 2, "temp").when(n == 3, "oxygen").otherwise("cu").alias("variable"))
        .agg(F.round(F.avg("l_discount"), 4).alias("x1"), F.round(F.avg("l_tax"), 4).alias("x2"))
    )
    return scores.thresholds(spark, cfg)


@query(
    "src05_station_control",
    """SELECT CAST(station_id AS VARCHAR) AS station_id, name, round(lat, 3) AS lat, round(lon, 3) AS lon, CASE WHEN station_id % 9 <> 0 THEN round(depth / 10, 2) END AS datum_shift,
       CASE WHEN station_id % 9 = 0 THEN 'RANGE' ELSE 'ok' END AS shift_status, depth, CASE WHEN station_id % 4 = 0 THEN 'up' END AS mounting FROM v_stations""",
)
def _src05(spark, sf_dir):
    s = view(spark, sf_dir, "v_stations")
    sid = F.col("station_id").cast("string")
    first = F.concat(sid, F.lit(" "), sid, F.lit('_temp_sys_GAUGE "'), F.col("name"), F.lit('"'))
    second = F.concat(
        F.format_string("  %.3f %.3f ", "lat", "lon"),
        F.when(F.col("station_id") % 9 == 0, F.lit("RANGE")).otherwise(F.format_string("%.2f", F.col("depth") / 10)),
        F.format_string("  %.2f  MLLW", "depth"),
        F.when(F.col("station_id") % 4 == 0, F.lit("  1.50  up")).otherwise(""),
    )
    lines = s.select(sid.alias("file"), F.posexplode(F.array(first, second)).alias("line_no", "value"))
    out = control_files.parse_station_control(lines)
    return out.select("station_id", "name", "lat", "lon", "datum_shift", "shift_status", "depth", "mounting")


@query(
    "src06_model_control",
    "SELECT node_id, CAST(node_id % 10 AS INTEGER) AS layer, round(lat, 3) AS node_lat, CAST(node_id * 3 AS VARCHAR) AS station_id, round(h / 4, 2) AS shift FROM v_nodes",
)
def _src06(spark, sf_dir):
    n = view(spark, sf_dir, "v_nodes")
    line = F.concat_ws(
        " ",
        F.col("node_id").cast("string"),
        (F.col("node_id") % 10).cast("string"),
        F.format_string("%.3f", "lat"),
        F.format_string("%.3f", "lon"),
        (F.col("node_id") * 3).cast("string"),
        F.format_string("%.2f", F.col("h") / 4),
    )
    out = control_files.parse_model_control(n.select(line.alias("value")))
    return out.select("node_id", "layer", "node_lat", "station_id", "shift")


@query(
    "src24_user_locations",
    "SELECT CAST(station_id AS VARCHAR) AS name, round(lat, 3) AS lat, depth FROM v_stations WHERE station_id % 6 <> 0",
)
def _src24(spark, sf_dir):
    s = view(spark, sf_dir, "v_stations")
    parts = F.format_string("%d  %.3f %.3f %.1f", "station_id", "lat", "lon", "depth")
    line = F.when(F.col("station_id") % 6 == 0, F.lit("broken line")).otherwise(parts)
    return control_files.parse_locations(s.select(line.alias("value"))).select("name", "lat", "depth")


@query(
    "src07_grid_frames",
    "SELECT l_orderkey, CAST(iy AS INTEGER) AS iy, CAST(ix AS INTEGER) AS ix, iy * 1e0 AS lat, ix * 1e0 AS lon, CASE WHEN iy = ix THEN NULL ELSE q * (iy + 1) + ix END AS value FROM (SELECT l_orderkey, sum(l_quantity) AS q FROM lineitem GROUP BY 1), range(3) a(iy), range(4) b(ix)",
)
def _src07(spark, sf_dir):
    q = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sum("l_quantity").alias("q"))

    def arr(fn):
        return F.array(*[F.array(*[fn(i, j) for j in range(4)]) for i in range(3)])

    frames = q.select(
        "l_orderkey",
        F.to_json(
            F.struct(
                arr(lambda i, j: F.lit(float(i))).alias("lats"),
                arr(lambda i, j: F.lit(float(j))).alias("lons"),
                arr(lambda i, j: F.lit(None).cast("double") if i == j else F.col("q") * (i + 1) + j).alias("values"),
            )
        ).alias("j"),
    ).select("l_orderkey", F.inline(F.array(F.from_json("j", payloads.GRID_SCHEMA))))
    return payloads.explode_grid(frames, keep=("l_orderkey",))


@query(
    "src08_observation_payload",
    f"""SELECT user_id AS station_id, CAST(floor(epoch(ts) / 60) * 60 AS BIGINT) AS t, value / 100 AS speed, CAST(event_id % 360 AS DOUBLE) AS dir_deg
      FROM events WHERE event_id % 3 = 1 OR event_id % 5 = 0""",
)
def _src08(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    rec = F.struct(
        F.date_format("ts", payloads.PAYLOAD_TIME).alias("t"),
        F.col("value").cast("string").alias("s"),
        (F.col("event_id") % 360).cast("string").alias("d"),
        F.when(F.col("event_id") % 5 != 0, (F.col("event_id") % 3).cast("string")).alias("b"),
    )
    body = e.groupBy(F.col("user_id").alias("station_id"), F.to_date("ts")).agg(
        F.to_json(F.struct(F.collect_list(rec).alias("data"))).alias("payload")
    )
    out = payloads.observations(body.withColumn("want", F.lit(1)), keep=("station_id", "want"), bin_column="want")
    return out.select("station_id", secs("ts", "t"), "speed", "dir_deg")


@query(
    "src09_buoy_normalisation",
    """SELECT event_id, value * 3048e-4 AS level, CASE WHEN value < 98 THEN 'MLLW' END AS datum FROM events WHERE event_id % 10 <> 0 AND value < 98 AND value >= -50""",
)
def _src09(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(
        "event_id", "ts", F.when(F.col("event_id") % 10 == 0, "MM").otherwise(F.col("value").cast("string")).alias("TIDE")
    )
    return providers.buoy_rows(e, "wl", keys=("event_id",)).select("event_id", F.col("value").alias("level"), "datum")


@query(
    "src09_buoy_currents",
    """SELECT event_id, CAST(event_id % 7 AS DOUBLE) AS depth, round(value / 100, 6) AS speed, CAST(event_id % 400 AS DOUBLE) AS dir_deg FROM events
       WHERE event_id % 7 <= 5 AND event_id % 400 <= 360 AND event_id % 10 <> 0""",
)
def _src09c(spark, sf_dir):
    k = F.col("event_id")
    e = table(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        (k % 7).cast("string").alias("DEP01"),
        (k % 400).cast("string").alias("DIR01"),
        F.when(k % 10 == 0, "MM").otherwise(F.col("value").cast("string")).alias("SPD01"),
    )
    return providers.buoy_rows(e, "cu", keys=("event_id",)).select("event_id", "depth", r6("value", "speed"), "dir_deg")


_GAUGE = ["00065", "72214", "62616", "00011", "00095", "72255", "70232", "72294", "00010"]
_GAUGE_VAR = ["wl", "wl", "wl", "temp", "salt", "cu", "cu", "cu", "temp"]


@query(
    "src10_gauge_units",
    """SELECT event_id, round(CASE event_id % 9 WHEN 0 THEN value * 3048e-4 WHEN 1 THEN value * 3048e-4 WHEN 3 THEN (value - 32) * 5 / 9 WHEN 4 THEN value * 64e-5
        WHEN 5 THEN value * 3048e-4 WHEN 6 THEN value * 5144e-4 WHEN 7 THEN value * 44704e-5 ELSE value END, 9) AS value,
       CASE event_id % 9 WHEN 0 THEN 'NAVD88' WHEN 1 THEN 'IGLD' WHEN 2 THEN 'NGVD' END AS datum FROM events""",
)
def _src10(spark, sf_dir):
    i = (F.col("event_id") % 9 + 1).cast("int")
    e = table(spark, sf_dir, "events").select(
        "event_id",
        F.element_at(F.array(*[F.lit(c) for c in _GAUGE]), i).alias("code"),
        F.element_at(F.array(*[F.lit(c) for c in _GAUGE_VAR]), i).alias("variable"),
        "value",
    )
    return providers.gauge_units(e).select("event_id", F.round("value", 9).alias("value"), "datum")


@query(
    "src11_first_code_series",
    """WITH e AS (SELECT user_id AS station_id, CAST(floor(epoch(ts) / 3600) AS BIGINT) AS hr, event_id AS seq, CASE event_id % 3 WHEN 0 THEN '00095' WHEN 1 THEN '00480' ELSE '00010' END AS code,
        event_id % 2 AS sid, value FROM events WHERE user_id % 4 <> 1 OR event_id % 3 <> 1),
      w AS (SELECT station_id, arg_min(code, (CASE WHEN code = '00480' THEN 0 ELSE 1 END, seq)) AS code, arg_min(sid, (CASE WHEN code = '00480' THEN 0 ELSE 1 END, seq)) AS sid FROM e GROUP BY 1)
      SELECT e.station_id, e.hr, e.code, arg_min(e.value, e.seq) AS value FROM e JOIN w ON w.station_id = e.station_id AND w.code = e.code AND w.sid = e.sid GROUP BY 1, 2, 3""",
)
def _src11(spark, sf_dir):
    k = F.col("event_id")
    e = (
        table(spark, sf_dir, "events")
        .filter("user_id % 4 <> 1 OR event_id % 3 <> 1")
        .select(
            F.col("user_id").alias("station_id"),
            F.lit("salt").alias("variable"),
            F.floor(clock.epoch(F.col("ts")) / 3600).alias("hr"),
            k.alias("seq"),
            F.when(k % 3 == 0, "00095").when(k % 3 == 1, "00480").otherwise("00010").alias("code"),
            (k % 2).alias("series_id"),
            "value",
        )
    )
    return providers.first_code_series(e, ts="hr").select("station_id", "hr", "code", "value")


@query(
    "src12_quality_filter",
    """SELECT user_id AS station_id, CAST(floor(epoch(ts) / 3600) AS BIGINT) AS hr, arg_min(value, event_id) AS value FROM events
       WHERE event_id % 5 IN (1, 2) GROUP BY 1, 2""",
)
def _src12(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("station_id"),
        F.floor(clock.epoch(F.col("ts")) / 3600).alias("hr"),
        F.col("event_id").alias("seq"),
        (F.col("event_id") % 5).cast("string").alias("qcFlagCode"),
        "value",
    )
    return providers.quality_rows(e, K, ts="hr").select("station_id", "hr", "value")


@query(
    "src13_first_sensor_pair",
    """WITH e AS (SELECT user_id AS station_id, CAST(floor(epoch(ts) / 21600) AS BIGINT) AS w, event_id % 4 AS c, max(value) AS value FROM events WHERE NOT (user_id % 3 = 0 AND event_id % 4 = 1) GROUP BY 1, 2, 3),
      b AS (SELECT station_id, CASE WHEN bool_or(c = 0) AND bool_or(c = 1) THEN 0 WHEN bool_or(c = 2) AND bool_or(c = 3) THEN 2 END AS s FROM e GROUP BY 1)
      SELECT s.station_id, s.w, s.value AS speed, d.value AS dir_deg FROM e s JOIN b ON b.station_id = s.station_id AND s.c = b.s
        JOIN e d ON d.station_id = s.station_id AND d.w = s.w AND d.c = b.s + 1""",
)
def _src13(spark, sf_dir):
    code = F.element_at(F.array(*[F.lit(c) for c in ("wcs1", "wcd1", "wcs2", "wcd2")]), (F.col("event_id") % 4 + 1).cast("int"))
    e = (
        table(spark, sf_dir, "events")
        .filter("NOT (user_id % 3 = 0 AND event_id % 4 = 1)")
        .groupBy(F.col("user_id").alias("station_id"), F.floor(clock.epoch(F.col("ts")) / 21600).alias("w"), code.alias("code"))
        .agg(F.max("value").alias("value"))
    )
    return providers.first_sensor_pair(e, ts="w")


@query(
    "src14_concat_runs",
    """SELECT l_suppkey AS node_id, CAST(floor((epoch(l_shipdate) + (l_partkey % 7) * 13 + 30) / 60) * 60 AS BIGINT) AS t, arg_max(l_quantity, l_orderkey * 10 + l_linenumber) AS last_value,
        arg_min(l_quantity, l_orderkey * 10 + l_linenumber) AS first_value FROM lineitem GROUP BY 1, 2""",
)
def _src14(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("node_id"),
        F.timestamp_seconds(clock.epoch(F.col("l_shipdate")) + F.col("l_partkey") % 7 * 13).alias("ts"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("file_order"),
        F.col("l_quantity").alias("value"),
    )
    last = model.concat_runs(li, ["node_id"], cast="nowcast", file_order="file_order")
    first = model.concat_runs(li, ["node_id"], cast="forecast_a", file_order="file_order")
    out = last.select("node_id", "ts", F.col("value").alias("last_value")).join(
        first.select("node_id", "ts", F.col("value").alias("first_value")), ["node_id", "ts"]
    )
    return out.select("node_id", secs("ts", "t"), "last_value", "first_value")


def _files(spark, sf_dir):
    """Model file names derived from the orders."""
    k = F.col("o_orderkey")
    name = F.concat(
        F.lit("sys.t"),
        F.format_string("%02d", k % 4 * 6),
        F.lit("z."),
        F.date_format("o_orderdate", "yyyyMMdd"),
        F.when(k % 5 == 0, ".stations.nowcast.nc").otherwise(F.concat(F.lit(".fields.n"), F.format_string("%03d", k % 7), F.lit(".nc"))),
    )
    return table(spark, sf_dir, "orders").select(name.alias("name"), k.alias("seq"), "o_custkey", "o_orderdate")


_FILES = """fl AS (SELECT o_orderkey AS seq, o_orderdate::DATE AS d, o_orderkey % 4 * 6 AS c, CASE WHEN o_orderkey % 5 = 0 THEN 999 ELSE o_orderkey % 7 END AS h, o_custkey, epoch(o_orderdate) AS e FROM orders)"""


@query(
    "src15_ordered_files",
    f"""WITH {_FILES} SELECT strftime(d, '%Y-%m-%d') AS day, format('{{:02d}}', c) AS cycle, format('{{:03d}}', h) AS hour, min(seq) AS seq FROM fl
        WHERE h <> 999 AND h <> 0 AND d BETWEEN DATE '1995-06-01' AND DATE '1999-06-02' GROUP BY 1, 2, 3""",
)
def _src15(spark, sf_dir):
    out = model.ordered_files(
        _files(spark, sf_dir), kind="fields", start=F.to_date(F.lit("1995-06-01")), end=F.to_date(F.lit("1999-06-01")), seq="seq", extra_days=1
    )
    return out.select(F.col("day").cast("string").alias("day"), "cycle", "hour", "seq")


@query(
    "src16_date_window",
    """WITH r AS (SELECT o_orderkey, o_orderdate::DATE AS s, o_orderdate::DATE + CAST(o_orderkey % 3 AS INTEGER) AS e, o_orderkey % 2 AS sys FROM orders)
       SELECT o_orderkey, strftime(unnest(range(s - CASE WHEN sys = 1 THEN 1 ELSE 0 END, e + CASE WHEN sys = 1 THEN 2 ELSE 1 END, INTERVAL 1 DAY)), '%Y-%m-%d') AS day FROM r""",
)
def _src16(spark, sf_dir):
    k = F.col("o_orderkey")
    req = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.to_date("o_orderdate").alias("start_day"),
        F.date_add(F.to_date("o_orderdate"), (k % 3).cast("int")).alias("end_day"),
        (k % 2).alias("system"),
        F.lit("nowcast").alias("cast"),
    )
    rules = spark.createDataFrame([(1, "nowcast", 1, 1)], "system bigint, cast string, ahead int, behind int")
    return model.date_window(req, rules).select("o_orderkey", F.col("day").cast("string").alias("day"))


@query(
    "src17_missing_files",
    f"""WITH {_FILES}, dd AS (SELECT DISTINCT d FROM fl), ex AS (SELECT d, c, h FROM dd, (VALUES (0), (6), (12), (18)) q(c), range(1, 7) r(h))
        SELECT strftime(d, '%Y%m%d') AS day, count(*) AS n_missing FROM (SELECT * FROM ex EXCEPT SELECT d, c, h FROM fl WHERE h <> 999) GROUP BY 1""",
)
def _src17(spark, sf_dir):
    files = _files(spark, sf_dir)
    days = files.select(F.to_date("o_orderdate").alias("day"), F.lit("sys").alias("system")).distinct()
    layout = spark.createDataFrame(
        [("sys", "fields", "n", [0, 6, 12, 18], 6)], "system string, kind string, run string, cycles array<int>, last_hour int"
    )
    out = model.missing_files(model.expected_names(days, layout), files)
    return out.groupBy(F.date_format("day", "yyyyMMdd").alias("day")).agg(F.count(F.lit(1)).alias("n_missing"))


@query(
    "src18_common_stations",
    """WITH p AS (SELECT DISTINCT l_linenumber AS file, round(30 + l_suppkey / 1e2, 5) AS lat, round(-80 - l_suppkey / 1e2, 5) AS lon FROM lineitem WHERE l_suppkey % 9 >= l_linenumber - 1),
      s AS (SELECT arg_min(file, (n, file)) AS file FROM (SELECT file, count(*) n FROM p GROUP BY 1)),
      w AS (SELECT lat, lon FROM p WHERE file IN (SELECT file FROM s))
      SELECT file, count(*) AS n_stations FROM p SEMI JOIN w ON w.lat = p.lat AND w.lon = p.lon GROUP BY 1""",
)
def _src18(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").filter("l_suppkey % 9 >= l_linenumber - 1").select(
        F.col("l_linenumber").alias("file"), (30 + F.col("l_suppkey") / 100.0).alias("lat"), (-80 - F.col("l_suppkey") / 100.0).alias("lon")
    ).distinct()
    return model.common_stations(li).groupBy("file").agg(F.count(F.lit(1)).alias("n_stations"))


@query(
    "src19_cast_window",
    """WITH n AS (SELECT l_orderkey, l_linenumber, l_quantity, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber) AS p, l_suppkey FROM lineitem)
       SELECT l_suppkey AS run, count(*) AS n_rows, sum(l_quantity) AS total FROM n WHERE p BETWEEN 61 AND 120 GROUP BY 1""",
)
def _src19(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("run"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("pos"), "l_quantity"
    )
    out = model.cast_window(li, cast="forecast_b", run="run", order="pos", steps_per_hour=10, forecast_hours=180, cycles_per_day=4)
    return out.groupBy("run").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("l_quantity").alias("total"))


@query(
    "src20_profile_text",
    """SELECT o_orderkey AS file, CAST(s AS INTEGER) AS station, CAST(l AS INTEGER) AS layer, CASE WHEN l = 2 AND o_orderkey % 3 = 0 THEN NULL ELSE o_custkey + s * 10 + l END * 1e0 AS value, -(s + l) * 1e0 AS z
       FROM orders, range(2) a(s), range(3) b(l)""",
)
def _src20(spark, sf_dir):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    vals = [
        F.when((k % 3 == 0), F.lit("-999999.0")).otherwise((c + s * 10 + layer).cast("string")) if layer == 2 else (c + s * 10 + layer).cast("string")
        for s in range(2)
        for layer in range(3)
    ]
    zs = [F.lit(str(-(s + layer))) for s in range(2) for layer in range(3)]
    surface, profile = F.lit("360.0 1.0 2.0"), F.concat_ws("  ", F.lit("360.0"), *vals, *zs)
    lines = table(spark, sf_dir, "orders").select(k.alias("file"), F.posexplode(F.array(surface, profile)).alias("line_no", "value"))
    return model.profile_lines(lines, 2).select("file", "station", "layer", "value", "z")


@query(
    "src20_surface_text",
    """SELECT o_orderkey AS file, CAST(floor(epoch(o_orderdate)) AS BIGINT) + 360 AS t, CAST(s AS INTEGER) AS station, CASE WHEN s = 1 THEN NULL ELSE o_custkey + s END * 1e0 AS value FROM orders, range(3) a(s)""",
)
def _src20s(spark, sf_dir):
    c = F.col("o_custkey")
    line = F.concat_ws(" ", F.lit("360.0"), c.cast("string"), F.lit("-9999999"), (c + 2).cast("string"))
    lines = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("file"), F.lit(0).alias("line_no"), line.alias("value"), F.col("o_orderdate").cast("timestamp").alias("base"))
    out = model.surface_lines(lines, F.col("base"))
    return out.select("file", secs("ts", "t"), "station", "value")


@query(
    "src21_bin_overrides",
    """WITH r AS (SELECT CAST(l_suppkey AS VARCHAR) AS station_id, l_linenumber AS bin, l_orderkey * 10 + l_linenumber AS seq, CASE WHEN l_orderkey % 4 <> 0 THEN l_quantity END AS depth FROM lineitem WHERE l_linenumber <> 7)
       SELECT station_id, bin, max(seq) AS seq, arg_max(coalesce(depth, -1), seq) AS depth_or_minus1 FROM r GROUP BY 1, 2""",
)
def _src21(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("station_id"),
        F.when(F.col("l_linenumber") == 7, "seven").otherwise(F.col("l_linenumber").cast("string")).alias("bin"),
        F.when(F.col("l_orderkey") % 4 == 0, "deep").otherwise(F.col("l_quantity").cast("string")).alias("depth"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"),
    )
    out = tables.clean_overrides(li.withColumn("name", F.col("seq").cast("string")), "seq")
    return out.select("station_id", "bin", F.col("name").cast("bigint").alias("seq"), F.coalesce("depth", F.lit(-1.0)).alias("depth_or_minus1"))


@query(
    "src21_virtual_id_split",
    """SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_name ELSE c_name END AS parent_id, CASE WHEN c_custkey % 3 <> 0 THEN CAST(c_custkey % 50 AS INTEGER) END AS bin FROM customer""",
)
def _src21v(spark, sf_dir):
    k = F.col("c_custkey")
    vid = F.when(k % 3 == 0, F.col("c_name")).otherwise(text.bin_station_id(F.col("c_name"), k % 50))
    c = table(spark, sf_dir, "customer").select("c_custkey", vid.alias("station_id"))
    return tables.split_virtual_ids(c).select("c_custkey", "parent_id", "bin")


@query(
    "src22_majority_size",
    """WITH c AS (SELECT l_suppkey, CAST(l_quantity AS BIGINT) AS sz, count(*) n FROM lineitem GROUP BY 1, 2), m AS (SELECT l_suppkey, arg_min(sz, (-n, sz)) AS sz FROM c GROUP BY 1)
       SELECT l.l_suppkey AS dir, count(*) AS n_files, min(CAST(l.l_quantity AS BIGINT)) AS length FROM lineitem l JOIN m ON m.l_suppkey = l.l_suppkey AND CAST(l.l_quantity AS BIGINT) = m.sz GROUP BY 1""",
)
def _src22(spark, sf_dir):
    f = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("dir"), F.col("l_quantity").cast("bigint").alias("length"))
    return model.majority_size(f, ["dir"]).groupBy("dir").agg(F.count(F.lit(1)).alias("n_files"), F.min("length").alias("length"))


@query(
    "src23_wkt_polygons",
    """SELECT station_id AS domain, 0 AS ring, 4 AS n_vertices, round(lat - 1e-1, 3) AS lat_min, round(lat + 1e-1, 3) AS lat_max, round(lon - 2e-1, 3) AS lon_min FROM v_stations""",
)
def _src23(spark, sf_dir):
    s = view(spark, sf_dir, "v_stations")
    lat, lon = F.col("lat"), F.col("lon")

    def point(x, y):
        return F.format_string("%.6f %.6f", x, y)

    big = F.concat_ws(", ", point(lon - 0.2, lat - 0.1), point(lon + 0.2, lat - 0.1), point(lon + 0.2, lat + 0.1), point(lon - 0.2, lat + 0.1))
    small = F.concat_ws(", ", point(lon, lat), point(lon + 0.01, lat), point(lon, lat + 0.01))
    wkt = F.concat(F.lit("MULTIPOLYGON((("), big, F.lit(")), (("), small, F.lit(")))"))
    rings = polygons.parse_wkt(s.select(F.col("station_id").alias("domain"), wkt.alias("wkt")))
    out = polygons.main_ring(rings)
    return out.select(
        "domain", "ring", F.size("vertices").alias("n_vertices"), *[F.round(c, 3).alias(c) for c in ("lat_min", "lat_max", "lon_min")]
    )


@query(
    "src25_tide_payload",
    """SELECT DISTINCT user_id AS station_id, CAST(floor(epoch(ts) / 60) * 60 AS BIGINT) AS t, value AS tide FROM events
       WHERE epoch(ts) >= 1704585600 AND floor(epoch(ts) / 60) * 60 <= 1705449600""",
)
def _src25(spark, sf_dir):
    rec = F.struct(F.date_format("ts", payloads.PAYLOAD_TIME).alias("t"), F.col("value").cast("string").alias("v"))
    body = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("station_id"), F.to_date("ts")).agg(
        F.to_json(F.struct(F.collect_list(rec).alias("predictions"))).alias("payload")
    )
    out = payloads.tide_predictions(body, F.timestamp_seconds(F.lit(1704585600)), F.timestamp_seconds(F.lit(1705449600)))
    return out.select("station_id", secs("ts", "t"), "tide")


@query(
    "src25_harmonic_payload",
    """SELECT c_custkey AS station_id, CASE c_custkey % 3 WHEN 0 THEN 'LDA2' WHEN 1 THEN 'RHO1' ELSE 'M2' END AS constituent, c_acctbal AS amplitude FROM customer""",
)
def _src25h(spark, sf_dir):
    k = F.col("c_custkey")
    rec = F.struct(
        F.when(k % 3 == 0, " lam2").when(k % 3 == 1, "RHO").otherwise("m2").alias("name"),
        F.col("c_acctbal").alias("amplitude"),
        F.lit(1.0).alias("phase_GMT"),
    )
    body = table(spark, sf_dir, "customer").select(
        k.alias("station_id"), F.to_json(F.struct(F.array(rec, rec).alias("HarmonicConstituents"))).alias("payload")
    )
    return payloads.harmonic_constants(body).select("station_id", "constituent", "amplitude")


@query(
    "src27_latest_cycle",
    """SELECT o_custkey AS system, arg_max(o_orderkey % 4 * 6, epoch(o_orderdate) * 100000 + o_orderkey) AS cycle FROM orders GROUP BY 1""",
)
def _src27(spark, sf_dir):
    f = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("system"),
        (F.col("o_orderkey") % 4 * 6).alias("cycle"),
        (clock.epoch(F.col("o_orderdate")) * 100000 + F.col("o_orderkey")).alias("modified"),
    )
    return model.latest_cycle(f).select("system", "cycle")


@query(
    "src28_daily_snapshot",
    f"""WITH {_FILES} SELECT seq, CAST(e AS BIGINT) + 12 * 3600 - (6 - h) * 3600 AS t FROM fl WHERE h = 3 AND c = 12""",
)
def _src28(spark, sf_dir):
    return model.daily_snapshot(_files(spark, sf_dir), cycle="12", hour="003").select("seq", secs("ts", "t"))


@query(
    "snk01_series_lines",
    f"""SELECT seq, {LINE_HEAD} || ' ' || {line_field('model')} AS line FROM (SELECT *, make_timestamp(t * 1000000) AS d FROM v_pairs)""",
)
def _snk01(spark, sf_dir):
    out = sink_text.series_lines(_pairs(spark, sf_dir), ["seq"], ["model"])
    return out.select("seq", "line")


@query(
    "snk01_vector_lines",
    f"""SELECT seq, {LINE_HEAD} || ' ' || {line_field('obs_speed')} || ' ' || {line_field('obs_dir')} || ' ' || {line_field('obs_speed * sin(radians(obs_dir))')}
        || ' ' || {line_field('obs_speed * cos(radians(obs_dir))')} AS line FROM (SELECT *, make_timestamp(t * 1000000) AS d FROM v_currents)""",
)
def _snk01v(spark, sf_dir):
    c = view(spark, sf_dir, "v_currents")
    out = sink_text.vector_lines(c, ["seq"], "obs_speed", "obs_dir")
    return out.select("seq", "line")


@query(
    "snk06_insert_or_ignore",
    """WITH n AS (SELECT l_suppkey AS station_id, l_shipdate::DATE AS d, l_orderkey * 10 + l_linenumber AS seq, l_quantity AS rmse FROM lineitem WHERE l_linenumber > 2),
      x AS (SELECT DISTINCT l_suppkey AS station_id, l_shipdate::DATE AS d FROM lineitem WHERE l_linenumber <= 2)
      SELECT station_id, strftime(d, '%Y-%m-%d') AS begin_day, min(seq) AS seq, arg_min(rmse, seq) AS rmse FROM n ANTI JOIN x ON x.station_id = n.station_id AND x.d = n.d GROUP BY 1, 2""",
)
def _snk06(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("station_id"),
        F.to_date("l_shipdate").cast("string").alias("begin_day"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"),
        F.col("l_quantity").alias("rmse"),
        "l_linenumber",
    )
    keys = ["station_id", "begin_day"]
    out = sink_tables.insert_or_ignore(li.filter("l_linenumber <= 2"), li.filter("l_linenumber > 2").drop("l_linenumber"), keys, "seq")
    return out


@query(
    "snk06_period_guard",
    """SELECT o_orderkey, NOT (o_orderkey % 40 = 1) AS monthly_ok, NOT (o_orderkey % 40 BETWEEN 28 AND 31) AS daily_ok FROM orders""",
)
def _snk06p(spark, sf_dir):
    start = F.to_date("o_orderdate")
    end = F.date_add(start, (F.col("o_orderkey") % 40).cast("int"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        sink_tables.period_matches(start, end, "monthly").alias("monthly_ok"),
        sink_tables.period_matches(start, end, "daily").alias("daily_ok"),
    )


@query(
    "snk12_append_new_deployments",
    """SELECT station_id, name FROM v_stations WHERE station_id % 3 <> 0""",
)
def _snk12(spark, sf_dir):
    s = view(spark, sf_dir, "v_stations").select("station_id", "name")
    return sink_tables.insert_or_ignore(s.filter("station_id % 3 = 0"), s.unionByName(s), ["station_id"])


@query(
    "snk07_ascii_grid_rows",
    """SELECT t, iy, string_agg(CASE WHEN obs IS NULL THEN '-9999' ELSE CAST(CAST(obs AS BIGINT) AS VARCHAR) END, ' ' ORDER BY ix) AS line FROM v_ice GROUP BY 1, 2""",
)
def _snk07(spark, sf_dir):
    g = view(spark, sf_dir, "v_ice")
    out = sink_text.ascii_rows(g, ["ts"], lat="iy", lon="ix", value="obs")
    return out.select(secs("ts", "t"), F.col("row_lat").alias("iy"), "line")


@query(
    "snk07_ascii_grid_header",
    """SELECT t, count(DISTINCT ix) AS ncols, count(DISTINCT iy) AS nrows, round(min(ix) - coalesce((max(ix) - min(ix)) / nullif(count(DISTINCT ix) - 1, 0), 0) / 2, 6) AS xllcorner FROM v_ice GROUP BY 1""",
)
def _snk07h(spark, sf_dir):
    h = sink_text.ascii_header(view(spark, sf_dir, "v_ice"), ["ts"], lat="iy", lon="ix")
    return h.select(secs("ts", "t"), "ncols", "nrows", r6("xllcorner"))


@query(
    "snk08_grid_json",
    """SELECT t, count(*) AS n_cells, count(obs) AS n_valid, CAST(sum(obs) AS DOUBLE) AS total FROM v_ice GROUP BY t""",
)
def _snk08(spark, sf_dir):
    g = view(spark, sf_dir, "v_ice").withColumn("lat", F.col("iy") * 1.0).withColumn("lon", F.col("ix") * 1.0)
    j = sink_text.grid_json(g, ["ts"], "obs")
    cells = F.flatten(F.from_json("json", payloads.GRID_SCHEMA)["values"])
    total = F.aggregate(cells, F.lit(0.0), lambda a, x: a + F.coalesce(x, F.lit(0.0)))
    valid = F.size(F.filter(cells, lambda x: x.isNotNull()))
    return j.select(
        secs("ts", "t"), F.size(cells).alias("n_cells"), valid.alias("n_valid"), F.when(valid > 0, total).alias("total")
    )


@query(
    "snk09_datum_report",
    """WITH m AS (SELECT station_id, CASE station_id % 8 WHEN 0 THEN -9999e0 WHEN 1 THEN -9991e0 WHEN 2 THEN NULL ELSE depth / 7 END AS mo,
        CASE WHEN station_id % 5 = 0 THEN NULL ELSE depth / 10 END AS ds, CASE WHEN station_id % 5 = 0 THEN 'UNKNOWN' ELSE 'ok' END AS st FROM v_stations),
      r AS (SELECT *, CASE WHEN mo IS NULL THEN 'NA' WHEN ds IS NOT NULL AND mo > -999 THEN 'pass' ELSE 'fail' END AS conversion FROM m)
      SELECT station_id, conversion, CASE WHEN conversion = 'NA' THEN 'no station output of the model to shift' WHEN conversion = 'fail' THEN
        concat_ws('; ', CASE WHEN st = 'UNKNOWN' THEN 'observation side cannot be converted to the target datum' END, CASE WHEN mo = -9999 THEN 'model position lies outside the datum grid' END,
          CASE WHEN mo = -9991 THEN 'model side cannot be converted to the target datum' END) ELSE '' END AS reason FROM r""",
)
def _snk09(spark, sf_dir):
    k = F.col("station_id")
    s = view(spark, sf_dir, "v_stations")
    m = s.select(
        "station_id",
        F.when(k % 8 == 0, -9999.0).when(k % 8 == 1, -9991.0).when(k % 8 == 2, F.lit(None)).otherwise(F.col("depth") / 7).alias("model_offset"),
    )
    o = s.select(
        "station_id",
        F.lit("GAUGE").alias("source"),
        F.lit("MLLW").alias("datum"),
        F.when(k % 5 != 0, F.col("depth") / 10).alias("datum_shift"),
        F.when(k % 5 == 0, "UNKNOWN").otherwise("ok").alias("shift_status"),
    )
    return sink_tables.datum_report(m, o, target="MLLW").select("station_id", "conversion", "reason")


@query(
    "snk10_time_file_key",
    "SELECT t, max(seq) AS file FROM v_model GROUP BY t",
)
def _snk10(spark, sf_dir):
    return sink_tables.time_file_key(view(spark, sf_dir, "v_model"), file="seq").select(secs("ts", "t"), F.col("seq").alias("file"))


@query(
    "snk11_frame_table",
    """SELECT t, round(100.0 * count(*) FILTER (model - obs >= 6) / nullif(count(model - obs), 0), 6) AS pos, round(100.0 * count(*) FILTER (model - obs <= -6) / nullif(count(model - obs), 0), 6) AS neg FROM v_grid GROUP BY t""",
)
def _snk11(spark, sf_dir):
    from seamark.operators import grids

    t = sink_tables.frame_table(grids.frame_statistics(view(spark, sf_dir, "v_grid")))
    return t.select(secs("Date", "t"), r6("Positive outlier freq", "pos"), r6("Negative outlier freq", "neg"))


def _graded_sql(column: str, limit: int, name: str) -> str:
    return f"""{column} AS {name}, CASE WHEN {column} IS NULL THEN 'NA' WHEN {column} <= {limit} THEN 'pass' ELSE 'fail' END AS {name}_pass_fail"""


def _absent_sql(*names: str) -> str:
    return ", ".join(f'CAST(NULL AS VARCHAR) AS "{n}"' for n in names)


@query(
    "snk03_skill_table",
    f"""SELECT station_id AS "ID", {_absent_sql("NODE", "obs_water_depth", "mod_water_depth")}, rmse, r, bias, bias_perc, {_absent_sql("bias_dir")},
      central_freq, central_freq_pass_fail, {_graded_sql("pos_outlier_freq", 1, "pos_outlier_freq")}, {_graded_sql("neg_outlier_freq", 1, "neg_outlier_freq")},
      {_graded_sql("max_pos_hours", 24, "max_duration_pos_outlier")}, {_graded_sql("max_neg_hours", 24, "max_duration_neg_outlier")},
      CAST(NULL AS DOUBLE) AS worst_case_outlier_freq, 'NA' AS worst_case_outlier_freq_pass_fail, bias_std AS bias_standard_dev,
      1e0 AS target_error_range, {_absent_sql("datum", "Y", "X", "start_date", "end_date")}
      FROM ({skill_sql("p AS (SELECT *, model - obs AS e FROM v_pairs)", "round_even(bias, 2)", order="t, seq")}) WHERE n_pairs >= 5""",
)
def _snk03(spark, sf_dir):
    s = scores.skill_scalar(_pairs(spark, sf_dir), K, x1=1.0, tie=["seq"]).filter("n_pairs >= 5")
    return sink_tables.skill_table(s)


_TIDES = """t AS (SELECT c_custkey AS station_id, i + 1 AS n, ['M2', 'S2', 'K1'][i + 1] AS constituent, (c_custkey * (i + 1)) / 3e3 AS ref_amp, (c_custkey * (i + 1)) % 360 / 7e0 AS ref_phase,
      CASE WHEN c_custkey % 5 > 0 THEN c_acctbal / 9e0 + i END AS model_amp, CASE WHEN c_custkey % 5 > 0 THEN c_custkey % 359 + i / 3e0 END AS model_phase FROM customer, range(3) r(i)),
    d AS (SELECT *, model_amp - ref_amp AS amp_diff, model_phase - ref_phase AS phase_diff, abs(model_amp - ref_amp) / 7e0 AS vector_diff FROM t)"""
_SHOWN = ", ".join(f"coalesce(printf('%.{1 if 'phase' in c else 4}f', {c}), '') AS {c}" for c in ("ref_amp", "ref_phase", "model_amp", "model_phase", "amp_diff", "phase_diff", "vector_diff"))


def _tides(spark, sf_dir):
    k, i = F.col("c_custkey"), F.col("i")
    t = table(spark, sf_dir, "customer").withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(2))))
    t = t.select(
        k.alias("station_id"),
        (i + 1).alias("n"),
        F.element_at(F.array(*map(F.lit, ("M2", "S2", "K1"))), i + 1).alias("constituent"),
        (k * (i + 1) / 3000.0).alias("ref_amp"),
        (k * (i + 1) % 360 / 7.0).alias("ref_phase"),
        F.when(k % 5 > 0, F.col("c_acctbal") / 9.0 + i).alias("model_amp"),
        F.when(k % 5 > 0, k % 359 + i / 3.0).alias("model_phase"),
    )
    amp = F.col("model_amp") - F.col("ref_amp")
    return t.select("*", amp.alias("amp_diff"), (F.col("model_phase") - F.col("ref_phase")).alias("phase_diff"), (F.abs(amp) / 7.0).alias("vector_diff"))


@query("snk04_constituent_rows", f"WITH {_TIDES} SELECT station_id, n, constituent, {_SHOWN} FROM d")
def _snk04(spark, sf_dir):
    return sink_tables.constituent_rows(_tides(spark, sf_dir), K)


@query(
    "snk04_constituent_file",
    f"""WITH {_TIDES}, s AS (SELECT station_id, n, constituent, {_SHOWN} FROM d),
      f AS (SELECT station_id, count(vector_diff) AS n_valid, avg(vector_diff) AS mean_vector_diff FROM d GROUP BY 1)
      SELECT station_id, 0 AS part, j AS n, ['# Station: ' || station_id, '# Datum: MSL', 'N,Constituent,Ref_Amp,Ref_Phase,Model_Amp,Model_Phase,Amp_Diff,Phase_Diff,Vector_Diff'][j + 1] AS line FROM f, range(3) r(j)
      UNION ALL SELECT station_id, 1, n, concat_ws(',', n, constituent, ref_amp, ref_phase, model_amp, model_phase, amp_diff, phase_diff, vector_diff) FROM s
      UNION ALL SELECT station_id, 2, j, ['', '# n_valid: ' || n_valid, '# mean_vector_diff: ' || coalesce(printf('%.6f', mean_vector_diff), 'nan')][j + 1] FROM f, range(3) r(j)""",
)
def _snk04f(spark, sf_dir):
    """Whole constituent files: comments, headings, constituents in order, summary."""
    t = _tides(spark, sf_dir)
    stats = t.groupBy("station_id").agg(F.count("vector_diff").alias("n_valid"), F.avg("vector_diff").alias("mean_vector_diff"))
    return sink_tables.constituent_file(t, K, stats=stats, metadata={"Datum": "MSL"})


# ------------------------------------------------------------ scalar functions


@query(
    "scl01_signed_angle",
    """SELECT seq, CASE WHEN (model_dir - obs_dir) BETWEEN 0 AND 180 OR (model_dir - obs_dir) BETWEEN -360 AND -180 THEN 1 ELSE -1 END
        * least(abs(model_dir - obs_dir) % 360, 360 - abs(model_dir - obs_dir) % 360) AS d FROM v_currents""",
)
def _scl01(spark, sf_dir):
    c = view(spark, sf_dir, "v_currents")
    return c.select("seq", angles.signed_angle(F.col("model_dir"), F.col("obs_dir")).alias("d"))


@query(
    "scl02_uv_from_polar",
    "SELECT seq, round(obs_speed * sin(radians(obs_dir)), 6) AS u, round(obs_speed * cos(radians(obs_dir)), 6) AS v FROM v_currents",
)
def _scl02(spark, sf_dir):
    s, d = F.col("obs_speed"), F.col("obs_dir")
    return view(spark, sf_dir, "v_currents").select(
        "seq", F.round(angles.east(s, d), 6).alias("u"), F.round(angles.north(s, d), 6).alias("v")
    )


@query(
    "scl03_polar_from_uv",
    """SELECT l_orderkey, l_linenumber, round(sqrt(u*u + v*v), 6) AS speed, round(fmod(degrees(atan2(u, v)) + 360, 360), 6) AS dir_deg
       FROM (SELECT *, l_quantity - 25.5e0 AS u, l_extendedprice / 1e3 - 40.123e0 AS v FROM lineitem)""",
)
def _scl03(spark, sf_dir):
    u, v = F.col("l_quantity") - 25.5, F.col("l_extendedprice") / 1000.0 - 40.123
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.round(angles.speed_of(u, v), 6).alias("speed"),
        F.round(angles.direction_of(u, v), 6).alias("dir_deg"),
    )


@query(
    "scl06_longitudes",
    """SELECT o_orderkey, CASE WHEN lon > 180 THEN lon - 360 ELSE lon END AS west, fmod(lon + 180, 360) - 180 AS wrapped FROM (SELECT o_orderkey, CAST(o_orderkey % 720 AS DOUBLE) AS lon FROM orders)""",
)
def _scl06(spark, sf_dir):
    lon = (F.col("o_orderkey") % 720).cast("double")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", geo.west_negative(lon).alias("west"), geo.wrap_longitude(lon).alias("wrapped")
    )


@query(
    "scl07_julian_day",
    "SELECT seq, round(t / 86400e0 + 24405875e-1, 4) AS jd, year(to_timestamp(t)::TIMESTAMP) AS y, hour(to_timestamp(t)::TIMESTAMP) AS h FROM v_model",
)
def _scl07(spark, sf_dir):
    return view(spark, sf_dir, "v_model").select(
        "seq", clock.julian_day(F.col("ts")).alias("jd"), F.year("ts").alias("y"), F.hour("ts").alias("h")
    )


@query(
    "scl08_request_times",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 2 THEN NULL ELSE CAST(epoch(o_orderdate) AS BIGINT) END AS t FROM orders",
)
def _scl08(spark, sf_dir):
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    s = (
        F.when(k % 3 == 0, F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(k % 3 == 1, F.date_format(d, "yyyyMMdd-HH:mm:ss"))
        .otherwise(F.date_format(d, "dd.MM.yyyy"))
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", F.unix_seconds(clock.parse_request_time(s)).alias("t"))


@query(
    "scl09_phase_gap",
    "SELECT seq, fmod(model_dir - obs_dir + 180 + 360, 360) - 180 AS d FROM v_currents",
)
def _scl09(spark, sf_dir):
    return view(spark, sf_dir, "v_currents").select("seq", angles.phase_gap(F.col("model_dir"), F.col("obs_dir")).alias("d"))


@query(
    "scl10_phasor_gap",
    """SELECT seq, CASE WHEN obs_speed IS NOT NULL THEN round(sqrt(greatest(model_speed*model_speed + obs_speed*obs_speed - 2*model_speed*obs_speed*cos(radians(fmod(model_dir - obs_dir + 540, 360) - 180)), 0)), 6) END AS d FROM v_currents""",
)
def _scl10(spark, sf_dir):
    d = angles.phasor_gap(F.col("model_speed"), F.col("model_dir"), F.col("obs_speed"), F.col("obs_dir"))
    return view(spark, sf_dir, "v_currents").select("seq", F.round(d, 6).alias("d"))


@query(
    "scl11_exceedance_codes",
    """SELECT event_id, concat_ws(',', CASE WHEN abs(value / 1e3) > 5e-2 THEN 'AMP' END, CASE WHEN abs(event_id % 25) > 10 THEN 'PHASE' END, CASE WHEN value / 5e2 > 5e-2 THEN 'VD' END) AS codes FROM events""",
)
def _scl11(spark, sf_dir):
    codes = tidal.exceedance_codes(F.col("value") / 1000.0, F.col("event_id") % 25, F.col("value") / 500.0)
    return table(spark, sf_dir, "events").select("event_id", codes.alias("codes"))


@query(
    "scl12_constituent_names",
    "SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'LDA2' WHEN 1 THEN 'RHO1' WHEN 2 THEN 'M2' ELSE 'XX9' END AS name FROM orders",
)
def _scl12(spark, sf_dir):
    k = F.col("o_orderkey") % 4
    raw = F.when(k == 0, " lam2 ").when(k == 1, "rho").when(k == 2, "M2").otherwise("xx9")
    return table(spark, sf_dir, "orders").select("o_orderkey", tidal.standard_name(raw).alias("name"))


@query(
    "scl13_record_class",
    "SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 400 < 20 THEN 'short' WHEN l_partkey % 400 < 180 THEN 'standard' ELSE 'long' END AS class FROM lineitem",
)
def _scl13(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", tidal.record_class(F.col("l_partkey") % 400).alias("class"))


@query(
    "scl22_file_valid_time",
    f"WITH {_FILES} SELECT seq, CAST(e AS BIGINT) + c * 3600 - (6 - h) * 3600 AS t FROM fl WHERE h <> 999",
)
def _scl22(spark, sf_dir):
    f = _files(spark, sf_dir).filter("name LIKE '%fields%'")
    return f.select("seq", F.unix_seconds(clock.valid_time_of_file(F.col("name"))).alias("t"))


@query(
    "scl23_mounting_symbols",
    """SELECT l_orderkey, l_linenumber, CASE l_linenumber % 5 WHEN 0 THEN 'side' WHEN 1 THEN 'up' WHEN 2 THEN 'down' WHEN 3 THEN 'side' ELSE 'unknown' END AS mounting FROM lineitem""",
)
def _scl23(spark, sf_dir):
    k = F.col("l_linenumber") % 5
    raw = F.when(k == 0, "Horizontal").when(k == 1, " u ").when(k == 2, "downward-looking").when(k == 3, "side-looking").otherwise("buoy")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", text.mounting_symbol(raw).alias("mounting"))


@query(
    "scl24_kelvin_epoch",
    "SELECT event_id, round(value - 273.15e0, 6) AS celsius, CAST(floor(epoch(ts)) AS BIGINT) AS t FROM events",
)
def _scl24(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select(
        "event_id",
        F.round(clock.kelvin_to_celsius(F.col("value")), 6).alias("celsius"),
        F.unix_seconds(F.timestamp_seconds(clock.epoch(F.col("ts")))).alias("t"),
    )


@query(
    "scl25_day_count_times",
    """SELECT o_orderkey, CAST(epoch(o_orderdate) AS BIGINT) + 21600 AS from_days, CAST(epoch(o_orderdate) AS BIGINT) + o_orderkey % 86400 AS from_millis FROM orders""",
)
def _scl25(spark, sf_dir):
    day = clock.epoch(F.col("o_orderdate")) / 86400 + clock.MODIFIED_JULIAN_DAY_OF_1970
    ms = F.col("o_orderkey") % 86400 * 1000
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.unix_seconds(clock.from_modified_julian(day + 0.25)).alias("from_days"),
        F.unix_seconds(clock.from_day_and_millis(day.cast("bigint"), ms)).alias("from_millis"),
    )


@query(
    "scl26_half_even",
    "SELECT l_orderkey, l_linenumber, round_even(l_extendedprice / 8, 2) AS r2 FROM lineitem",
)
def _scl26(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", rounding.half_even(F.col("l_extendedprice") / 8, 2).alias("r2")
    )


@query(
    "scl27_list_arguments",
    "SELECT c_custkey, lower(replace(c_mktsegment, ' ', '')) AS first_item, 2 AS n_items, CASE c_custkey % 3 WHEN 0 THEN 'NAVD88' WHEN 1 THEN 'IGLD85' ELSE 'MLLW' END AS datum FROM customer",
)
def _scl27(spark, sf_dir):
    arg = F.concat(F.lit("["), F.col("c_mktsegment"), F.lit(", Temp ]"))
    k = F.col("c_custkey") % 3
    items = text.split_list(arg)
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.element_at(items, 1).alias("first_item"),
        F.size(items).alias("n_items"),
        text.datum_name(F.when(k == 0, "navd").when(k == 1, "IGLD").otherwise("MLLW")).alias("datum"),
    )


@query(
    "scl28_bar_labels",
    "SELECT seq, CAST(station_id AS VARCHAR) || '@' || printf('%.1f', model) || 'm' AS label, CASE WHEN obs BETWEEN -20 AND 20 THEN 'pass' ELSE 'fail' END AS mark FROM v_pairs",
)
def _scl28(spark, sf_dir):
    return _pairs(spark, sf_dir).select(
        "seq",
        text.depth_label(F.col("station_id").cast("string"), F.col("model")).alias("label"),
        text.passes(F.abs("obs"), 20, at_least=False).alias("mark"),
    )


@query(
    "scl32_vector_difference",
    """SELECT seq, round(model_speed * sin(radians(model_dir)) - obs_speed * sin(radians(obs_dir)), 6) AS du,
       round(sqrt((model_speed * sin(radians(model_dir)) - obs_speed * sin(radians(obs_dir)))**2 + (model_speed * cos(radians(model_dir)) - obs_speed * cos(radians(obs_dir)))**2), 6) AS gap FROM v_currents""",
)
def _scl32(spark, sf_dir):
    mu, mv = angles.east(F.col("model_speed"), F.col("model_dir")), angles.north(F.col("model_speed"), F.col("model_dir"))
    ou, ov = angles.east(F.col("obs_speed"), F.col("obs_dir")), angles.north(F.col("obs_speed"), F.col("obs_dir"))
    return view(spark, sf_dir, "v_currents").select(
        "seq", F.round(mu - ou, 6).alias("du"), F.round(angles.vector_gap(mu, mv, ou, ov), 6).alias("gap")
    )


@query(
    "flt01_time_window",
    "SELECT station_id, seq, t FROM v_model WHERE t >= 852076800 - 6 * 3600 AND t <= 883612800",
)
def _flt01(spark, sf_dir):
    from seamark.operators import pairing

    start, end = F.timestamp_seconds(F.lit(852076800)), F.timestamp_seconds(F.lit(883612800))
    m = view(spark, sf_dir, "v_model")
    return m.filter(pairing.in_window(F.col("ts"), start, end, 6)).select("station_id", "seq", secs("ts", "t"))


@query(
    "flt02_sentinel_mask",
    "SELECT l_orderkey, l_linenumber, CASE WHEN abs(l_extendedprice / 50 - 900) <= 999 THEN l_extendedprice / 50 - 900 END AS v FROM lineitem",
)
def _flt02(spark, sf_dir):
    v = series_text.sentinel_mask(F.col("l_extendedprice") / 50 - 900)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", v.alias("v"))


@query(
    "agg37_inventory_dedup",
    """WITH i AS (SELECT c_mktsegment AS "Source", CAST(c_custkey % 200 AS VARCHAR) AS "ID", c_acctbal AS "X", c_custkey AS "Y", c_name AS "Name", c_custkey % 7 = 0 AS has_wl, CASE WHEN c_custkey % 2 = 0 THEN false END AS has_temp, c_custkey FROM customer)
       SELECT "Source", "ID", arg_min("X", c_custkey) AS "X", arg_min("Name", c_custkey) AS "Name", bool_or(has_wl) AS has_wl, bool_or(coalesce(has_temp, true)) AS has_temp FROM i GROUP BY 1, 2""",
)
def _agg37(spark, sf_dir):
    k = F.col("c_custkey")
    inv = table(spark, sf_dir, "customer").select(
        F.col("c_mktsegment").alias("Source"),
        (k % 200).cast("string").alias("ID"),
        F.col("c_acctbal").alias("X"),
        k.alias("Y"),
        F.col("c_name").alias("Name"),
        (k % 7 == 0).alias("has_wl"),
        F.when(k % 2 == 0, F.lit(False)).alias("has_temp"),
        k.alias("seq"),
    )
    merged = stations.merge_inventories(inv)
    return stations.dedup_inventory(merged, ["priority", "seq"]).select("Source", "ID", "X", "Name", "has_wl", "has_temp")


@query(
    "agg38_capability_flags",
    """SELECT l_suppkey AS station_id, bool_or(l_linenumber = 1 AND l_returnflag = 'N') AS has_wl, bool_or(l_linenumber IN (3, 4) AND l_returnflag = 'N') AS has_cu FROM lineitem GROUP BY 1""",
)
def _agg38(spark, sf_dir):
    n = F.col("l_linenumber")
    product = F.when(F.col("l_returnflag") != "N", "none").when(n == 1, "waterlevels").when(n == 3, "currents").when(n == 4, "historiccurrents").otherwise("other")
    p = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("station_id"), product.alias("product"))
    return stations.capabilities_from_products(p, K).select("station_id", "has_wl", "has_cu")


@query(
    "agg38_code_flags",
    """SELECT l_orderkey, bool_or(l_linenumber = 1) AS has_wl, bool_or(l_linenumber = 2) AND bool_or(l_linenumber = 3) AS has_cu FROM lineitem GROUP BY 1""",
)
def _agg38c(spark, sf_dir):
    n = F.col("l_linenumber")
    code = F.when(n == 1, "wlo").when(n == 2, "wcs1").when(n == 3, "wcd2").otherwise("xxx")
    c = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_set(code).alias("codes"))
    return stations.capabilities_from_codes(c).select("l_orderkey", "has_wl", "has_cu")


@query(
    "flt04_bounding_box",
    """SELECT station_id, lat > 31 AND lat < 33 AND lon > -78 AND lon < -75 AS strict_in, lat BETWEEN 31 AND 33 AND lon BETWEEN -78 AND -75 AS loose_in FROM v_stations""",
)
def _flt04(spark, sf_dir):
    s = view(spark, sf_dir, "v_stations")
    box = (31, 33, -78, -75)
    lat, lon = F.col("lat"), F.col("lon")
    return s.select(
        "station_id", stations.in_box(lat, lon, box).alias("strict_in"), stations.in_box(lat, lon, box, strict=False).alias("loose_in")
    )


@query(
    "flt05_capability_filter",
    "SELECT c_custkey FROM customer WHERE c_custkey % 3 = 0 OR c_custkey % 5 = 0",
)
def _flt05(spark, sf_dir):
    k = F.col("c_custkey")
    c = table(spark, sf_dir, "customer").select("c_custkey", (k % 3 == 0).alias("has_wl"), F.when(k % 5 == 0, F.lit(True)).alias("has_cu"))
    return stations.with_capability(c, ["has_wl", "has_cu"]).select("c_custkey")


@query(
    "flt06_station_list",
    """SELECT c_custkey AS id, 'kept' AS state FROM customer WHERE c_custkey IN (SELECT o_custkey + 3 FROM orders WHERE o_orderkey % 4 = 0)
       UNION ALL SELECT DISTINCT o_custkey + 3, 'absent' FROM orders WHERE o_orderkey % 4 = 0 AND o_custkey + 3 NOT IN (SELECT c_custkey FROM customer)""",
)
def _flt06(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("ID"))
    wanted = table(spark, sf_dir, "orders").filter("o_orderkey % 4 = 0").select((F.col("o_custkey") + 3).alias("ID"))
    kept, absent = stations.listed_only(c, wanted)
    return kept.select(F.col("ID").alias("id"), F.lit("kept").alias("state")).unionByName(
        absent.select(F.col("ID").alias("id"), F.lit("absent").alias("state"))
    )


@query(
    "flt09_map_positions",
    "SELECT c_custkey, CAST(c_custkey % 7 AS DOUBLE) AS lat, CAST(c_custkey % 5 AS DOUBLE) AS lon FROM customer WHERE c_custkey % 11 <> 0 AND NOT (c_custkey % 7 = 0 AND c_custkey % 5 = 0)",
)
def _flt09(spark, sf_dir):
    k = F.col("c_custkey")
    c = table(spark, sf_dir, "customer").select(
        "c_custkey", F.when(k % 11 == 0, "n/a").otherwise((k % 7).cast("string")).alias("Y"), (k % 5).cast("string").alias("X")
    )
    out = stations.map_positions(c)
    return out.select("c_custkey", F.col("Y").alias("lat"), F.col("X").alias("lon"))


@query(
    "joi13_station_id_match",
    """SELECT c_custkey AS station_id, n.node_id FROM customer JOIN (SELECT p_size * 20 AS sid, max(p_partkey) AS node_id FROM part GROUP BY 1) n ON n.sid = c_custkey""",
)
def _joi13(spark, sf_dir):
    from seamark.operators import pairing

    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("station_id"))
    p = table(spark, sf_dir, "part").select((F.col("p_size") * 20).cast("bigint").alias("station_id"), F.col("p_partkey").alias("node_id"))
    matched, _ = pairing.matched_stations(c, p, "station_id", "node_id")
    return matched


@query(
    "joi22_availability_flags",
    "SELECT c_custkey AS station_id, coalesce(f, false) AS has_wl FROM customer LEFT JOIN (SELECT o_custkey, bool_or(o_orderkey % 3 = 0) AS f FROM orders GROUP BY 1) ON o_custkey = c_custkey",
)
def _joi22(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("station_id"))
    o = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("station_id")).agg(F.bool_or(F.col("o_orderkey") % 3 == 0).alias("has_wl"))
    return stations.attach_flags(c, o, K, ["has_wl"])


@query(
    "joi23_name_duplicates",
    """WITH s AS (SELECT c_custkey AS k, CAST(c_custkey * 7 % 1000 + 100 AS VARCHAR) AS "ID", CASE WHEN c_custkey % 5 = 0 THEN CAST((c_custkey + 1) * 7 % 1000 + 100 AS VARCHAR) || ' buoy' ELSE 'st ' || c_custkey END AS "Name" FROM customer),
      i AS (SELECT a."ID", b.k, instr(b."Name", a."ID") - 1 AS pos FROM (SELECT DISTINCT "ID" FROM s) a JOIN s b ON contains(b."Name", a."ID")),
      d AS (SELECT "ID", min(k) FILTER (pos = 0) AS k FROM i GROUP BY 1 HAVING max(pos) = 0)
      SELECT k AS station FROM s WHERE k NOT IN (SELECT k FROM d)""",
)
def _joi23(spark, sf_dir):
    k = F.col("c_custkey")
    s = table(spark, sf_dir, "customer").select(
        k.alias("station"),
        (k * 7 % 1000 + 100).cast("string").alias("ID"),
        F.when(k % 5 == 0, F.concat(((k + 1) * 7 % 1000 + 100).cast("string"), F.lit(" buoy"))).otherwise(F.concat(F.lit("st "), k.cast("string"))).alias("Name"),
    )
    return stations.drop_name_duplicates(s, order="station").select("station")


@query(
    "joi24_stage_coverage",
    """SELECT c_custkey AS station_id, "cast" AS cast_kind, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) AS observed,
        EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND ((o_orderkey % 2 = 0) = ("cast" = 'nowcast'))) AS paired FROM customer, (VALUES ('nowcast'), ('forecast_b')) v("cast")""",
)
def _joi24(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("station_id"))
    o = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("station_id"), F.when(F.col("o_orderkey") % 2 == 0, "nowcast").otherwise("forecast_b").alias("cast")
    )
    out = stations.stage_coverage(c, ["nowcast", "forecast_b"], {"observed": o.drop("cast"), "paired": o}, K)
    return out.select("station_id", F.col("cast").alias("cast_kind"), "observed", "paired")


@query(
    "joi25_metadata_attach",
    "SELECT l_orderkey, l_linenumber, s_acctbal AS depth FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey",
)
def _joi25(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_acctbal").alias("depth"))
    return table(spark, sf_dir, "lineitem").join(s, "l_suppkey", "left").select("l_orderkey", "l_linenumber", "depth")


@query(
    "scl29_virtual_stations",
    """WITH b AS (SELECT l_suppkey AS s, l_linenumber AS b, avg(l_quantity) AS d FROM lineitem GROUP BY 1, 2), o AS (SELECT DISTINCT l_suppkey AS s, l_linenumber + 1 AS b FROM lineitem WHERE l_suppkey % 3 = 0)
       SELECT format('{}_b{:02d}', s, b) AS virtual_id, CASE WHEN s % 3 = 0 THEN 4.5e0 ELSE round(d, 6) END AS depth FROM b WHERE s % 3 <> 0 OR EXISTS (SELECT 1 FROM o WHERE o.s = b.s AND o.b = b.b)""",
)
def _scl29(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    bins = li.groupBy(F.col("l_suppkey").cast("string").alias("station_id"), F.col("l_linenumber").alias("bin")).agg(
        F.avg("l_quantity").alias("depth")
    )
    bins = bins.select(
        "*", F.lit("pier").alias("name"), F.lit(False).alias("depth_unknown"), F.lit(1.0).alias("height_from_bottom"), F.lit("u").alias("mounting")
    )
    over = (
        li.filter("l_suppkey % 3 = 0")
        .select(
            F.col("l_suppkey").cast("string").alias("station_id"),
            (F.col("l_linenumber") + 1).alias("bin"),
            F.lit(4.5).alias("depth"),
            F.lit(None).cast("string").alias("orientation"),
            F.lit("mid").alias("name"),
        )
        .distinct()
    )
    out, _ = stations.virtual_stations(bins, over)
    return out.select("virtual_id", r6("depth"))


@query(
    "scl30_bin_choice",
    """WITH b AS (SELECT l_suppkey AS s, l_linenumber AS b, avg(l_quantity) AS d FROM lineitem GROUP BY 1, 2)
       SELECT s AS station_id, b AS bin, CASE WHEN s % 2 = 0 THEN CASE WHEN s % 4 = 0 THEN 3e0 ELSE 7.5e0 END ELSE coalesce(CASE WHEN b <> 2 THEN round(d, 6) END, 0) END AS depth FROM b WHERE s % 2 = 1 OR b = s % 3 + 1""",
)
def _scl30(spark, sf_dir):
    s = F.col("l_suppkey")
    bins = table(spark, sf_dir, "lineitem").groupBy(s.alias("station_id"), F.col("l_linenumber").alias("bin")).agg(F.avg("l_quantity").alias("d"))
    k = F.col("station_id")
    full = bins.select(
        "station_id",
        "bin",
        F.when(k % 2 == 0, "side").otherwise("up").alias("mounting"),
        F.when(F.col("bin") != 2, F.col("d")).alias("bin_depth"),
        F.when(k % 4 == 0, 3.0).otherwise(-1.0).alias("sensor_depth"),
        F.lit(9.0).alias("measured_depth"),
        F.lit(1.5).alias("height_from_bottom"),
        F.lit(None).cast("int").alias("real_time_bin"),
        (k % 3 + 1).cast("int").alias("active_real_time_bin"),
        F.lit(1).alias("any_real_time_bin"),
    )
    return stations.choose_bins(full).select("station_id", "bin", r6("depth"))


@query(
    "agg49_mounting_counts",
    "SELECT CASE l_linenumber % 3 WHEN 0 THEN 'side' WHEN 1 THEN 'up' ELSE 'unknown' END AS mounting, count(*) AS n FROM lineitem GROUP BY 1",
)
def _agg49(spark, sf_dir):
    k = F.col("l_linenumber") % 3
    li = table(spark, sf_dir, "lineitem").select(F.when(k == 0, "h").when(k == 1, "UP").otherwise("?").alias("mounting"))
    return stations.mounting_counts(li)
