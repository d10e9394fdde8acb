"""Meshes, datums, deployments, boundary sections, set operations: queries with SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from seamark.functions import clock
from seamark.operators import (
    boundary,
    datums,
    deployments,
    mesh,
    pairing,
    runs,
    scores,
    sequence,
    stations,
)
from seamark.plans.demo import LINE_HEAD, line_field, r6, secs, table, view
from seamark.plans.registry import query

K = ["station_id"]

# Model values per node, layer, hour and variable from the line items.
_MV = """mv AS (SELECT l_partkey AS node_id, l_linenumber % 3 AS layer, CAST(epoch(l_shipdate) AS BIGINT) AS t,
   CASE WHEN l_orderkey % 2 = 0 THEN 'temp' ELSE 'salt' END AS var,
   max(CASE WHEN l_orderkey % 37 = 0 THEN -999e0 WHEN l_orderkey % 41 = 0 THEN -300e0 ELSE l_quantity END) AS value FROM lineitem GROUP BY 1, 2, 3, 4)"""


def _values(spark, sf_dir):
    k = F.col("l_orderkey")
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(
            F.col("l_partkey").alias("node_id"),
            (F.col("l_linenumber") % 3).alias("layer"),
            F.col("l_shipdate").cast("timestamp").alias("ts"),
            F.when(k % 2 == 0, "temp").otherwise("salt").alias("var"),
        )
        .agg(F.max(F.when(k % 37 == 0, -999.0).when(k % 41 == 0, -300.0).otherwise(F.col("l_quantity"))).alias("value"))
    )


@query(
    "flt03_physical_bounds",
    f"WITH {_MV} SELECT node_id, layer, t, var, CASE WHEN (var = 'temp' AND value BETWEEN -5 AND 50) OR (var = 'salt' AND value BETWEEN -1 AND 50) THEN value END AS value FROM mv",
)
def _flt03(spark, sf_dir):
    out = mesh.mask_unphysical(_values(spark, sf_dir))
    return out.select("node_id", "layer", secs("ts", "t"), "var", "value")


@query(
    "flt03_mask_report",
    f"WITH {_MV} SELECT layer, var, count(*) FILTER (abs(value) >= 999) AS n_fill, count(*) FILTER (abs(value) < 999 AND (value > 50 OR value < CASE WHEN var = 'temp' THEN -5 ELSE -1 END)) AS n_blended FROM mv GROUP BY 1, 2",
)
def _flt03r(spark, sf_dir):
    return mesh.mask_report(_values(spark, sf_dir), ["layer"])


@query(
    "flt11_minimum_samples",
    "SELECT station_id, CASE WHEN count(model - obs) >= 12 THEN round(avg(model - obs), 6) END AS bias FROM v_series_pairs GROUP BY 1".replace(
        "v_series_pairs", "(SELECT seq % 997 AS station_id, model, obs FROM v_pairs)"
    ),
)
def _flt11(spark, sf_dir):
    e = F.col("model") - F.col("obs")
    p = view(spark, sf_dir, "v_pairs").groupBy((F.col("seq") % 997).alias("station_id"))
    return p.agg(F.when(F.count(e) >= 12, F.round(F.avg(e), 6)).alias("bias"))


@query(
    "flt14_file_date_overlap",
    """WITH s AS (SELECT o_custkey AS file, min(epoch(o_orderdate)) lo, max(epoch(o_orderdate)) hi FROM orders GROUP BY 1)
       SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT file FROM s WHERE lo <= 820454400 AND hi >= 804556800)""",
)
def _flt14(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("file"), F.col("o_orderdate").cast("timestamp").alias("ts"))
    out = mesh.files_in_window(o, "file", "ts", F.timestamp_seconds(F.lit(804556800)), F.timestamp_seconds(F.lit(820454400)))
    return out.select("o_orderkey")


@query(
    "grd07_station_extraction",
    f"""WITH {_MV}, st AS (SELECT c_custkey AS station_id, c_custkey * 3 % (SELECT count(*) FROM part) AS node_id, c_custkey % 3 AS layer FROM customer)
       SELECT station_id, t, max(value) FILTER (var = 'temp') AS temp, max(value) FILTER (var = 'salt') AS salt FROM st JOIN mv USING (node_id, layer) GROUP BY 1, 2""",
)
def _grd07(spark, sf_dir):
    c = F.col("c_custkey")
    nodes = table(spark, sf_dir, "part").agg(F.count(F.lit(1))).scalar()
    st = table(spark, sf_dir, "customer").select(c.alias("station_id"), (c * 3 % nodes).alias("node_id"), (c % 3).cast("int").alias("layer"))
    out = mesh.extract_series(_values(spark, sf_dir), st, variables=["temp", "salt"])
    return out.select("station_id", secs("ts", "t"), "temp", "salt")


@query(
    "agg48_completeness",
    f"WITH {_MV} SELECT node_id * 3 + layer AS station_id, count(*) AS n_rows, (SELECT count(DISTINCT t) FROM mv) AS n_expected FROM mv GROUP BY 1",
)
def _agg48(spark, sf_dir):
    v = _values(spark, sf_dir).withColumn("station_id", F.col("node_id") * 3 + F.col("layer"))
    return mesh.completeness(v).select("station_id", "n_rows", "n_expected")


@query(
    "scl17_sigma_layers",
    "SELECT node_id, CAST(i AS INTEGER) AS layer, round(-h * (i + 5e-1) / 10, 6) AS z FROM v_nodes, range(10) r(i)",
)
def _scl17(spark, sf_dir):
    return mesh.sigma_layers(view(spark, sf_dir, "v_nodes"), 11).select("node_id", "layer", r6("z"))


def _elements(spark, sf_dir):
    k = F.col("p_partkey")
    p = table(spark, sf_dir, "part")
    n = p.agg(F.count(F.lit(1))).scalar()
    return p.select(k.alias("element_id"), k.alias("n1"), ((k + 1) % n).alias("n2"), ((k * 7 + 3) % n).alias("n3"))


_EL = "el AS (SELECT p_partkey AS e, p_partkey AS n1, (p_partkey + 1) % (SELECT count(*) FROM part) AS n2, (p_partkey * 7 + 3) % (SELECT count(*) FROM part) AS n3 FROM part)"


@query(
    "scl17_element_depths",
    f"WITH {_EL} SELECT e AS element_id, round(avg(h), 6) AS h FROM (SELECT e, unnest([n1, n2, n3]) AS node_id FROM el) JOIN v_nodes USING (node_id) GROUP BY 1",
)
def _scl17e(spark, sf_dir):
    out = mesh.element_depths(_elements(spark, sf_dir), view(spark, sf_dir, "v_nodes"))
    return out.select("element_id", r6("h"))


@query(
    "agg47_boundary_edges",
    f"""WITH {_EL}, ed AS (SELECT least(n1, n2) a, greatest(n1, n2) b FROM el UNION ALL SELECT least(n2, n3), greatest(n2, n3) FROM el UNION ALL SELECT least(n3, n1), greatest(n3, n1) FROM el)
        SELECT a, b FROM ed GROUP BY 1, 2 HAVING count(*) = 1""",
)
def _agg47(spark, sf_dir):
    return mesh.boundary_edges(_elements(spark, sf_dir))


@query(
    "scl18_side_looking_depth",
    """SELECT c_custkey AS station_id, CASE WHEN c_custkey % 3 = 0 AND c_custkey % 4 = 0 THEN greatest(h - 12, 0) ELSE CAST(c_custkey % 4 AS DOUBLE) END AS depth
       FROM customer LEFT JOIN v_nodes ON node_id = c_custkey""",
)
def _scl18(spark, sf_dir):
    c = F.col("c_custkey")
    st = table(spark, sf_dir, "customer").select(
        c.alias("station_id"),
        c.alias("node_id"),
        F.when(c % 3 == 0, "side").otherwise("up").alias("mounting"),
        (c % 4).cast("double").alias("depth"),
        F.lit(12.0).alias("height_from_bottom"),
    )
    return mesh.side_looking_depth(st, view(spark, sf_dir, "v_nodes")).select("station_id", "depth")


@query(
    "scl04_rotate_grid_currents",
    """WITH g AS (SELECT iy AS eta, ix AS xi, t, obs AS u, model AS v, (iy + ix) / 1e1 AS a FROM v_grid),
       c AS (SELECT g.t, g.eta, g.xi, g.a, coalesce((g.u + e.u) / 2, g.u, e.u, 0) AS u, coalesce((g.v + n.v) / 2, g.v, n.v, 0) AS v
         FROM g LEFT JOIN g e ON e.t = g.t AND e.eta = g.eta AND e.xi = g.xi + 1 LEFT JOIN g n ON n.t = g.t AND n.eta = g.eta + 1 AND n.xi = g.xi)
       SELECT t, eta, xi, round(u * cos(a) - v * sin(a), 6) AS u_east, round(u * sin(a) + v * cos(a), 6) AS v_north FROM c""",
)
def _scl04(spark, sf_dir):
    g = view(spark, sf_dir, "v_grid").select(
        "ts",
        F.col("iy").alias("eta"),
        F.col("ix").alias("xi"),
        F.col("obs").alias("u"),
        F.col("model").alias("v"),
        ((F.col("iy") + F.col("ix")) / 10.0).alias("angle"),
    )
    out = mesh.centre_and_rotate(g)
    return out.select(secs("ts", "t"), "eta", "xi", r6("u_east"), r6("v_north"))


@query(
    "scl14_datum_shift",
    f"""WITH {_MV} SELECT mv.node_id, layer, t, var, CASE WHEN mv.node_id % 5 = 0 THEN value ELSE value + CASE WHEN layer = 1 THEN 1 ELSE -1 END * (mv.node_id % 50) / 1e1 END AS value FROM mv""",
)
def _scl14(spark, sf_dir):
    v = _values(spark, sf_dir)
    n = F.col("node_id")
    off = view(spark, sf_dir, "v_nodes").select("node_id", F.when(n % 5 == 0, -9991.0).otherwise(n % 50 / 10.0).alias("offset"))
    rules = spark.createDataFrame([(1, 1)], "system int, sign int")
    out = datums.shift_levels(v.withColumn("system", F.col("layer")), off, rules)
    return out.select("node_id", "layer", secs("ts", "t"), "var", "value")


@query(
    "scl15_offset_composition",
    """SELECT node_id, system, target, CASE WHEN system = 0 THEN CASE WHEN node_id % 13 = 0 OR node_id % 11 = 0 THEN -9991e0 ELSE round(-h / 10 + lat / 100, 6) END
        ELSE CASE WHEN node_id % 13 = 0 THEN -9991e0 ELSE round(23e-2 - h / 10, 6) END END AS "offset" FROM (SELECT *, node_id % 2 AS system, 'mllw' AS target FROM v_nodes)""",
)
def _scl15(spark, sf_dir):
    n = F.col("node_id")
    v = view(spark, sf_dir, "v_nodes").withColumn("system", n % 2)
    fields = v.select(
        "system",
        "node_id",
        F.explode(
            F.array(
                F.struct(F.lit("geoid").alias("field"), F.when(n % 13 == 0, -999999.0).otherwise(F.col("h") / 10).alias("value")),
                F.struct(F.lit("tidal").alias("field"), F.when(n % 11 == 0, F.lit(None)).otherwise(F.col("lat") / 100).alias("value")),
            )
        ).alias("f"),
    ).select("system", "node_id", "f.*")
    terms = spark.createDataFrame(
        [(0, "mllw", None, "geoid", -1.0), (0, "mllw", None, "tidal", 1.0), (1, "mllw", 0.23, "geoid", -1.0)],
        "system bigint, target string, constant double, field string, coef double",
    )
    out = datums.compose_offsets(fields, terms)
    return out.select("node_id", "system", "target", r6("offset"))


@query(
    "scl16_datum_fallback",
    """WITH e AS (SELECT user_id AS station_id, event_id, CASE event_id % 3 WHEN 0 THEN 'MLLW' WHEN 1 THEN 'MSL' ELSE 'STND' END AS datum, CASE WHEN user_id % 2 = 0 AND event_id % 3 = 0 THEN NULL ELSE value END AS value FROM events),
       r AS (SELECT *, CASE datum WHEN 'MLLW' THEN 1 WHEN 'MSL' THEN 2 END AS k FROM e), b AS (SELECT station_id, min(k) AS k FROM r WHERE value IS NOT NULL AND k IS NOT NULL GROUP BY 1)
       SELECT r.station_id, r.event_id, r.datum FROM r JOIN b ON b.station_id = r.station_id AND b.k = r.k""",
)
def _scl16(spark, sf_dir):
    k = F.col("event_id") % 3
    e = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("station_id"),
        "event_id",
        F.when(k == 0, "MLLW").when(k == 1, "MSL").otherwise("STND").alias("datum"),
        F.when(~((F.col("user_id") % 2 == 0) & (k == 0)), F.col("value")).alias("value"),
    )
    return datums.first_datum_with_data(e, K, ["MLLW", "MSL"]).select("station_id", "event_id", "datum")


@query(
    "scl31_observation_shift",
    """SELECT station_id, CASE station_id % 5 WHEN 0 THEN 0e0 WHEN 1 THEN -176e0 WHEN 2 THEN round_even(depth / 7, 2) END AS datum_shift,
        CASE station_id % 5 WHEN 3 THEN 'RANGE' WHEN 4 THEN 'UNKNOWN' ELSE 'ok' END AS shift_status FROM v_stations""",
)
def _scl31(spark, sf_dir):
    k = F.col("station_id") % 5
    s = view(spark, sf_dir, "v_stations").select(
        "station_id", "depth", F.when(k == 0, "LWD_IGLD85").when(k == 1, "IGLD85").when(k == 4, "STND").otherwise("NAVD88").alias("datum")
    )
    off = s.filter(k.isin(2, 3)).select(
        "station_id", "datum", F.when(F.col("station_id") % 5 == 3, float("inf")).otherwise(F.col("depth") / 7).alias("offset")
    )
    out = datums.observation_shift(s, off, target="LWD", lake=F.lit("michigan_huron"))
    return out.select("station_id", "datum_shift", "shift_status")


@query(
    "scl31_tide_rereference",
    "SELECT station_id, t, round(tide + round_even(station_id / 7e0, 2), 9) AS tide FROM v_tide WHERE station_id % 4 <> 0",
)
def _scl31t(spark, sf_dir):
    t = view(spark, sf_dir, "v_tide").select("station_id", "ts", "tide")
    k = F.col("station_id")
    off = t.select("station_id").distinct().withColumn("offset", F.when(k % 4 == 0, float("inf")).otherwise(k / 7.0))
    return datums.rereference_tides(t, off, K).select("station_id", secs("ts", "t"), F.round("tide", 9).alias("tide"))


# Deployments per supplier: each line item opens one of 1-60 days; some are open.
_DEP = """dp AS (SELECT l_suppkey AS station_id, l_orderkey * 10 + l_linenumber AS dep, CAST(epoch(l_shipdate) AS BIGINT) AS s,
   CASE WHEN l_orderkey % 500 = 0 AND l_shipdate > TIMESTAMP '2001-06-01' THEN NULL ELSE CAST(epoch(l_shipdate) AS BIGINT) + (l_quantity + 1)::BIGINT * 86400 END AS e FROM lineitem)"""


def _deployments(spark, sf_dir):
    start = F.col("l_shipdate").cast("timestamp")
    still = (F.col("l_orderkey") % 500 == 0) & (F.col("l_shipdate") > F.lit("2001-06-01").cast("timestamp_ntz"))
    stop = F.timestamp_seconds(F.unix_seconds(start) + (F.col("l_quantity") + 1).cast("bigint") * 86400)
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("station_id"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("dep"),
        start.alias("deployed"),
        F.when(~still, stop).alias("retrieved"),
    )


_W0, _W1 = 883612800, 915148800


@query(
    "joi19_active_deployments",
    f"""WITH {_DEP}, x AS (SELECT *, coalesce(e, 253370764800) AS ee FROM dp) SELECT station_id, dep, greatest(s, {_W0}) AS period_start, least(ee, {_W1}) AS period_end,
        s BETWEEN {_W0} AND {_W1} OR ee BETWEEN {_W0} AND {_W1} AS boundary FROM x WHERE s <= {_W1} AND ee >= {_W0}""",
)
def _joi19(spark, sf_dir):
    out = deployments.active_periods(
        _deployments(spark, sf_dir), F.timestamp_seconds(F.lit(_W0)), F.timestamp_seconds(F.lit(_W1))
    )
    return out.select("station_id", "dep", secs("period_start"), secs("period_end"), "boundary")


_MERGED = f"""{_DEP}, m0 AS (SELECT station_id, s, coalesce(e, 253370764800) AS e FROM dp),
  m1 AS (SELECT *, max(e) OVER (PARTITION BY station_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) pe FROM m0),
  m2 AS (SELECT *, sum(CASE WHEN pe IS NULL OR pe < s THEN 1 ELSE 0 END) OVER (PARTITION BY station_id ORDER BY s, e) b FROM m1),
  mi AS (SELECT station_id, min(s) s, max(e) e FROM m2 GROUP BY station_id, b)"""


@query(
    "win15_merge_intervals",
    f"WITH {_MERGED} SELECT station_id, s AS deployed, CASE WHEN e < 253370764800 THEN e END AS retrieved FROM mi",
)
def _win15(spark, sf_dir):
    out = runs.merge_intervals(_deployments(spark, sf_dir), K, "deployed", "retrieved")
    return out.select("station_id", secs("deployed"), secs("retrieved"))


@query(
    "win15_interval_gaps",
    f"""WITH {_MERGED}, g AS (SELECT station_id, e, lead(s) OVER (PARTITION BY station_id ORDER BY s) n FROM mi)
        SELECT station_id, greatest(e, {_W0}) AS gap_start, least(n, {_W1}) AS gap_end FROM g WHERE n IS NOT NULL AND greatest(e, {_W0}) < least(n, {_W1})""",
)
def _win15g(spark, sf_dir):
    merged = runs.merge_intervals(_deployments(spark, sf_dir), K, "deployed", "retrieved")
    out = runs.interval_gaps(
        merged, K, "deployed", "retrieved", F.timestamp_seconds(F.lit(_W0)), F.timestamp_seconds(F.lit(_W1))
    )
    return out.select("station_id", secs("gap_start"), secs("gap_end"))


# Yearly periods per supplier and the line items seen in them.
_PER = """pr AS (SELECT station_id, y, CAST(epoch(make_timestamp(y, 1, 10, 0, 0, 0)) AS BIGINT) s, CAST(epoch(make_timestamp(y, 12, 1 + CAST(station_id % 20 AS INTEGER), 0, 0, 0)) AS BIGINT) e
   FROM (SELECT DISTINCT l_suppkey AS station_id, CAST(year(l_shipdate) AS INTEGER) AS y FROM lineitem))"""


def _periods(spark, sf_dir):
    y = F.year("l_shipdate")
    base = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("station_id"), y.alias("y")).distinct()
    z = F.lit(0)
    return base.select(
        "station_id",
        F.make_timestamp(F.col("y"), F.lit(1), F.lit(10), z, z, z).alias("period_start"),
        F.make_timestamp(F.col("y"), F.lit(12), (F.col("station_id") % 20 + 1).cast("int"), z, z, z).alias("period_end"),
    )


@query(
    "win16_boundary_gaps",
    f"""WITH {_PER}, o AS (SELECT pr.station_id, s, min(t) f, max(t) l FROM pr JOIN v_model v ON v.station_id = pr.station_id AND v.t BETWEEN s AND e GROUP BY 1, 2),
        g AS (SELECT station_id, l, lead(f) OVER (PARTITION BY station_id ORDER BY s) n FROM o) SELECT station_id, l AS gap_start, n AS gap_end, round((n - l) / 3600, 6) AS hours FROM g WHERE n IS NOT NULL""",
)
def _win16(spark, sf_dir):
    out = deployments.boundary_gaps(view(spark, sf_dir, "v_model"), _periods(spark, sf_dir), K)
    return out.select("station_id", secs("gap_start"), secs("gap_end"), r6("hours"))


@query(
    "win18_short_coverage",
    f"""WITH {_PER}, m AS (SELECT station_id, max(t) l FROM v_model GROUP BY 1) SELECT station_id, e AS period_end, (e - l) / 3600 > 1 AS short FROM pr JOIN m USING (station_id)""",
)
def _win18(spark, sf_dir):
    out = deployments.short_coverage(view(spark, sf_dir, "v_model"), _periods(spark, sf_dir), K)
    return out.select("station_id", secs("period_end"), "short")


_BIN = """bn AS (SELECT l_suppkey AS station_id, l_returnflag AS deployment, l_linenumber AS bin, CASE WHEN l_suppkey % 3 = 0 AND l_returnflag = 'R' THEN l_linenumber + 5e-1 ELSE l_linenumber * 1e0 END AS distance FROM lineitem WHERE NOT (l_suppkey % 7 = 0 AND l_returnflag <> 'R') GROUP BY ALL)"""


def _bins(spark, sf_dir):
    s, b, f = F.col("l_suppkey"), F.col("l_linenumber"), F.col("l_returnflag")
    return (
        table(spark, sf_dir, "lineitem")
        .filter("NOT (l_suppkey % 7 = 0 AND l_returnflag <> 'R')")
        .select(
            s.alias("station_id"),
            f.alias("deployment"),
            b.alias("bin"),
            F.when((s % 3 == 0) & (f == "R"), b + 0.5).otherwise(b * 1.0).alias("distance"),
        )
        .distinct()
    )


@query(
    "agg41_bin_shift",
    f"""WITH {_BIN}, d AS (SELECT station_id, deployment, list(struct_pack(b := bin, d := distance) ORDER BY bin) p FROM bn GROUP BY 1, 2)
        SELECT station_id, count(*) AS n_deployments, count(DISTINCT p) > 1 AS shifted FROM d GROUP BY 1""",
)
def _agg41(spark, sf_dir):
    return deployments.shifted_bins(_bins(spark, sf_dir), K)


@query(
    "joi20_latest_deployment_only",
    f"""WITH {_PER}, l AS (SELECT station_id, max(s) s, arg_max(e, s) e FROM pr GROUP BY 1)
        SELECT v.station_id, v.seq FROM v_model v JOIN l USING (station_id) WHERE v.station_id % 3 <> 0 OR v.t BETWEEN l.s AND l.e""",
)
def _joi20(spark, sf_dir):
    m = view(spark, sf_dir, "v_model")
    moved = m.select("station_id", (F.col("station_id") % 3 == 0).alias("shifted")).distinct()
    out = deployments.latest_period_only(m, _periods(spark, sf_dir), moved, K)
    return out.select("station_id", "seq")


# Boundaries: blocks of 200 customers in key order.
_BN = """bd AS (SELECT CAST(floor(station_id / 200) AS BIGINT) AS b, station_id AS i, lat, lon FROM v_stations)"""


@query(
    "win14_along_distance",
    f"""WITH {_BN}, g AS (SELECT *, lag(lat) OVER w pla, lag(lon) OVER w plo FROM bd WINDOW w AS (PARTITION BY b ORDER BY i)),
       d AS (SELECT b, i, coalesce(12742 * asin(sqrt(0.5 - cos(radians(lat - pla)) / 2 + cos(radians(lat)) * cos(radians(pla)) * (1 - cos(radians(lon - plo))) / 2)), 0) AS k FROM g)
       SELECT b, i, round(k, 6) AS spacing_km, round(sum(k) OVER (PARTITION BY b ORDER BY i), 6) AS along_km FROM d""",
)
def _win14(spark, sf_dir):
    n = view(spark, sf_dir, "v_stations").select(
        F.floor(F.col("station_id") / 200).alias("b"), F.col("station_id").alias("i"), "lat", "lon"
    )
    out = boundary.along_distance(n, ["b"], chunk=64)
    return out.select("b", "i", r6("spacing_km"), r6("along_km"))


_COL = """cl AS (SELECT o_orderkey AS node, k, -(k + 5e-1) / 6 AS sg, 10 + o_custkey % 40 AS h, (o_orderkey % 9 - 4) / 1e1 AS ze, sqrt(o_totalprice) / 1e1 + k * k AS v FROM orders, range(6) r(k)),
  dz AS (SELECT *, -(sg * (h + ze) + ze) AS z FROM cl), pz AS (SELECT *, lead(z) OVER w z2, lead(v) OVER w v2 FROM dz WINDOW w AS (PARTITION BY node ORDER BY z)),
  rf AS (SELECT i, i * 25e-1 AS d FROM range(0, 25) r(i))"""


def _columns(spark, sf_dir):
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        k.alias("node"),
        (10 + F.col("o_custkey") % 40).alias("h"),
        ((k % 9 - 4) / 10.0).alias("zeta"),
        F.explode(F.sequence(F.lit(0), F.lit(5))).alias("layer"),
        "o_totalprice",
    ).select(
        "node",
        "h",
        "zeta",
        (-(F.col("layer") + 0.5) / 6).alias("sigma"),
        (F.sqrt("o_totalprice") / 10 + F.col("layer") * F.col("layer")).alias("value"),
    )


@query(
    "grd04_sigma_to_depth",
    f"""WITH {_COL} SELECT node, d AS depth, round(min(v + (v2 - v) * (d - z) / (z2 - z)), 6) AS value FROM pz JOIN rf ON d >= z AND d <= z2
        WHERE z2 IS NOT NULL AND d >= -ze AND d <= h GROUP BY 1, 2""",
)
def _grd04(spark, sf_dir):
    out = boundary.to_fixed_depths(_columns(spark, sf_dir), ["node"], depth_step=2.5)
    return out.select("node", "depth", r6("value"))


@query(
    "grd05_along_boundary",
    """WITH ln AS (SELECT CAST(floor(station_id / 50) AS BIGINT) AS b, (station_id % 50) * 7e-1 + (station_id % 3) / 1e1 AS x, CASE WHEN station_id % 17 = 0 THEN NULL ELSE sqrt(station_id + 1e0) END AS v FROM v_stations WHERE station_id % 11 <> 5 AND station_id % 11 <> 6),
      p AS (SELECT *, lead(x) OVER w x2, lead(v) OVER w v2 FROM ln WINDOW w AS (PARTITION BY b ORDER BY x)), r AS (SELECT i AS k, i * 25e-2 AS xk FROM range(0, 200) q(i))
      SELECT b, k, round(max(v + (v2 - v) * (xk - x) / (x2 - x)), 6) AS value FROM p JOIN r ON xk >= x AND (xk < x2 OR (xk = x2 AND x2 = (SELECT max(x) FROM ln q WHERE q.b = p.b))) WHERE x2 - x <= 15e-1 GROUP BY 1, 2""",
)
def _grd05(spark, sf_dir):
    k = F.col("station_id")
    line = (
        view(spark, sf_dir, "v_stations")
        .filter("station_id % 11 <> 5 AND station_id % 11 <> 6")
        .select(
            F.floor(k / 50).alias("b"),
            (k % 50 * 0.7 + k % 3 / 10.0).alias("along_km"),
            F.when(k % 17 != 0, F.sqrt(k + 1.0)).alias("value"),
        )
    )
    out = boundary.to_regular_distance(line, ["b"], step_km=0.25, max_gap_km=F.lit(1.5))
    return out.select("b", "k", r6("value"))


_TRANSECT = """WITH nd AS (SELECT CAST(floor(station_id / 200) AS BIGINT) AS b, station_id AS i, lat, lon, CAST(10 + station_id % 40 AS DOUBLE) AS h FROM v_stations),
  g AS (SELECT *, lag(lat) OVER w pla, lag(lon) OVER w plo FROM nd WINDOW w AS (PARTITION BY b ORDER BY i)),
  sp AS (SELECT *, coalesce(12742 * asin(sqrt(0.5 - cos(radians(lat - pla)) / 2 + cos(radians(lat)) * cos(radians(pla)) * (1 - cos(radians(lon - plo))) / 2)), 0) AS k FROM g),
  al AS (SELECT *, sum(k) OVER (PARTITION BY b ORDER BY i) AS x FROM sp),
  th AS (SELECT b, quantile_cont(k, 5e-1) + 3 * (quantile_cont(k, 75e-2) - quantile_cont(k, 25e-2)) AS lim FROM sp WHERE k > 0 GROUP BY 1),
  vl AS (SELECT o_custkey AS i, CAST(epoch(date_trunc('year', o_orderdate)) AS BIGINT) AS t, l, avg(o_totalprice / 1e4 + l) AS v FROM orders, range(6) r(l) GROUP BY 1, 2, 3),
  zl AS (SELECT vl.*, nd.b, nd.h, (l + 5e-1) / 6 * h AS z FROM vl JOIN nd USING (i)),
  zp AS (SELECT *, lead(z) OVER w z2, lead(v) OVER w v2 FROM zl WINDOW w AS (PARTITION BY i, t ORDER BY z)),
  fx AS (SELECT b, i, t, dk, min(v + (v2 - v) * (dk * 5e0 - z) / (z2 - z)) AS v FROM zp JOIN range(0, 12) q(dk) ON dk * 5e0 >= z AND dk * 5e0 <= z2 WHERE z2 IS NOT NULL AND dk * 5e0 <= h GROUP BY 1, 2, 3, 4),
  xp AS (SELECT fx.b, fx.t, dk, al.x, fx.v, lead(al.x) OVER w x2, lead(fx.v) OVER w v2 FROM fx JOIN al ON al.i = fx.i WINDOW w AS (PARTITION BY fx.b, fx.t, dk ORDER BY al.x))
  SELECT xp.b, t, dk AS depth_no, k, round(v + (v2 - v) * (k * 25e0 - x) / (x2 - x), 6) AS value FROM xp JOIN th ON th.b = xp.b JOIN range(0, 4000) r(k) ON k * 25e0 >= x AND k * 25e0 < x2
  WHERE x2 - x <= lim"""


@query("grd12_boundary_transect", _TRANSECT)
def _grd12(spark, sf_dir):
    """Temperature section along each block of stations over six sigma layers."""
    k = F.col("station_id")
    nodes = view(spark, sf_dir, "v_stations").select(F.floor(k / 200).alias("b"), k.alias("i"), "lat", "lon", (10 + k % 40).cast("double").alias("h"))
    orders = table(spark, sf_dir, "orders")
    values = orders.select(
        F.floor(F.col("o_custkey") / 200).alias("b"),
        F.col("o_custkey").alias("i"),
        F.date_trunc("year", "o_orderdate").alias("ts"),
        F.explode(F.sequence(F.lit(0), F.lit(5))).alias("layer"),
        "o_totalprice",
    ).groupBy("b", "i", "ts", "layer").agg(F.avg(F.col("o_totalprice") / 10000.0 + F.col("layer")).alias("value"))
    values = values.withColumn("sigma", -(F.col("layer") + 0.5) / 6).withColumn("zeta", F.lit(0.0))
    out = boundary.transect(values, nodes, ["b"], depth_step=5.0, step_km=25.0)
    return out.select("b", secs("ts", "t"), "depth_no", "k", r6("value"))


@query(
    "srt01_monotonic_check",
    """WITH g AS (SELECT station_id, t - lag(t) OVER (PARTITION BY station_id ORDER BY seq, t) d FROM v_model) SELECT station_id, count(*) FILTER (d <= 0) AS n_backward FROM g GROUP BY 1""",
)
def _srt01(spark, sf_dir):
    # File order is the sequence here, so chunks follow the sequence number.
    m = sequence.scan(
        view(spark, sf_dir, "v_model"), K, ["seq", "ts"], prior={"before": F.col("ts")}, chunk=F.floor(F.col("seq") / 50000)
    )
    return m.groupBy(*K).agg(F.count_if(F.col("ts") <= F.col("before")).alias("n_backward"))


@query(
    "srt02_stations_by_longitude",
    "SELECT station_id, lon, row_number() OVER (ORDER BY lon, station_id) AS place FROM v_stations",
)
def _srt02(spark, sf_dir):
    return sequence.placed(view(spark, sf_dir, "v_stations").select("station_id", "lon"), ["lon", "station_id"])


@query(
    "srt03_file_sort",
    "SELECT o_orderkey, CAST(epoch(o_orderdate) AS BIGINT) AS t FROM orders",
)
def _srt03(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", secs("o_orderdate", "t"))
    return o.orderBy("t", "o_orderkey")


@query(
    "set01_merge_inventories",
    """SELECT 0 AS priority, s_suppkey AS id, true AS has_wl FROM supplier UNION ALL SELECT 1, c_custkey, NULL FROM customer""",
)
def _set01(spark, sf_dir):
    a = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.lit(True).alias("has_wl"))
    b = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    return stations.merge_inventories(a, b).select("priority", "id", "has_wl")


@query(
    "set02_combine_casts",
    """WITH u AS (SELECT station_id, t, obs, 0 AS p, seq FROM v_obs UNION ALL SELECT station_id, t, obs + 1, 1, seq FROM v_obs WHERE seq % 2 = 0)
       SELECT station_id, t, arg_min(obs, (p, seq)) AS obs FROM (SELECT * FROM u WHERE obs IS NOT NULL) WHERE t BETWEEN 852076800 AND 883612800 GROUP BY 1, 2""",
)
def _set02(spark, sf_dir):
    o = view(spark, sf_dir, "v_obs").filter("obs IS NOT NULL")
    both = o.withColumn("p", F.lit(0)).unionByName(
        o.filter("seq % 2 = 0").withColumn("obs", F.col("obs") + 1).withColumn("p", F.lit(1))
    )
    cut = both.filter(
        pairing.in_window(F.col("ts"), F.timestamp_seconds(F.lit(852076800)), F.timestamp_seconds(F.lit(883612800)))
    )
    out = sequence.keep_first(cut, ["station_id", "ts"], ["p", "seq"])
    return out.select("station_id", secs("ts", "t"), "obs")


@query(
    "set04_common_times",
    "SELECT t FROM v_grid WHERE obs IS NOT NULL INTERSECT SELECT t FROM v_grid WHERE model IS NOT NULL",
)
def _set04(spark, sf_dir):
    g = view(spark, sf_dir, "v_grid")
    out = g.filter("obs IS NOT NULL").select("ts").intersect(g.filter("model IS NOT NULL").select("ts"))
    return out.select(secs("ts", "t"))


@query(
    "agg39_speed_direction_table",
    """WITH c AS (SELECT CASE WHEN obs_speed > 0 THEN CAST(ceil(obs_speed / 25e-2) AS BIGINT) END AS b, CASE WHEN obs_dir > 0 AND obs_dir <= 360 THEN CAST(ceil((obs_dir - 1125e-2) / 225e-1) AS BIGINT) % 16 + 1 END AS s FROM v_currents)
       SELECT b AS speed_bin, s AS sector, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS percent FROM c WHERE b IS NOT NULL AND s IS NOT NULL GROUP BY 1, 2""",
)
def _agg39(spark, sf_dir):
    from seamark.operators import roses

    out = roses.speed_direction_table(view(spark, sf_dir, "v_currents"), "obs_speed", "obs_dir")
    return out.select("speed_bin", F.col("sector").cast("bigint").alias("sector"), "n", r6("percent"))


@query(
    "srt04_cycle_order",
    """SELECT DISTINCT strftime(to_timestamp(cycle_t)::TIMESTAMP, '%m/%d/%y %Hz') AS cycle FROM v_forecast""",
)
def _srt04(spark, sf_dir):
    from seamark.operators import horizon

    f = view(spark, sf_dir, "v_forecast").select(F.date_format("cycle", "MM/dd/yy HH'z'").alias("cycle"))
    return horizon.ordered_cycles(f, "cycle", "MM/dd/yy HH'z'")


@query(
    "srt05_k_nearest_nodes",
    """WITH c AS (SELECT s.station_id, n.node_id, (n.lat - s.lat)*(n.lat - s.lat) + (n.lon - s.lon)*(n.lon - s.lon) AS d FROM v_stations s JOIN v_nodes n ON abs(n.lat - s.lat) < 15e-2 AND abs(n.lon - s.lon) < 15e-2),
       r AS (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY d, node_id) AS rank FROM c)
       SELECT station_id, node_id, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 3""",
)
def _srt05(spark, sf_dir):
    from seamark.operators import spatial

    out = spatial.nearest(
        view(spark, sf_dir, "v_stations"), view(spark, sf_dir, "v_nodes"), node_id="node_id", k=3, box_deg=0.15, planar=True
    )
    return out.filter("node_id IS NOT NULL").select("station_id", "node_id", "rank")


@query(
    "snk02_paired_rows",
    f"""WITH m AS (SELECT station_id, t, make_timestamp(t * 1000000) AS d, any_value(model) AS model FROM v_model GROUP BY 1, 2, 3 HAVING count(*) = 1),
       o AS (SELECT station_id, t, obs FROM v_obs WHERE obs IS NOT NULL)
       SELECT station_id, t, {LINE_HEAD} || ' ' || {line_field('obs')} || ' ' || {line_field('model')} || ' ' || {line_field('model - obs')} AS line
       FROM m JOIN o USING (station_id, t)""",
)
def _snk02(spark, sf_dir):
    from seamark.sinks import text as sink_text

    p = pairing.pair_scalar(view(spark, sf_dir, "v_obs"), view(spark, sf_dir, "v_model"), K).filter("obs IS NOT NULL")
    out = sink_text.series_lines(p, K, ["obs", "model", "bias"])
    return out.select(*K, secs("ts", "t"), "line")


@query(
    "snk05_prediction_rows",
    f"""SELECT station_id, t, {LINE_HEAD} || ' ' || {line_field('tide')} || ' ' || {line_field('model - tide')} AS line
        FROM (SELECT *, make_timestamp(t * 1000000) AS d FROM v_tide) WHERE obs IS NOT NULL""",
)
def _snk05(spark, sf_dir):
    from seamark.operators import tides
    from seamark.sinks import text as sink_text

    t = view(spark, sf_dir, "v_tide")
    res = tides.residual(t.filter("obs IS NOT NULL").select(*K, "ts", "model"), t.select(*K, "ts", "tide"), K, value="model")
    out = sink_text.series_lines(res, K, ["tide", "residual"])
    return out.select(*K, secs("ts", "t"), "line")
