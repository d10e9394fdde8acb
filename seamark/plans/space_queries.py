"""Spatial matching, polygons, gridding: queries with SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from seamark.functions import geo
from seamark.operators import quantiles, spatial
from seamark.plans.demo import r6, table, view
from seamark.plans.registry import query

_KM = """12742 * asin(sqrt(least(greatest(0.5 - cos(radians({a}.lat - {b}.lat)) / 2 + cos(radians({b}.lat)) * cos(radians({a}.lat))
  * (1 - cos(radians({a}.lon - {b}.lon))) / 2, 0), 1)))"""
KM = _KM.format(a="n", b="s")


@query(
    "joi07_nearest_node",
    f"""WITH c AS (SELECT s.station_id, n.node_id, {KM} AS d FROM v_stations s JOIN v_nodes n
        ON n.lat > s.lat - 1e-1 AND n.lat < s.lat + 1e-1 AND abs(n.lon - s.lon) < 1e-1 WHERE n.wet = 1),
      b AS (SELECT station_id, arg_min(node_id, (d, node_id)) AS node_id, min(d) AS d FROM c GROUP BY 1)
      SELECT s.station_id, b.node_id, round(b.d, 6) AS distance_km FROM v_stations s LEFT JOIN b USING (station_id)""",
)
def _joi07(spark, sf_dir):
    nodes = view(spark, sf_dir, "v_nodes").filter("wet = 1")
    out = spatial.nearest(view(spark, sf_dir, "v_stations"), nodes, node_id="node_id", box_deg=0.1)
    return out.select("station_id", "node_id", r6("distance", "distance_km"))


@query(
    "joi08_nearest_station_2km",
    f"""WITH c AS (SELECT s.station_id, n.node_id, {KM} AS d FROM v_stations s JOIN v_nodes n
        ON abs(n.lat - s.lat) < 3e-1 AND abs(n.lon - s.lon) < 3e-1),
      b AS (SELECT station_id, arg_min(node_id, (d, node_id)) AS node_id, min(d) AS d FROM c WHERE d <= 2 GROUP BY 1)
      SELECT s.station_id, b.node_id, round(b.d, 6) AS distance_km FROM v_stations s LEFT JOIN b USING (station_id)""",
)
def _joi08(spark, sf_dir):
    out = spatial.nearest(
        view(spark, sf_dir, "v_stations"), view(spark, sf_dir, "v_nodes"), node_id="node_id", box_deg=0.3, max_km=2.0
    )
    return out.select("station_id", "node_id", r6("distance", "distance_km"))


@query(
    "joi08_match_by_name",
    """WITH s AS (SELECT CAST(s_suppkey AS VARCHAR) AS sid FROM supplier), c AS (SELECT s.sid, c_name, c_custkey
        FROM s JOIN customer ON contains(c_name, s.sid))
      SELECT s.sid AS id, b.c_name AS matched_c_name, b.c_custkey AS matched_c_custkey FROM s LEFT JOIN
        (SELECT sid, arg_min(c_name, c_custkey) c_name, min(c_custkey) c_custkey FROM c GROUP BY 1) b USING (sid)""",
)
def _joi08n(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("id"))
    c = table(spark, sf_dir, "customer").select("c_name", "c_custkey")
    return spatial.substring_match(s, c, key="id", name="c_name", order="c_custkey")


def _layers(nodes, count: int = 10):
    """Sigma layers: depth = h * -(i + 0.5) / count."""
    i = F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    return nodes.select("node_id", "h", i.alias("layer")).select(
        "node_id", "layer", (-F.col("h") * (F.col("layer") + 0.5) / count).alias("z")
    )


@query(
    "joi09_nearest_depth_layer",
    """WITH ly AS (SELECT node_id, i AS layer, -h * (i + 5e-1) / 10 AS z FROM v_nodes, range(10) r(i)),
      st AS (SELECT l_orderkey, l_linenumber, l_partkey AS node_id, l_quantity AS depth FROM lineitem),
      d AS (SELECT DISTINCT node_id, depth FROM st),
      b AS (SELECT d.node_id, d.depth, arg_min(layer, (abs(depth + z), layer)) AS layer FROM d JOIN ly USING (node_id) GROUP BY 1, 2)
      SELECT l_orderkey, l_linenumber, node_id, layer FROM st LEFT JOIN b USING (node_id, depth)""",
)
def _joi09(spark, sf_dir):
    layers = _layers(view(spark, sf_dir, "v_nodes"))
    st = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").alias("node_id"), F.col("l_quantity").alias("depth")
    )
    return spatial.nearest_layer(st, layers).select("l_orderkey", "l_linenumber", "node_id", "layer")


@query(
    "joi10_k_nearest_tide_stations",
    f"""WITH c AS (SELECT s.station_id, n.node_id, {KM} AS d, row_number() OVER (PARTITION BY s.station_id ORDER BY {KM}, n.node_id) AS rank
        FROM v_stations s CROSS JOIN v_nodes n)
      SELECT station_id, node_id, CAST(rank AS INTEGER) AS rank, round(d, 6) AS distance_km FROM c WHERE rank <= 10""",
)
def _joi10(spark, sf_dir):
    out = spatial.nearest(view(spark, sf_dir, "v_stations"), view(spark, sf_dir, "v_nodes"), node_id="node_id", k=10)
    return out.select("station_id", "node_id", "rank", r6("distance", "distance_km"))


@query(
    "joi11_nearest_valid_cell",
    """WITH v AS (SELECT DISTINCT p_partkey AS node_id FROM part JOIN lineitem ON l_partkey = p_partkey WHERE l_discount >= 9e-2),
      c AS (SELECT s.station_id, n.node_id, (n.lat - s.lat)*(n.lat - s.lat) + (n.lon - s.lon)*(n.lon - s.lon) AS d, v.node_id IS NOT NULL AS valid
        FROM v_stations s JOIN v_nodes n ON abs(n.lat - s.lat) <= 6e-2 AND abs(n.lon - s.lon) <= 6e-2 LEFT JOIN v ON v.node_id = n.node_id),
      a AS (SELECT station_id FROM c GROUP BY 1 HAVING min(d) <= 3e-2 * 3e-2),
      b AS (SELECT station_id, arg_min(node_id, (d, node_id)) AS node_id FROM c WHERE valid AND d <= 5e-2 * 5e-2 GROUP BY 1)
      SELECT s.station_id, CASE WHEN a.station_id IS NOT NULL THEN b.node_id END AS node_id
      FROM v_stations s LEFT JOIN a USING (station_id) LEFT JOIN b USING (station_id)""",
)
def _joi11(spark, sf_dir):
    from seamark.operators import ice

    good = (
        table(spark, sf_dir, "lineitem")
        .filter("l_discount >= 0.09")
        .select(F.col("l_partkey").alias("node_id"))
        .distinct()
    )
    out = ice.nearest_valid(
        view(spark, sf_dir, "v_stations"), view(spark, sf_dir, "v_nodes"), good, node_id="node_id", first_deg=0.03, retry_deg=0.05
    )
    return out.select("station_id", "node_id")


@query(
    "joi12_nearest_valid_datum_node",
    f"""WITH f AS (SELECT *, CASE WHEN node_id % 7 = 0 THEN -9999e0 WHEN node_id % 11 = 0 THEN 99999e0 ELSE h / 10 END AS shift FROM v_nodes),
      c AS (SELECT s.station_id, n.node_id, n.shift, {KM} AS d FROM v_stations s JOIN f n
        ON abs(n.lat - s.lat) < 1e-1 AND abs(n.lon - s.lon) < 1e-1 WHERE abs(shift) < 999)
      SELECT s.station_id, b.node_id, b.shift AS datum_shift FROM v_stations s LEFT JOIN
       (SELECT station_id, arg_min(node_id, (d, node_id)) node_id, arg_min(shift, (d, node_id)) shift FROM c GROUP BY 1) b USING (station_id)""",
)
def _joi12(spark, sf_dir):
    from seamark.operators import datums

    n = F.col("node_id")
    field = view(spark, sf_dir, "v_nodes").withColumn(
        "datum_shift", F.when(n % 7 == 0, -9999.0).when(n % 11 == 0, 99999.0).otherwise(F.col("h") / 10)
    )
    out = datums.nearest_valid_shift(view(spark, sf_dir, "v_stations"), field, node_id="node_id", shift="datum_shift")
    return out.select("station_id", "node_id", "datum_shift")


@query(
    "scl05_great_circle",
    f"""SELECT s.station_id, round({KM}, 6) AS km FROM v_stations s JOIN v_nodes n ON n.node_id = s.station_id""",
)
def _scl05(spark, sf_dir):
    s = view(spark, sf_dir, "v_stations").select("station_id", "lat", "lon")
    n = view(spark, sf_dir, "v_nodes").select(
        F.col("node_id").alias("station_id"), F.col("lat").alias("nlat"), F.col("lon").alias("nlon")
    )
    km = geo.great_circle_km(F.col("lat"), F.col("lon"), F.col("nlat"), F.col("nlon"))
    return s.join(n, "station_id").select("station_id", F.round(km, 6).alias("km"))


# Domains: a concave ring and a triangle per supplier, from its key.
_RINGS = """rg AS (SELECT s_suppkey AS domain, 0 AS ring, 30 + (s_suppkey * 17 % 47) / 1e1 AS cy, -80 + (s_suppkey * 29 % 97) / 1e1 + floor(s_suppkey / 100) % 25 * 10 AS cx FROM supplier),
 vx AS (SELECT domain, i, cx + dx AS x, cy + dy AS y FROM rg, (VALUES (0, -3e-1, -2e-1), (1, 35e-2, -25e-2), (2, 5e-2, 1e-2), (3, 4e-1, 3e-1), (4, -2e-1, 25e-2)) p(i, dx, dy)),
 ed AS (SELECT a.domain, a.i, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2 FROM vx a JOIN vx b ON a.domain = b.domain AND b.i = (a.i + 1) % 5)"""
_INSIDE = """ins AS (SELECT s.station_id, e.domain FROM v_stations s JOIN ed e ON (e.y1 > s.lat) <> (e.y2 > s.lat)
   AND s.lon < (e.x2 - e.x1) * ((s.lat - e.y1) / (e.y2 - e.y1)) + e.x1 GROUP BY 1, 2 HAVING count(*) % 2 = 1)"""


def _edges(spark, sf_dir):
    # Corner offsets (x, y) of the demo domain.
    shape = [(-0.3, -0.2), (0.35, -0.25), (0.05, 0.01), (0.4, 0.3), (-0.2, 0.25)]
    key = F.col("s_suppkey")
    cy, cx = 30 + (key * 17 % 47) / 10.0, -80 + (key * 29 % 97) / 10.0 + F.floor(key / 100) % 25 * 10
    rings = table(spark, sf_dir, "supplier").select(
        key.alias("domain"),
        F.lit(0).alias("ring"),
        F.array(*[F.struct((cx + dx).alias("x"), (cy + dy).alias("y")) for dx, dy in shape]).alias("vertices"),
    )
    return spatial.ring_edges(rings, ["domain", "ring"])


@query(
    "flt07_point_in_polygon",
    f"WITH {_RINGS}, {_INSIDE} SELECT station_id, domain FROM ins",
)
def _flt07(spark, sf_dir):
    s = view(spark, sf_dir, "v_stations")
    hit = spatial.points_in_polygons(s, _edges(spark, sf_dir))
    return s.join(hit, ["lat", "lon"]).select("station_id", "domain")


@query(
    "flt08_buffered_polygon",
    f"""WITH {_RINGS}, {_INSIDE}, pr AS (SELECT s.station_id, s.lat, s.lon, e.*, least(greatest(((s.lon - x1)*(x2 - x1) + (s.lat - y1)*(y2 - y1))
        / ((x2-x1)*(x2-x1) + (y2-y1)*(y2-y1)), 0), 1) AS k FROM v_stations s CROSS JOIN ed e),
      nr AS (SELECT DISTINCT station_id FROM pr WHERE sqrt((lon - (x1 + k*(x2-x1)))**2 + (lat - (y1 + k*(y2-y1)))**2) <= 4e-2)
      SELECT station_id FROM ins UNION SELECT station_id FROM nr""",
)
def _flt08(spark, sf_dir):
    s = view(spark, sf_dir, "v_stations")
    return spatial.inside_domains(s, _edges(spark, sf_dir), buffer_deg=0.04).select("station_id")


@query(
    "joi26_two_domain_overlap",
    f"""WITH {_RINGS}, {_INSIDE} SELECT DISTINCT a.station_id FROM ins a JOIN ins b USING (station_id)
        WHERE a.domain % 2 = 0 AND b.domain % 2 = 1""",
)
def _joi26(spark, sf_dir):
    e = _edges(spark, sf_dir)
    s = view(spark, sf_dir, "v_stations")
    return spatial.inside_both(s, e.filter("domain % 2 = 0"), e.filter("domain % 2 = 1")).select("station_id")


@query(
    "joi21_polygon_overlap",
    f"""WITH {_RINGS}, bx AS (SELECT station_id AS source, lon - 2e-1 x0, lon + 2e-1 x1, lat - 15e-2 y0, lat + 15e-2 y1 FROM v_stations),
      be AS (SELECT source, x0 AS x1, y0 AS y1, x1 AS x2, y0 AS y2 FROM bx UNION ALL SELECT source, x1, y0, x1, y1 FROM bx
        UNION ALL SELECT source, x1, y1, x0, y1 FROM bx UNION ALL SELECT source, x0, y1, x0, y0 FROM bx),
      cr AS (SELECT DISTINCT b.source, e.domain FROM be b JOIN ed e ON
        sign((e.x2-e.x1)*(b.y1-e.y1)-(e.y2-e.y1)*(b.x1-e.x1)) * sign((e.x2-e.x1)*(b.y2-e.y1)-(e.y2-e.y1)*(b.x2-e.x1)) < 0
        AND sign((b.x2-b.x1)*(e.y1-b.y1)-(b.y2-b.y1)*(e.x1-b.x1)) * sign((b.x2-b.x1)*(e.y2-b.y1)-(b.y2-b.y1)*(e.x2-b.x1)) < 0),
      vin AS (SELECT bx.source, v.domain FROM bx JOIN vx v ON v.i = 0 AND v.x > bx.x0 AND v.x < bx.x1 AND v.y > bx.y0 AND v.y < bx.y1),
      bin AS (SELECT b.source, e.domain FROM bx b JOIN ed e ON (e.y1 > b.y0) <> (e.y2 > b.y0)
         AND b.x0 < (e.x2 - e.x1) * ((b.y0 - e.y1) / (e.y2 - e.y1)) + e.x1 GROUP BY 1, 2 HAVING count(*) % 2 = 1)
      SELECT source, domain FROM cr UNION SELECT source, domain FROM vin UNION SELECT source, domain FROM bin""",
)
def _joi21(spark, sf_dir):
    lat, lon = F.col("lat"), F.col("lon")
    x0, x1, y0, y1 = lon - 0.2, lon + 0.2, lat - 0.15, lat + 0.15
    corners = [(x0, y0), (x1, y0), (x1, y1), (x0, y1)]
    boxes = view(spark, sf_dir, "v_stations").select(
        F.col("station_id").alias("source"),
        F.lit(0).alias("ring"),
        F.array(*[F.struct(x.alias("x"), y.alias("y")) for x, y in corners]).alias("vertices"),
    )
    return spatial.overlapping(
        spatial.ring_edges(boxes, ["source", "ring"]), _edges(spark, sf_dir), left_id="source", right_id="domain"
    )


@query(
    "grd01_regular_lattice",
    """WITH b AS (SELECT round(min(lat), 2) - 25e-2 AS ya, round(max(lat), 2) + 25e-2 AS yb, round(min(lon), 2) - 25e-2 AS xa,
        round(max(lon), 2) + 25e-2 AS xb FROM v_nodes),
      y AS (SELECT unnest(range(0, CAST(ceil((yb - ya) / 4e-2 - 1e-9) AS BIGINT))) AS iy FROM b),
      x AS (SELECT unnest(range(0, CAST(ceil((xb - xa) / 4e-2 - 1e-9) AS BIGINT))) AS ix FROM b)
      SELECT iy, ix, round(ya + iy * 4e-2, 2) AS lat, round(xa + ix * 4e-2, 2) AS lon FROM b, y, x""",
)
def _grd01(spark, sf_dir):
    return spatial.regular_lattice(view(spark, sf_dir, "v_nodes"), step=0.04)


@query(
    "agg45_source_spacing",
    f"""WITH q AS (SELECT * FROM v_nodes WHERE wet = 1), c AS (SELECT n.node_id, {_KM.format(a="m", b="n")} AS d,
         row_number() OVER (PARTITION BY n.node_id ORDER BY {_KM.format(a="m", b="n")}, m.node_id) r
       FROM q n JOIN q m ON abs(m.lat - n.lat) < 25e-2 AND abs(m.lon - n.lon) < 25e-2)
      SELECT round(median(d), 6) AS spacing_km, round(3 * median(d), 6) AS base_radius_km FROM c WHERE r BETWEEN 2 AND 6""",
)
def _agg45(spark, sf_dir):
    out = spatial.source_spacing_km(view(spark, sf_dir, "v_nodes").filter("wet = 1"), node_id="node_id")
    return out.select(r6("spacing_km"), F.round(3 * F.col("spacing_km"), 6).alias("base_radius_km"))


_NEAR = """SELECT s.station_id, s.lat, s.lon, n.h, n.lat AS nlat, n.lon AS nlon, d,
    row_number() OVER (PARTITION BY s.station_id ORDER BY d, n.node_id) r FROM
    (SELECT s.station_id AS sid, n.node_id AS nid, {km} AS d FROM v_stations s JOIN q n ON abs(n.lat - s.lat) < {box} AND abs(n.lon - s.lon) < {box}) p
    JOIN v_stations s ON s.station_id = p.sid JOIN q n ON n.node_id = p.nid"""


@query(
    "grd02_idw_grid",
    f"""WITH q AS (SELECT * FROM v_nodes WHERE wet = 1), a AS ({_NEAR.format(km=KM, box="5e-1")}),
      c AS (SELECT * FROM a WHERE r <= 8 AND d <= 16),
      o AS (SELECT i.station_id FROM c i JOIN c j USING (station_id) GROUP BY i.station_id, i.r
        HAVING bool_and((i.nlon - i.lon) * (j.nlat - j.lat) - (i.nlat - i.lat) * (j.nlon - j.lon) > 0 OR ((i.nlon - i.lon) * (j.nlat - j.lat) - (i.nlat - i.lat) * (j.nlon - j.lon) = 0 AND (i.nlon - i.lon) * (j.nlon - j.lon) + (i.nlat - i.lat) * (j.nlat - j.lat) > 0))),
      p1 AS (SELECT station_id, sum(h / (d*d)) / sum(1 / (d*d)) AS v FROM c WHERE station_id NOT IN (SELECT station_id FROM o) GROUP BY 1),
      b AS (SELECT s.station_id, n.h, {KM} AS d, row_number() OVER (PARTITION BY s.station_id ORDER BY {KM}, n.node_id) r
        FROM (SELECT * FROM v_stations WHERE station_id NOT IN (SELECT station_id FROM p1)) s CROSS JOIN q n),
      p2 AS (SELECT station_id, sum(h / (d*d)) / sum(1 / (d*d)) AS v FROM b WHERE r <= 16 GROUP BY 1)
      SELECT station_id, round(v, 6) AS h, 1 AS fill_pass FROM p1 UNION ALL SELECT station_id, round(v, 6), 2 FROM p2""",
)
def _grd02(spark, sf_dir):
    out = spatial.idw_grid(
        view(spark, sf_dir, "v_stations").select("station_id", "lat", "lon"),
        view(spark, sf_dir, "v_nodes").filter("wet = 1"),
        node_id="node_id",
        value="h",
        radius_km=16.0,
        target_keys=["station_id"],
    )
    return out.select("station_id", r6("h"), "fill_pass")


@query(
    "grd03_nearest_regrid",
    f"""WITH c AS (SELECT s.station_id, n.node_id, n.h, {KM} AS d FROM v_stations s JOIN v_nodes n
        ON abs(n.lat - s.lat) < 1e0 AND abs(n.lon - s.lon) < 1e0 ),
      b AS (SELECT station_id, arg_min(h, (d, node_id)) AS h FROM c GROUP BY 1)
      SELECT station_id, h FROM v_stations LEFT JOIN b USING (station_id)""",
)
def _grd03(spark, sf_dir):
    out = spatial.nearest(
        view(spark, sf_dir, "v_stations"),
        view(spark, sf_dir, "v_nodes"),
        node_id="node_id",
        node_columns=["h"],
        box_deg=1.0,
    )
    return out.select("station_id", "h")


@query(
    "agg46_gap_threshold",
    """SELECT l_suppkey AS station_id, round(quantile_cont(l_extendedprice, 5e-1) + 3 * (quantile_cont(l_extendedprice, 75e-2)
        - quantile_cont(l_extendedprice, 25e-2)), 4) AS threshold FROM lineitem GROUP BY 1""",
)
def _agg46(spark, sf_dir):
    from seamark.operators import boundary

    d = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("station_id"), F.col("l_extendedprice").alias("distance")
    )
    return boundary.gap_threshold(d, ["station_id"], "distance").select("station_id", F.round("threshold", 4).alias("threshold"))
