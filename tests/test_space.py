"""Nearest neighbours and polygons against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from seamark.operators import boundary, mesh, spatial


def km(a, b, c, d):
    p = np.pi / 180
    h = 0.5 - np.cos((c - a) * p) / 2 + np.cos(a * p) * np.cos(c * p) * (1 - np.cos((d - b) * p)) / 2
    return 12742 * np.arcsin(np.sqrt(np.clip(h, 0, 1)))


def tables(spark, pts, nodes):
    p = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(pts)], "pid int, lat double, lon double")
    n = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(nodes)], "node_id int, lat double, lon double")
    return p, n


@pytest.mark.parametrize("lat0", [0.0, 45.0, 70.0])
def test_nearest_in_box_with_a_dense_cluster(spark, lat0):
    rng = np.random.default_rng(4)
    cluster = np.column_stack([lat0 + rng.normal(0, 0.0005, 300), 10 + rng.normal(0, 0.0005, 300)])
    spread = np.column_stack([lat0 + rng.uniform(-1, 1, 200), 10 + rng.uniform(-1, 1, 200)])
    nodes = np.vstack([cluster, spread])
    pts = np.vstack([np.column_stack([lat0 + rng.uniform(-1.2, 1.2, 80), 10 + rng.uniform(-1.2, 1.2, 80)]), cluster[:20] + 1e-4])
    p, n = tables(spark, pts, nodes)
    got = {r["pid"]: r for r in spatial.nearest(p, n, node_id="node_id", box_deg=0.1).collect()}
    for i, (a, b) in enumerate(pts):
        ok = (np.abs(nodes[:, 0] - a) < 0.1) & (np.abs(nodes[:, 1] - b) < 0.1)
        if not ok.any():
            assert got[i]["node_id"] is None
        else:
            d = np.where(ok, km(a, b, nodes[:, 0], nodes[:, 1]), np.inf)
            assert got[i]["distance"] == pytest.approx(d.min(), abs=1e-9)


@pytest.mark.parametrize("k", [1, 10])
def test_nearest_anywhere_wraps_the_date_line(spark, k):
    rng = np.random.default_rng(6)
    nodes = np.column_stack([rng.uniform(-80, 80, 150), rng.uniform(-180, 180, 150)])
    nodes = np.vstack([nodes, np.column_stack([rng.uniform(50, 50.2, 150), rng.uniform(179.8, 179.99, 150)])])
    pts = np.vstack([np.column_stack([rng.uniform(-80, 80, 30), rng.uniform(-180, 180, 30)]), [[50.1, -179.95], [50.1, 180.05]]])
    p, n = tables(spark, pts, nodes)
    rows = spatial.nearest(p, n, node_id="node_id", k=k).collect()
    for i, (a, b) in enumerate(pts):
        want = np.sort(km(a, b, nodes[:, 0], nodes[:, 1]))[:k]
        got = sorted(r["distance"] for r in rows if r["pid"] == i)
        np.testing.assert_allclose(got, want, atol=1e-8)


def test_points_without_position_stay_unmatched(spark):
    p = spark.createDataFrame([(1, None, 1.0), (2, 0.0, 0.0)], "pid int, lat double, lon double")
    n = spark.createDataFrame([(7, 0.01, 0.0)], "node_id int, lat double, lon double")
    got = {r["pid"]: r["node_id"] for r in spatial.nearest(p, n, node_id="node_id", box_deg=0.1).collect()}
    assert got == {1: None, 2: 7}


def square(spark, name, x, y, size):
    v = [(x, y), (x + size, y), (x + size, y + size), (x, y + size)]
    return spark.createDataFrame([(name, 0, [{"x": float(a), "y": float(b)} for a, b in v])], "domain string, ring int, vertices array<struct<x double, y double>>")


def test_polygon_masks(spark):
    rings = square(spark, "a", 0, 0, 1).unionByName(square(spark, "b", 0.5, 0.5, 1))
    edges = spatial.ring_edges(rings, ["domain", "ring"])
    pts = spark.createDataFrame([(1, 0.25, 0.25), (2, 0.75, 0.75), (3, 1.25, 1.25), (4, 3.0, 3.0), (5, 1.02, 0.2)], "pid int, lat double, lon double")
    hit = spatial.points_in_polygons(pts, edges).join(pts, ["lat", "lon"])
    assert sorted((r["pid"], r["domain"]) for r in hit.collect()) == [(1, "a"), (2, "a"), (2, "b"), (3, "b")]
    near = spatial.inside_domains(pts, edges.filter("domain = 'a'"), buffer_deg=0.04)
    assert sorted(r["pid"] for r in near.collect()) == [1, 2, 5]
    both = spatial.inside_both(pts, edges.filter("domain = 'a'"), edges.filter("domain = 'b'"))
    assert [r["pid"] for r in both.collect()] == [2]


def test_polygon_overlap_by_crossing_and_containment(spark):
    big = spatial.ring_edges(square(spark, "big", 0, 0, 10), ["domain", "ring"])
    small = spatial.ring_edges(
        square(spark, "in", 4, 4, 1).unionByName(square(spark, "cross", 9.5, 9.5, 1)).unionByName(square(spark, "out", 20, 20, 1)),
        ["domain", "ring"],
    ).withColumnRenamed("domain", "source")
    got = spatial.overlapping(small, big, left_id="source", right_id="domain")
    assert sorted(r["source"] for r in got.collect()) == ["cross", "in"]


def test_lattice_and_idw(spark):
    nodes = spark.createDataFrame([(i * 5 + j, 30 + i * 0.1, -70 + j * 0.1, float(i + j)) for i in range(5) for j in range(5)], "node_id int, lat double, lon double, v double")
    lat = spatial.regular_lattice(nodes, step=0.1)
    assert lat.count() == 9 * 9
    out = spatial.idw_grid(lat, nodes, node_id="node_id", value="v", radius_km=25).collect()
    assert len(out) == 81
    exact = [r for r in out if abs(r["lat"] - 30.25) < 1e-9 and abs(r["lon"] + 69.85) < 1e-9]
    assert exact and exact[0]["fill_pass"] == 1 and 3 < exact[0]["v"] < 5
    assert {r["fill_pass"] for r in out} == {1, 2}


def test_boundary_edges_occur_once(spark):
    tri = spark.createDataFrame([(1, 1, 2, 3), (2, 2, 3, 4)], "element_id int, n1 int, n2 int, n3 int")
    got = sorted((r["a"], r["b"]) for r in mesh.boundary_edges(tri).collect())
    assert got == [(1, 2), (1, 3), (2, 4), (3, 4)]


def test_sigma_to_depth_matches_interp(spark):
    sig = [-0.05, -0.2, -0.5, -0.8, -0.95]
    val = [10.0, 9.0, 7.0, 6.0, 5.5]
    h, zeta = 20.0, 0.5
    df = spark.createDataFrame([("n", s, v, h, zeta) for s, v in zip(sig, val)], "node string, sigma double, value double, h double, zeta double")
    got = {r["depth"]: r["value"] for r in boundary.to_fixed_depths(df, ["node"], depth_step=2.0).collect()}
    z = np.array([-(s * (h + zeta) + zeta) for s in sig])
    for d in np.arange(0, 22, 2.0):
        inside = z.min() <= d <= z.max() and -zeta <= d <= h
        if inside:
            assert got[d] == pytest.approx(np.interp(d, z, val))
        else:
            assert d not in got


def test_along_distance_ignores_chunking(spark):
    rng = np.random.default_rng(0)
    p = rng.uniform(0, 1, (40, 2))
    df = spark.createDataFrame([("b", i, float(a), float(c)) for i, (a, c) in enumerate(p)], "b string, i int, lat double, lon double")
    d = np.concatenate([[0], np.cumsum(km(p[:-1, 0], p[:-1, 1], p[1:, 0], p[1:, 1]))])
    for chunk in (7, 1000):
        out = boundary.along_distance(df, ["b"], chunk=chunk).orderBy("i").collect()
        np.testing.assert_allclose([r["along_km"] for r in out], d, atol=1e-9)


def met_nodes(spark, pts, nodes, k):
    """Nodes of the leaves that the search keeps."""
    p, n = tables(spark, pts, nodes)
    spots = n.selectExpr("lat AS nlat", "lon AS nlon", "1 AS m")
    cells, sizes, most = spatial._cell_tree(spots, None, k)
    leaves = spatial._near_leaves(p.selectExpr("lat AS plat", "lon AS plon"), cells.drop("spots"), sizes, most, k, None, None, False)
    return leaves.join(spatial._tiled(spots, "nlat", "nlon", sizes), ["level", "cy", "cx"]).count()


@pytest.mark.parametrize("far", [1.4, 0.0])
def test_candidates_do_not_grow_with_a_cluster(spark, far):
    rng = np.random.default_rng(0)
    nodes = np.column_stack([40 + rng.normal(0, 0.006, 80_000), -70 + rng.normal(0, 0.006, 80_000)])
    few, many = (met_nodes(spark, [(40.0 + far, -70.0)], nodes[:m], 8) for m in (20_000, 80_000))
    assert 8 <= few <= 100 and 8 <= many <= 100


def test_many_nodes_at_one_spot_keep_the_smallest_ids(spark):
    p, n = tables(spark, [(10.0, 10.0)], [(10.0, 10.0)] * 50 + [(10.0, 10.001)] * 50)
    rows = spatial.nearest(p, n, node_id="node_id", k=3).collect()
    assert sorted((r["rank"], r["node_id"]) for r in rows) == [(1, 0), (2, 1), (3, 2)]


def test_convex_hull_by_widest_gap(spark):
    """Against the widest angle between neighbouring bearings, on whole numbers with collinear points and the origin."""
    import math
    import random

    from pyspark.sql import functions as F

    rng = random.Random(8)
    cases = [[(rng.randint(-3, 3), rng.randint(-3, 3)) for _ in range(rng.randint(1, 5))] for _ in range(400)] + [[], [(1, 0), (-2, 0)], [(1, 1)], [(2, 0), (1, 0)], [(0, 0)]]

    def inside(points):
        if (0, 0) in points:
            return True
        turn = sorted(math.atan2(y, x) for x, y in points)
        gaps = [b - a for a, b in zip(turn, turn[1:] + [turn[0] + 2 * math.pi] if turn else [])]
        return bool(gaps) and max(gaps) <= math.pi + 1e-9

    rows = [(i, [(float(x), float(y)) for x, y in c]) for i, c in enumerate(cases)]
    df = spark.createDataFrame(rows, "i int, p array<struct<x: double, y: double>>")
    got = {r.i: r.inside for r in df.select("i", spatial.surrounded(F.col("p")).alias("inside")).collect()}
    assert got == {i: inside(c) for i, c in enumerate(cases)} and 50 < sum(got.values()) < 350


def test_gridding_sees_targets_inside_a_triangle(spark):
    """No node lies in the fourth quadrant, yet the target is in the hull of the three."""
    target = spark.createDataFrame([(0, 0, 40.0, -70.0)], "iy int, ix int, lat double, lon double")
    nodes = spark.createDataFrame([(1, 40.1, -70.02, 1.0), (2, 39.9, -70.1, 2.0), (3, 40.02, -69.9, 3.0)], "node_id long, lat double, lon double, v double")
    (row,) = spatial.idw_grid(target, nodes, node_id="node_id", value="v", radius_km=30).collect()
    assert row.fill_pass == 1 and 1 < row.v < 3
    (row,) = spatial.idw_grid(target, nodes.filter("node_id < 3"), node_id="node_id", value="v", radius_km=30).collect()
    assert row.fill_pass == 2
