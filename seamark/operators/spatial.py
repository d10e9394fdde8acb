"""Nearest neighbours, polygons and regular grids, by bucketed equi-joins.

Nearest search descends a tree of cells, each split 4 x 4, in which a cell of few nodes
is a leaf.  A point starts at the finest level at which its own cell holds k nodes,
with the cells around it.  Every round bounds the k-th distance by the counts
of all cells met so far, drops cells beyond the bound and splits those that are left
and no leaves.  Only nodes of the last leaves are met, so a dense cluster is never
met whole, wherever it lies and however many nodes it has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seamark.functions.geo import EARTH_DIAMETER_KM, great_circle_km, haversine, wrap_longitude
from seamark.session import cut_lineage, dealt, spread

SPLIT = 4
LEAST_LEAF = 4
#: Levels tried until every leaf is small; the last leaves 360 / 4 ** 21 degrees.
DEPTHS = (9, 15, 22)


def _sizes(box_deg: float | None, depth: int) -> list[float]:
    """Cell sizes by level.  With a box, the first is slightly wider than it and divides
    the circle, so that the box never reaches past the neighbouring cell."""
    top = 360.0 if box_deg is None else 360.0 / max(1, int(360.0 / (box_deg * 1.001)))
    return [top / SPLIT**i for i in range(depth)]


def _cell(lat: Column, lon: Column, size: Column) -> list[Column]:
    columns = F.round(360.0 / size)
    return [
        F.floor((lat + 90.0) / size).alias("cy"),
        F.pmod(F.floor((wrap_longitude(lon) + 180.0) / size), columns).cast("bigint").alias("cx"),
    ]


def _levels(sizes: Sequence[float]) -> Column:
    return F.explode(
        F.array(
            *[F.struct(F.lit(i).alias("level"), F.lit(float(s)).alias("size")) for i, s in enumerate(sizes)]
        )
    ).alias("lv")


def _tiled(rows: DataFrame, lat: str, lon: str, sizes: Sequence[float]) -> DataFrame:
    return rows.select("*", _levels(sizes)).select(
        *rows.columns, F.col("lv.level").alias("level"), *_cell(F.col(lat), F.col(lon), F.col("lv.size"))
    )


def _cell_tree(sites: DataFrame, box_deg: float | None, k: int) -> tuple[DataFrame, list[float], int]:
    """(level, cy, cx, n) of every cell down to leaves, the sizes, and the most nodes of a leaf.

    The number of levels follows the counts: deeper ones are tried while a last cell holds
    more than a leaf may.  Nodes at one position cannot be told apart and do not count twice.
    """
    most = max(LEAST_LEAF, k)
    for depth in DEPTHS:
        sizes = _sizes(box_deg, depth)
        cells = _tiled(sites, "nlat", "nlon", sizes).groupBy("level", "cy", "cx").agg(
            F.sum("m").alias("n"), F.count(F.lit(1)).alias("spots")
        )
        crowded = cells.filter((F.col("level") == depth - 1) & (F.col("spots") > 1) & (F.col("n") > most))
        if depth == DEPTHS[-1] or crowded.isEmpty():
            return cells, sizes, most
    raise AssertionError("unreachable")


def _box_bounds(planar: bool) -> tuple[Column, Column]:
    """Least and greatest distance measure of a point to the cell (y0, x0, size)."""
    y0, x0, size = F.col("y0"), F.col("x0"), F.col("size")
    plat, plon = F.col("plat"), F.col("plon")
    y1 = y0 + size
    dy = F.greatest(F.lit(0.0), y0 - plat, plat - y1)
    dy_far = F.greatest(F.abs(y0 - plat), F.abs(y1 - plat))
    off = F.abs(wrap_longitude(x0 + size / 2 - plon))
    dx = F.greatest(F.lit(0.0), off - size / 2)
    dx_far = F.least(F.lit(180.0), off + size / 2)
    if planar:
        return dy * dy + dx * dx, dy_far * dy_far + dx_far * dx_far
    a, b = F.greatest(y0, F.lit(-90.0)), F.least(y1, F.lit(90.0))
    narrow = F.least(F.cos(F.radians(a)), F.cos(F.radians(b)))
    broad = F.when((y0 <= 0) & (y1 >= 0), F.lit(1.0)).otherwise(
        F.greatest(F.cos(F.radians(a)), F.cos(F.radians(b)))
    )
    own = F.cos(F.radians(plat))

    def half(dy: Column, dx: Column, shrink: Column) -> Column:
        sy, sx = F.sin(F.radians(dy) / 2), F.sin(F.radians(dx) / 2)
        return sy * sy + own * F.greatest(shrink, F.lit(0.0)) * sx * sx

    return half(dy, dx, narrow), half(F.least(dy_far, F.lit(180.0)), dx_far, broad)


def _near_leaves(
    lookup: DataFrame, cells: DataFrame, sizes: list[float], most: int, k: int, box_deg: float | None, max_km: float | None, planar: bool, resolution_km: float = 0.0
) -> DataFrame:
    """(plat, plon, level, cy, cx): leaves that can hold one of the k nearest of each point."""
    size_of = F.element_at(F.array(*[F.lit(float(s)) for s in sizes]), F.col("level") + 1)
    filled = cells.filter(F.col("n") >= k).select("level", "cy", "cx")
    start = (
        _tiled(lookup, "plat", "plon", sizes)
        .join(spread(filled), ["level", "cy", "cx"])
        .groupBy("plat", "plon")
        .agg(F.max("level").alias("fine"))
    )
    start = lookup.join(spread(start), ["plat", "plon"], "left").withColumn("level", F.coalesce("fine", F.lit(0))).withColumn("size", size_of)
    # The own cell's diagonal bounds the k-th distance; in cells of a row, more towards the poles.
    edge = F.least(F.abs("plat") + 3 * F.col("size"), F.lit(89.5))
    wide = F.floor(F.lit(1.5) / F.cos(F.radians(edge))) + 1
    columns = F.round(360.0 / F.col("size"))
    if box_deg is None:
        reach_y = F.when(F.col("level") == 0, F.lit(0)).otherwise(2)
        reach_x = F.when(F.col("level") == 0, F.lit(0)).otherwise(F.least(wide, F.floor(columns / 2)).cast("int"))
    else:
        # The box itself spans one top-level cell to each side.
        reach_y = F.when(F.col("level") == 0, F.lit(1)).otherwise(2)
        cap = F.floor(F.lit(sizes[0]) / F.col("size")) + 1
        reach_x = F.when(F.col("level") == 0, F.lit(1)).otherwise(F.least(wide, cap).cast("int"))
    cy0, cx0 = _cell(F.col("plat"), F.col("plon"), F.col("size"))
    near = (
        start.select("plat", "plon", "level", cy0.alias("cy0"), cx0.alias("cx0"), reach_y.alias("ry"), reach_x.cast("bigint").alias("rx"), columns.alias("ncol"))
        .select("*", F.explode(F.sequence(F.col("cy0") - F.col("ry"), F.col("cy0") + F.col("ry"))).alias("cy"))
        .select(
            "plat",
            "plon",
            "level",
            "cy",
            F.explode(
                F.array_distinct(
                    F.transform(
                        F.sequence(F.col("cx0") - F.col("rx"), F.col("cx0") + F.col("rx")),
                        lambda c: F.pmod(c, F.col("ncol")).cast("bigint"),
                    )
                )
            ).alias("cx"),
        )
        .join(spread(cells.select("level", "cy", "cx", "n")), ["level", "cy", "cx"])
    )
    low, high = _box_bounds(planar)
    if resolution_km:
        reach = F.lit(resolution_km / EARTH_DIAMETER_KM)
        low, high = F.pow(F.greatest(F.sqrt(low) - reach, F.lit(0.0)), 2), F.pow(F.sqrt(high) + reach, 2)
    mine = Window.partitionBy("plat", "plon")
    outward = mine.orderBy("high").rangeBetween(Window.unboundedPreceding, 0)

    def pruned(met: DataFrame) -> DataFrame:
        met = met.withColumn("size", size_of)
        met = met.withColumn("y0", F.col("cy") * F.col("size") - 90.0).withColumn("x0", F.col("cx") * F.col("size") - 180.0)
        sure = F.col("n")
        if box_deg is not None:
            # Strictly inside the box with some room for rounding, or else not counted.
            room = box_deg * (1 - 1e-9)
            off = F.abs(wrap_longitude(F.col("x0") + F.col("size") / 2 - F.col("plon")))
            tall = F.greatest(F.abs(F.col("y0") - F.col("plat")), F.abs(F.col("y0") + F.col("size") - F.col("plat")))
            met = met.filter((F.greatest(F.col("y0") - F.col("plat"), F.col("plat") - F.col("y0") - F.col("size")) < box_deg) & (off - F.col("size") / 2 < box_deg))
            sure = F.when((tall < room) & (off + F.col("size") / 2 < room), F.col("n")).otherwise(0)
        # Rounding, also that of the distances, must not lose a cell: bounds are widened by a hair.
        met = met.withColumn("low", low * (1 - 1e-9) - 1e-15).withColumn("high", high * (1 + 1e-9) + 1e-15)
        if max_km is not None:
            met = met.filter(F.col("low") <= haversine(max_km) * (1 + 1e-9) + 1e-15)
        met = met.withColumn("held", F.sum(sure).over(outward))
        met = met.withColumn("bound", F.min(F.when(F.col("held") >= k, F.col("high"))).over(mine))
        return met.filter(F.col("bound").isNull() | (F.col("low") <= F.col("bound"))).select("plat", "plon", "level", "cy", "cx", "n")

    open_ = (F.col("n") > most) & (F.col("level") < len(sizes) - 1)
    up = [F.floor(F.col(c) / SPLIT).cast("bigint").alias(c) for c in ("cy", "cx")]
    # A cell's children; in latitude the grid starts at -90 on every level.
    children = cells.select((F.col("level") - 1).alias("level"), *up, F.struct("cy", "cx", "n").alias("child"))
    state = pruned(near)
    while True:
        state = cut_lineage(state)
        if state.filter(open_).isEmpty():
            return state.drop("n")
        split = state.filter(open_).drop("n").join(spread(children), ["level", "cy", "cx"])
        split = split.select("plat", "plon", (F.col("level") + 1).alias("level"), "child.cy", "child.cx", "child.n")
        state = pruned(state.filter(~open_).unionByName(split))


def nearest(
    points: DataFrame,
    nodes: DataFrame,
    *,
    node_id: str,
    node_columns: Sequence[str] = (),
    k: int = 1,
    box_deg: float | None = None,
    max_km: float | None = None,
    planar: bool = False,
    resolution_km: float = 0.0,
    lat: str = "lat",
    lon: str = "lon",
) -> DataFrame:
    """The k nearest nodes of each point row, as extra columns.

    Adds ``node_id`` (and ``node_columns``), ``distance`` and, for k > 1,
    ``rank``.  Candidates lie strictly inside +-``box_deg`` and within
    ``max_km``; ties go to the smaller id.  Points without candidates keep NULL.
    ``planar`` ranks by squared degrees instead of kilometres.  With ``resolution_km``
    distances are ranked in whole multiples of it, so that nodes as far but for rounding
    are ties.  Rounds of the search run
    here, each ending in a checkpoint of the cells still in question.
    """
    if planar and (max_km is not None or resolution_km):
        raise ValueError("max_km and resolution_km need great-circle distances")
    lookup = (
        points.select(F.col(lat).cast("double").alias("plat"), F.col(lon).cast("double").alias("plon"))
        .filter("plat IS NOT NULL AND plon IS NOT NULL")
        .distinct()
    )
    sites = nodes.select(
        F.col(lat).cast("double").alias("nlat"),
        F.col(lon).cast("double").alias("nlon"),
        F.struct(F.col(node_id), *[F.col(c) for c in node_columns if c != node_id]).alias("node"),
    ).filter("nlat IS NOT NULL AND nlon IS NOT NULL")
    # Nodes at one spot: only the k smallest ids can win.
    if k == 1:
        sites = sites.groupBy("nlat", "nlon").agg(F.array(F.min_by("node", f"node.{node_id}")).alias("held"))
    else:
        turn = F.row_number().over(Window.partitionBy("nlat", "nlon").orderBy(f"node.{node_id}"))
        sites = sites.withColumn("turn", turn).filter(F.col("turn") <= k)
        sites = sites.groupBy("nlat", "nlon").agg(F.collect_list("node").alias("held"))
    spots = sites.select("nlat", "nlon", F.size("held").alias("m"))
    cells, sizes, most = _cell_tree(spots, box_deg, k)
    cells = cut_lineage(cells.drop("spots"))
    leaves = _near_leaves(lookup, cells, sizes, most, k, box_deg, max_km, planar, resolution_km)
    # A spot lies in one cell a level; only cells that some point kept are met.
    placed = _tiled(sites, "nlat", "nlon", sizes).join(spread(leaves.select("level", "cy", "cx").distinct()), ["level", "cy", "cx"], "left_semi")
    dlat, dlon = F.col("nlat") - F.col("plat"), wrap_longitude(F.col("nlon") - F.col("plon"))
    km = great_circle_km(F.col("plat"), F.col("plon"), F.col("nlat"), F.col("nlon"))
    met = leaves.join(spread(placed), ["level", "cy", "cx"])
    if box_deg is not None:
        met = met.filter((F.abs(dlat) < box_deg) & (F.abs(dlon) < box_deg))
    met = met.select("plat", "plon", "held", (dlat * dlat + dlon * dlon if planar else km).alias("distance"))
    if max_km is not None:
        met = met.filter(F.col("distance") <= max_km)
    met = met.select("plat", "plon", "distance", F.explode("held").alias("node"))
    ranked = F.round(F.col("distance") / resolution_km) if resolution_km else F.col("distance")
    place = F.struct(ranked.alias("far"), F.col("node")[node_id].alias("id"))
    if k == 1:
        best = met.groupBy("plat", "plon").agg(F.min_by(F.struct("node", "distance"), place).alias("hit"))
        best = best.select("plat", "plon", "hit.node", "hit.distance")
        extra: list[Column] = []
    else:
        w = Window.partitionBy("plat", "plon").orderBy(place)
        best = met.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
        extra = [F.col("rank")]
    out = points.join(
        spread(best),
        (F.col(lat).cast("double") == F.col("plat")) & (F.col(lon).cast("double") == F.col("plon")),
        "left",
    )
    added = [node_id, *[c for c in node_columns if c != node_id]]
    return out.select(
        *[points[c] for c in points.columns],
        *[F.col("node")[c].alias(c) for c in added],
        "distance",
        *extra,
    )


def nearest_layer(
    stations: DataFrame,
    layers: DataFrame,
    *,
    node: str = "node_id",
    depth: str = "depth",
    layer: str = "layer",
    z: str = "z",
    surface: Column | None = None,
) -> DataFrame:
    """Layer whose depth is closest to the station depth (z negative-down).

    ``surface`` marks rows that always take the topmost layer (largest z).
    """
    # The layers of a node become one short array, so that stations are not multiplied by them.
    packed = layers.filter(F.col(z).isNotNull()).groupBy(node).agg(F.collect_list(F.struct(layer, z)).alias("__l"))
    gap = F.array_min(F.transform("__l", lambda c: F.struct(F.abs(F.col(depth) + c[z]).alias("d"), c[layer].alias("l"), c[z].alias("z"))))
    top = F.array_max(F.transform("__l", lambda c: F.struct(c[z].alias("z"), (-c[layer]).alias("o"), c[layer].alias("l"))))
    near = F.when(F.col(depth).isNotNull(), F.struct(gap["l"].alias("l"), gap["z"].alias("z")))
    high = F.struct(top["l"].alias("l"), top["z"].alias("z"))
    use = near if surface is None else F.when(surface, high).otherwise(near)
    out = stations.join(packed, node, "left")
    return out.select(*stations.columns, use["l"].alias(layer), use["z"].alias(z))


def substring_match(
    stations: DataFrame, names: DataFrame, *, key: str, name: str, order: str
) -> DataFrame:
    """First model station (by ``order``) whose name contains the station id.

    Names are cut into the substrings that have the length of some id, and the
    substrings meet the ids in an equi-join; no pair of all ids and names.
    """
    # The distinct lengths of ids are few: one scalar array, exploded by each name.
    lengths = stations.agg(F.array_sort(F.collect_set(F.length(key)))).scalar()
    cut = F.explode(
        F.transform(
            F.sequence(F.lit(1), F.length(name) - F.col("len") + 1),
            lambda i: F.substr(F.col(name), i, F.col("len")),
        )
    )
    # Names are dealt out first: a small file of them would be cut in one task.
    grams = (
        names.select(name, order)
        .repartition(name)
        .withColumn("len", F.explode(lengths))
        .filter((F.col("len") > 0) & (F.length(name) >= F.col("len")))
        .select(cut.alias(key), order)
        .filter(F.col(order).isNotNull())
        .groupBy(key)
        .agg(F.min(order).alias(order))
    )
    # Only the least order of a substring is kept, a number that hashes; the name is looked up for ids that were met.
    met = stations.select(key).distinct().join(spread(grams), key)
    hits = (
        met.join(spread(names.select(name, order)), order)
        .filter(F.contains(F.col(name), F.col(key)))
        .groupBy(key)
        .agg(F.min(name).alias(f"matched_{name}"), F.min(order).alias(f"matched_{order}"))
    )
    return stations.join(spread(hits), key, "left").select(*stations.columns, f"matched_{name}", f"matched_{order}")


# -------------------------------------------------------------------- polygons


def ring_edges(rings: DataFrame, keys: Sequence[str], vertices: str = "vertices") -> DataFrame:
    """Edges of rings given as arrays of (x, y); unclosed rings are closed."""
    v = F.col(vertices)
    last = F.element_at(v, -1)
    closed = F.when(F.element_at(v, 1) == last, v).otherwise(F.concat(v, F.array(F.element_at(v, 1))))
    return (
        rings.select(*keys, closed.alias("__v"))
        .select(
            *keys,
            F.posexplode(
                F.transform(
                    F.sequence(F.lit(1), F.size("__v") - 1),
                    lambda i: F.struct(
                        F.element_at("__v", i).alias("a"), F.element_at("__v", i + 1).alias("b")
                    ),
                )
            ).alias("i", "e"),
        )
        .select(
            *keys,
            "i",
            F.col("e.a.x").alias("x1"),
            F.col("e.a.y").alias("y1"),
            F.col("e.b.x").alias("x2"),
            F.col("e.b.y").alias("y2"),
        )
    )


def points_in_polygons(
    points: DataFrame,
    edges: DataFrame,
    *,
    domain: str = "domain",
    ring: str = "ring",
    lat: str = "lat",
    lon: str = "lon",
    buffer_deg: float = 0.0,
) -> DataFrame:
    """(lat, lon, domain) for every distinct position inside a ring of a domain.

    Positions first meet rings in tiles as large as the ring's box, and only positions in
    the box go on; they meet its edges in latitude bands, as many as it has edges.  A
    position inside a ring crosses an odd number of edges to its east.  With a buffer,
    positions within that distance of an edge count as inside too.
    """
    y1, y2, x1, x2 = (F.col(c) for c in ("y1", "y2", "x1", "x2"))
    own = [domain, ring]
    boxes = edges.groupBy(*own).agg(
        (F.min(F.least(y1, y2)) - buffer_deg).alias("by0"),
        (F.max(F.greatest(y1, y2)) + buffer_deg).alias("by1"),
        (F.min(F.least(x1, x2)) - buffer_deg).alias("bx0"),
        (F.max(F.greatest(x1, x2)) + buffer_deg).alias("bx1"),
        F.least(F.count(F.lit(1)), F.lit(4096)).alias("bands"),
    )
    # Tiles of the power of two at or above the box: a box touches four at most.
    extent = F.greatest(F.col("by1") - F.col("by0"), F.col("bx1") - F.col("bx0"), F.lit(1e-6))
    boxes = boxes.withColumn("lev", F.ceil(F.log2(extent)).cast("int"))
    levels = boxes.agg(F.array_sort(F.collect_set("lev"))).scalar()
    side = F.pow(F.lit(2.0), F.col("lev"))

    def tiles(lo: str, hi: str, name: str) -> Column:
        return F.explode(F.sequence(F.floor(F.col(lo) / side), F.floor(F.col(hi) / side))).alias(name)

    tiled = boxes.select("*", tiles("by0", "by1", "ty")).select("*", tiles("bx0", "bx1", "tx"))
    spots = points.select(F.col(lat).alias("py"), F.col(lon).alias("px")).distinct()
    placed = spots.select("*", F.explode(levels).alias("lev")).select(
        "*", F.floor(F.col("py") / side).alias("ty"), F.floor(F.col("px") / side).alias("tx")
    )
    height = (F.col("by1") - F.col("by0")) / F.col("bands")

    def band(y: Column) -> Column:
        return F.least(F.coalesce(F.floor(F.try_divide(y - F.col("by0"), height)), F.lit(0).cast("bigint")), F.col("bands") - 1)

    inside_box = F.col("py").between(F.col("by0"), F.col("by1")) & F.col("px").between(F.col("bx0"), F.col("bx1"))
    near = placed.join(tiled, ["lev", "ty", "tx"]).filter(inside_box).select("py", "px", *own, band(F.col("py")).alias("band"))
    reach = F.sequence(band(F.least(y1, y2) - buffer_deg), band(F.greatest(y1, y2) + buffer_deg))
    banded = edges.select(*own, "x1", "y1", "x2", "y2").join(boxes.select(*own, "by0", "by1", "bands"), own).withColumn("band", F.explode(reach))
    px, py = F.col("px"), F.col("py")
    east = px < (x2 - x1) * F.try_divide(py - y1, y2 - y1) + x1
    crosses = ((y1 > py) != (y2 > py)) & F.coalesce(east, F.lit(False))
    if buffer_deg:
        run = (x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)
        along = F.coalesce(F.try_divide((px - x1) * (x2 - x1) + (py - y1) * (y2 - y1), run), F.lit(0.0))
        along = F.least(F.greatest(along, F.lit(0.0)), F.lit(1.0))
        gap = F.hypot(px - (x1 + along * (x2 - x1)), py - (y1 + along * (y2 - y1)))
        close = gap <= buffer_deg
    else:
        close = F.lit(False)
    hits = near.join(banded, [*own, "band"]).filter(crosses | close)
    rings = hits.groupBy("px", "py", domain, ring).agg(
        F.count_if(crosses).alias("n"), F.max(close).alias("close")
    )
    inside = rings.filter((F.col("n") % 2 == 1) | F.col("close"))
    return inside.select(F.col("py").alias(lat), F.col("px").alias(lon), domain).distinct()


def inside_domains(
    points: DataFrame, edges: DataFrame, *, lat: str = "lat", lon: str = "lon", **options
) -> DataFrame:
    """Point rows inside any domain of the edge table."""
    hit = points_in_polygons(points, edges, lat=lat, lon=lon, **options)
    return points.join(hit.select(lat, lon).distinct(), [lat, lon], "left_semi").select(*points.columns)


def inside_both(
    points: DataFrame, edges_a: DataFrame, edges_b: DataFrame, *, lat: str = "lat", lon: str = "lon"
) -> DataFrame:
    """Points inside both domains."""
    return inside_domains(inside_domains(points, edges_a, lat=lat, lon=lon), edges_b, lat=lat, lon=lon)


def overlapping(
    left: DataFrame, right: DataFrame, *, left_id: str, right_id: str, tile_deg: float = 1.0
) -> DataFrame:
    """Pairs of polygons (as edge tables) that overlap: crossing edges or containment."""

    def boxes(e: DataFrame) -> Column:
        x1, y1, x2, y2 = (F.col(c) for c in ("x1", "y1", "x2", "y2"))
        rows = F.sequence(F.floor(F.least(y1, y2) / tile_deg), F.floor(F.greatest(y1, y2) / tile_deg))
        return rows

    def tiled(e: DataFrame, pid: str, tag: str) -> DataFrame:
        x1, x2 = F.col("x1"), F.col("x2")
        cols = F.sequence(F.floor(F.least(x1, x2) / tile_deg), F.floor(F.greatest(x1, x2) / tile_deg))
        out = e.withColumn("ty", F.explode(boxes(e))).withColumn("tx", F.explode(cols))
        return out.select(
            "ty", "tx", F.col(pid).alias(tag), *[F.col(c).alias(f"{tag}_{c}") for c in ("x1", "y1", "x2", "y2")]
        )

    # Tiles are dealt out first: pairs are many times the edges that AQE would merge tasks by.
    a, b = (dealt(side, ["ty", "tx"]) for side in (tiled(left, left_id, "a"), tiled(right, right_id, "b")))

    def side(px: str, py: str, s: str) -> Column:
        return F.signum(
            (F.col(f"{s}_x2") - F.col(f"{s}_x1")) * (F.col(py) - F.col(f"{s}_y1"))
            - (F.col(f"{s}_y2") - F.col(f"{s}_y1")) * (F.col(px) - F.col(f"{s}_x1"))
        )

    crossing = (side("a_x1", "a_y1", "b") * side("a_x2", "a_y2", "b") < 0) & (
        side("b_x1", "b_y1", "a") * side("b_x2", "b_y2", "a") < 0
    )
    crossed = a.join(b, ["ty", "tx"]).filter(crossing).select(F.col("a").alias(left_id), F.col("b").alias(right_id))

    def contained(inner: DataFrame, inner_id: str, outer: DataFrame, outer_id: str) -> DataFrame:
        corner = inner.groupBy(inner_id).agg(F.min(F.struct("y1", "x1")).alias("p")).select(
            inner_id, F.col("p.y1").alias("lat"), F.col("p.x1").alias("lon")
        )
        outer = outer.select(F.col(outer_id).alias("__o"), F.lit(0).alias("ring"), "x1", "y1", "x2", "y2")
        hit = points_in_polygons(corner, outer, domain="__o")
        return corner.join(hit, ["lat", "lon"]).select(inner_id, F.col("__o").alias(outer_id))

    parts = crossed.unionByName(contained(left, left_id, right, right_id)).unionByName(
        contained(right, right_id, left, left_id)
    )
    return parts.distinct()


# ----------------------------------------------------------------------- grids


def regular_lattice(
    nodes: DataFrame, *, lat: str = "lat", lon: str = "lon", step: float = 0.01, margin: float = 0.25
) -> DataFrame:
    """Regular lat/lon grid over the padded bounding box, coordinates to 2 decimals."""
    box = nodes.agg(
        (F.round(F.min(lat), 2) - margin).alias("y0"),
        (F.round(F.max(lat), 2) + margin).alias("y1"),
        (F.round(F.min(lon), 2) - margin).alias("x0"),
        (F.round(F.max(lon), 2) + margin).alias("x1"),
    )

    def count(lo: str, hi: str) -> Column:
        # The upper end is open; the nudge absorbs representation error.
        return F.ceil((F.col(hi) - F.col(lo)) / step - 1e-9).cast("bigint") - 1

    rows = box.select(
        "*", F.explode(F.sequence(F.lit(0).cast("bigint"), count("y0", "y1"))).alias("iy")
    ).repartition("iy")
    cells = rows.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), count("x0", "x1"))).alias("ix"))
    return cells.select(
        "iy",
        "ix",
        F.round(F.col("y0") + F.col("iy") * step, 2).alias(lat),
        F.round(F.col("x0") + F.col("ix") * step, 2).alias(lon),
    )


def source_spacing_km(nodes: DataFrame, *, node_id: str, neighbours: int = 5) -> DataFrame:
    """One row: exact median distance to the nearest neighbours over all nodes."""
    from seamark.operators.quantiles import exact_percentiles

    near = nearest(nodes, nodes.withColumnRenamed(node_id, "__nb"), node_id="__nb", k=neighbours + 1)
    # One group, under a key that is no literal: joins on it stay equi-joins.
    everything = (F.col("distance") * 0).cast("int").alias("__all")
    gaps = near.filter(F.col("rank") > 1).select(everything, "distance")
    return exact_percentiles(gaps, ["__all"], "distance", [0.5]).select(F.col("q50").alias("spacing_km"))


def surrounded(around: Column) -> Column:
    """Whether the origin lies in the convex hull of the vectors (x, y) of an array, its border included.

    It lies outside when one of them has all others less than half a turn to its left, or in its own
    direction: then a line through the origin has all of them on one side.
    """

    def to_the_left(i: Column, j: Column) -> Column:
        cross = i["x"] * j["y"] - i["y"] * j["x"]
        return (cross > 0) | ((cross == 0) & (i["x"] * j["x"] + i["y"] * j["y"] > 0))

    return (F.size(around) > 0) & ~F.exists(around, lambda i: F.forall(around, lambda j: to_the_left(i, j)))


def idw_grid(
    targets: DataFrame,
    nodes: DataFrame,
    *,
    node_id: str,
    value: str,
    radius_km: float,
    target_keys: Sequence[str] = ("iy", "ix"),
    lat: str = "lat",
    lon: str = "lon",
) -> DataFrame:
    """Inverse-square-distance values at the targets, in two passes.

    First the 8 nearest nodes within the radius, for targets in their convex hull (in
    plane degrees, border included); what is left takes its 16 nearest nodes.  One
    search serves both.
    """
    nodes = nodes.filter(F.col(value).isNotNull()).select(node_id, lat, lon, value)
    nodes = nodes.withColumn("nlat_", F.col(lat)).withColumn("nlon_", F.col(lon))
    near = nearest(targets, nodes, node_id=node_id, node_columns=[value, "nlat_", "nlon_"], k=16, lat=lat, lon=lon)
    close = (F.col("rank") <= 8) & (F.col("distance") <= radius_km)
    distance, held = F.col("distance"), F.col(value)

    def blend(used: Column) -> Column:
        w = F.when(used & (distance > 0), 1 / (distance * distance))
        return F.coalesce(F.max(F.when(used & (distance == 0), held)), F.sum(w * held) / F.sum(w))

    toward = F.struct((F.col("nlon_") - F.col(lon)).alias("x"), (F.col("nlat_") - F.col(lat)).alias("y"))
    out = near.filter(F.col(node_id).isNotNull()).groupBy(*target_keys, lat, lon).agg(
        F.collect_list(F.when(close, toward)).alias("around_"), blend(close).alias("strict"), blend(F.lit(True)).alias("wide")
    ).withColumn("inside", surrounded(F.col("around_")))
    return out.select(
        *target_keys,
        lat,
        lon,
        F.when(F.col("inside"), F.col("strict")).otherwise(F.col("wide")).alias(value),
        F.when(F.col("inside"), 1).otherwise(2).alias("fill_pass"),
    )


def neighbour_weights(
    targets: DataFrame,
    nodes: DataFrame,
    *,
    node_id: str,
    radius_km: float,
    target_keys: Sequence[str] = ("iy", "ix"),
    resolution_km: float = 0.0,
    lat: str = "lat",
    lon: str = "lon",
) -> DataFrame:
    """(target keys, node, weight, fill_pass) of the two-pass inverse-square blend.

    One search serves any number of variables and times.  A node at the target's own
    position has all the weight.
    """
    nodes = nodes.select(node_id, lat, lon).withColumn("nlat_", F.col(lat)).withColumn("nlon_", F.col(lon))
    near = nearest(
        targets.select(*target_keys, lat, lon), nodes, node_id=node_id, node_columns=["nlat_", "nlon_"], k=16, resolution_km=resolution_km, lat=lat, lon=lon
    ).filter(F.col(node_id).isNotNull())
    at = Window.partitionBy(*target_keys)
    close = (F.col("rank") <= 8) & (F.col("distance") <= radius_km)
    toward = F.struct((F.col("nlon_") - F.col(lon)).alias("x"), (F.col("nlat_") - F.col(lat)).alias("y"))
    inside = surrounded(F.collect_list(F.when(close, toward)).over(at))
    here = F.max((F.col("distance") == 0).cast("int")).over(at) == 1
    weight = F.when(here, (F.col("distance") == 0).cast("double")).otherwise(1 / (F.col("distance") * F.col("distance")))
    marked = near.select(*target_keys, node_id, close.alias("close"), inside.alias("inside"), weight.alias("weight"))
    return marked.filter((~F.col("inside") | F.col("close")) & (F.col("weight") > 0)).select(
        *target_keys, node_id, "weight", F.when(F.col("inside"), 1).otherwise(2).alias("fill_pass")
    )
