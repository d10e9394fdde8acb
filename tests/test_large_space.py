"""Nearest search: what an explode or arrays make large is merged, not sent through the driver."""

from seamark.operators import spatial


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_nearest_is_merged(spark):
    nodes = spark.range(200).selectExpr("id AS node_id", "30 + id % 20 * 0.01 AS lat", "-80 + floor(id / 20) * 0.01 AS lon")
    points = spark.range(10).selectExpr("id AS p", "30.001 + id * 0.011 AS lat", "-79.95 AS lon")
    out = spatial.nearest(points, nodes, node_id="node_id", k=3)
    assert "BroadcastExchange" not in _plan(out)
    assert out.count() == 30


def test_substrings_hash_and_take_the_first_name(spark):
    ids = spark.createDataFrame([("1",), ("12",), ("12",), ("9",), ("",), (None,)], "id string")
    names = spark.createDataFrame(
        [("a12", 5), ("b1", 7), ("b12", 3), ("b12", 3), ("x1", None), ("129", None), (None, 1)], "name string, place bigint"
    )
    out = spatial.substring_match(ids, names, key="id", name="name", order="place")
    assert "SortAggregate" not in _plan(out.select("id", "matched_place"))
    got = sorted(((r.id, r.matched_name, r.matched_place) for r in out.collect()), key=str)
    want = [("1", "b12", 3), ("12", "b12", 3), ("12", "b12", 3), ("9", None, None), ("", None, None), (None, None, None)]
    assert got == sorted(want, key=str)


def test_overlaps_are_dealt_out_by_tile(spark):
    def squares(name, side, step):
        at = spark.range(30).selectExpr(f"id AS {name}", "0 AS ring", f"id * {step} AS x", f"id % 3 * {step} AS y")
        corners = ", ".join(f"struct(x + {a} AS x, y + {b} AS y)" for a, b in [(0, 0), (side, 0), (side, side), (0, side)])
        return spatial.ring_edges(at.selectExpr(name, "ring", f"array({corners}) AS vertices"), [name, "ring"])

    out = spatial.overlapping(squares("a", 0.5, 0.31), squares("b", 0.7, 0.43), left_id="a", right_id="b")
    assert "REPARTITION_BY_NUM" in _plan(out)
    got = sorted((r.a, r.b) for r in out.collect())
    want = []
    for a in range(30):
        for b in range(30):
            ax, ay, bx, by = a * 0.31, a % 3 * 0.31, b * 0.43, b % 3 * 0.43
            if ax < bx + 0.7 and bx < ax + 0.5 and ay < by + 0.7 and by < ay + 0.5:
                want.append((a, b))
    assert got == want
