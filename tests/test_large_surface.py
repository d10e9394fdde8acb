"""Surface products: what an explode or arrays make large is merged, not sent through the driver."""

from seamark.operators import grids

START = 1704067200


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_surface_products_broadcast_few_weights_only(spark, monkeypatch):
    nodes = spark.range(40).selectExpr("id AS node_id", "id % 8 * 0.05 AS lat", "floor(id / 8) * 0.05 AS lon", "1 AS wet")
    values = nodes.selectExpr("node_id", "explode(sequence(0, 2)) AS id").selectExpr(
        "node_id", "0 AS layer", f"timestamp_seconds({START} + id * 3600) AS ts", "'sst' AS var", "node_id + id * 1.0 AS value"
    )
    targets = spark.range(6).selectExpr("id AS iy", "0 AS ix", "0.02 + id * 0.03 AS lat", "0.11 AS lon")

    def run():
        out = grids.surface_products(values, nodes, targets, radius_km=20.0, variables=["sst"])
        return _plan(out), sorted((r.iy, r.ts, round(r.sst, 9)) for r in out.collect())

    few_plan, few = run()
    # The side that is sent is the weights, however small the values are estimated.
    assert "BuildRight" in few_plan and "BuildLeft" not in few_plan
    monkeypatch.setattr(grids, "FEW_WEIGHTS", 0)
    many_plan, many = run()
    assert "BroadcastExchange" not in many_plan
    assert few == many and len(few) == 18
