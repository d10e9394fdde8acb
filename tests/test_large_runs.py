"""Runs and scores: tasks are not merged by bytes read, and runs alone need no steps."""

from pyspark.sql import functions as F

from seamark.operators import runs, scores

K = ["station_id"]


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def _pairs(spark):
    rows = spark.range(400).selectExpr(
        "id % 3 AS station_id", "timestamp_seconds(1704067200 + id * id * 60) AS ts", "CASE WHEN id % 10 < 4 THEN NULL ELSE 1.0D END AS obs", "1.5D AS model"
    )
    return rows.repartition(5)


def test_skill_rows_keep_their_tasks(spark):
    plan = _plan(scores.skill_scalar(_pairs(spark), K, x1=1.0))
    assert "REPARTITION_BY_NUM" in plan


def test_longest_gap_has_one_row_a_chunk(spark):
    df = _pairs(spark)
    out = runs.longest_gap(df, K, "ts", F.col("obs"))
    plan = _plan(out)
    assert "REPARTITION_BY_NUM" in plan and "__step" not in plan and "model" not in plan
    want = {}
    for r in df.orderBy("ts").collect():
        here, best = want.get(r.station_id, (0, 0))
        here = here + 1 if r.obs is None else 0
        want[r.station_id] = here, max(here, best)
    assert {r.station_id: (r.gap_rows, r.gap_pairs) for r in out.collect()} == {k: (b, max(b - 1, 0)) for k, (_, b) in want.items()}


def test_grid_is_generated_and_scanned_by_all_tasks(spark):
    from seamark.operators import fill, sequence

    df = _pairs(spark).select(*K, F.date_trunc("hour", "ts").alias("ts"), F.lit(1.0).alias("value")).groupBy(*K, "ts").agg(F.max("value").alias("value"))
    grid = sequence.time_grid(df, K, "ts", 3600)
    tasks = grid.select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks == int(spark.conf.get("spark.sql.shuffle.partitions"))
    for method in ("linear", "cubic"):
        assert "REPARTITION_BY_NUM" in _plan(fill.to_equal_interval(df, K, "ts", "value", step_seconds=3600, method=method))
