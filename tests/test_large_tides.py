"""Tables of constants: what an explode or arrays make large is merged, not sent through the driver."""

from pyspark.sql import functions as F

from seamark.functions import tidal
from seamark.operators import tides

START = 1704067200


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _constants(spark):
    series = spark.range(5).select(F.col("id").alias("station_id"))
    rows = tidal.each_constituent(series).withColumn("amplitude", F.col("priority") / 10.0)
    return series, rows.withColumn("phase", (F.col("priority") * 7 % 360).cast("double"))


def test_constant_tables_are_merged(spark):
    series, rows = _constants(spark)
    keys = ["station_id"]
    times = series.select("station_id", F.timestamp_seconds(F.lit(START)).alias("ts"))
    tables = [
        tides.compare_constants(series, rows, rows, keys),
        tides.constituent_table(series, rows, keys, accepted=rows.filter("station_id = 1"), observed=rows),
        tides.ellipses(rows, rows, keys),
        tides.predict_from_constants(times, rows.select(*keys, "constituent", "amplitude"), rows.select(*keys, "constituent", "phase"), keys),
    ]
    for table in tables:
        assert "BroadcastExchange" not in _plan(table)
    assert tables[0].filter("vector_diff < 1e-6").count() == 5 * 37
    assert tables[2].count() == 5 * 37
