"""Load newly arrived series files and append skill rows exactly once."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from seamark.sinks.tables import insert_or_ignore
from seamark.sources import series_text


def series_stream(
    spark: SparkSession,
    path: str,
    columns: dict[str, int] = series_text.SCALAR,
    *,
    station_pattern: str = r"([^/_]+)_[^/]*$",
) -> DataFrame:
    """Rows of series files as they arrive; the station comes from the file name."""
    raw = spark.readStream.text(path)
    station = F.regexp_extract(F.col("_metadata.file_path"), station_pattern, 1)
    return series_text.parse_series(raw.select(station.alias("station_id"), "value"), columns, keep=("station_id",))


def append_new(
    rows: DataFrame,
    target: str,
    keys: Sequence[str],
    *,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame] = lambda df: df,
    day_of: str | None = None,
    seq: str | None = None,
) -> StreamingQuery:
    """Append rows whose key the Parquet table lacks.

    A batch that is run again after a failure finds its own rows already there
    and adds nothing.  With ``day_of``, a time column of the key, the table is partitioned by
    its day and a batch reads only the days it holds.  ``seq`` orders rows of one key within
    a batch; the first is kept.
    """

    def write(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        new = transform(batch)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        table = spark.read.parquet(target) if fs.exists(path) else new.limit(0)
        if day_of is not None:
            new = new.withColumn("day", F.to_date(day_of))
            days = [r["day"] for r in new.select("day").distinct().collect()]
            table = table.filter(F.col("day").isin(days)) if "day" in table.columns else table
        new = insert_or_ignore(table, new, keys, seq)
        writer = new.write.mode("append")
        (writer.partitionBy("day") if day_of is not None else writer).parquet(target)

    return (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
