"""Joint frequency of current speed and direction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seamark.functions.angles import compass_sector


def speed_direction_table(
    df: DataFrame, speed: str, direction: str, keys: Sequence[str] = (), *, width: float = 0.25, sectors: int = 16
) -> DataFrame:
    """Counts and percentages per speed bin and compass sector.

    Bins are right-closed, so zero speed and zero direction fall outside.  The
    total runs over the table of counts, at most bins x sectors rows per key.
    """
    bin_no = F.when(F.col(speed) > 0, F.ceil(F.col(speed) / width))
    counted = (
        df.select(*keys, bin_no.alias("speed_bin"), compass_sector(F.col(direction), sectors).alias("sector"))
        .filter("speed_bin IS NOT NULL AND sector IS NOT NULL")
        .groupBy(*keys, "speed_bin", "sector")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    total = F.sum("n").over(Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0)))
    return counted.withColumn("percent", 100.0 * F.col("n") / total)
