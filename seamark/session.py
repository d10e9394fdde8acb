"""Session defaults for local work and tests; a cluster brings its own session."""

from __future__ import annotations

import tempfile
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("seamark")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def pin_utc(spark: SparkSession) -> SparkSession:
    """All clock arithmetic in this package assumes a UTC session."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def spread(df: DataFrame) -> DataFrame:
    """Side of a join that is sorted and merged, never sent whole to every executor.

    Spark's size estimates know neither how many rows an explode makes of one nor how long an
    array is, so a table of many times its source would be broadcast through the driver.
    """
    return df.hint("merge")


def dealt(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows shuffled by ``columns`` to as many tasks as the session has shuffle partitions.

    AQE merges partitions up to the same number of bytes read, whatever the task makes of them:
    with more input the tasks would grow first, and their number only after that.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *columns)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Checkpoint ``df`` in the folder that the session names in ``spark.checkpoint.dir``.

    A folder of this machine is made only where neither the session nor the context
    names one and driver and executors are one process (tests, laptops).
    """
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        shared = df.sparkSession.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
        if not shared and not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="seamark-ckpt-"))
    return df.checkpoint()
