"""Shared folder, written tables and column checks used by the operators of this package."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TASK_BYTES = 16 << 20
RUN_BYTES = 4 << 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only where neither the session nor the context names one and driver and executors are one
    process (tests, laptops) a temporary folder is made and kept for the life of the context.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    current = sc._jsc.sc().getCheckpointDir()
    if current.isEmpty():
        if not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="seamark-"))
        current = sc._jsc.sc().getCheckpointDir()
    return current.get().rstrip("/")


def fresh_dir(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/seamark-{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: lineage ends here, and a lost
    executor costs a reread. The folder is scratch, to be expired as checkpoints are."""
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def input_bytes(df: DataFrame) -> int:
    """Catalyst's estimate of the size of ``df``; reads nothing."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def task_count(df: DataFrame, bytes_per_task: int = TASK_BYTES, least: int = 1) -> int:
    """Tasks that keep each one's share near ``bytes_per_task``, never fewer than the session's shuffle partitions."""
    own = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, own, min(1 << 20, -(-input_bytes(df) // bytes_per_task)))


def runs(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """(first, one after the last) of stretches of rows of at most ``limit`` in all, or of one larger row."""
    total = np.concatenate([[0], np.cumsum(sizes)])
    at = 0
    while at < len(sizes):
        to = max(at + 1, int(np.searchsorted(total, total[at] + limit, "right")) - 1)
        yield at, to
        at = to


def with_columns_in_arrow(df: DataFrame, make: Callable[[pa.RecordBatch], dict[str, pa.Array]], new: dict[str, str], sized: str) -> DataFrame:
    """``df`` with the columns ``new`` (name to type) that ``make`` gives for a batch, in place of any
    that have their names. Batches are cut where the texts of column ``sized`` exceed ``RUN_BYTES``."""
    kept = [f for f in df.schema if f.name not in new]

    def run(batches):
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(sized)), 0).to_numpy(zero_copy_only=False)
            for a, b in runs(sizes, RUN_BYTES):
                part = batch.slice(a, b - a)
                columns = {f.name: part.column(f.name) for f in kept} | make(part)
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [f"`{c}` {t}" for c, t in new.items()]
    return df.mapInArrow(run, ", ".join(fields))


HOT_PARTS, HOT_ROWS = 1 << 10, 1000


def bounded_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """``left`` with the columns of ``right``, at most one row a key there, NULL where there is none.

    A key with more than ``HOT_ROWS`` rows and 1 / ``HOT_PARTS`` of ``left`` is hot. There are fewer than
    ``HOT_PARTS`` such keys, whatever the size, so their rows of ``right`` are broadcast; all other
    keys meet in a shuffle, where none can fill a task. ``left`` is read several times and should be a table.
    """
    rows = left.count()
    if rows <= HOT_ROWS:
        return left.join(right, key, "left")
    many = max(HOT_ROWS, rows // HOT_PARTS)
    some = left.filter(F.col(key).isNotNull())
    hot = F.broadcast(some.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > many).select(key))
    cold = some.join(hot, key, "left_anti").join(right, key, "left")
    hottest = some.join(hot, key, "left_semi").join(F.broadcast(right.join(hot, key, "left_semi")), key, "left")
    return cold.unionByName(hottest).unionByName(left.filter(F.col(key).isNull()), allowMissingColumns=True)
