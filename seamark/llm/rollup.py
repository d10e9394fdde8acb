"""Token totals by source, language and tokenizer version, maintained by signed deltas.

A batch of changes holds documents that came (``insert``), left (``delete``) or were counted
anew (``revise``, with the count before). Each becomes a signed number of documents and tokens; the
batch is reduced to one row a (source, lang, version) and committed under its id. Totals are sums
of committed batches, so they never need the documents again.

A commit is one file, written whole under ``pending`` and then renamed to the batch's id if that is
free: whoever renames first has committed the batch, and a replay or a second writer of that id changes
nothing. A writer lost before the rename has committed nothing. The data a commit names was written
before; data that no commit names, and what is left under ``pending``, is ignored. ``compact`` adds the sums of the commits so far as a
snapshot, which lists the batches it holds.

Null sources, languages and versions are groups of their own; null counts are 0. Repeated rows
count as often as they occur. A group whose documents and tokens are all gone has no row.
Other columns are ignored.
"""

from __future__ import annotations

import json
import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEY = ["source", "lang", "version"]
SUMS = "source string, lang string, version string, n_docs long, n_tokens long"


def signed(changes: DataFrame) -> DataFrame:
    """Sums of a batch: ``changes`` has action, source, lang, version, n_tokens and old_tokens."""
    new, old = F.coalesce(F.col("n_tokens"), F.lit(0)), F.coalesce(F.col("old_tokens"), F.lit(0))
    action = F.col("action")
    docs = F.when(action == "insert", 1).when(action == "delete", -1).when(action == "revise", 0)
    tokens = F.when(action == "insert", new).when(action == "delete", -new).when(action == "revise", new - old)
    wrong = F.raise_error(F.concat(F.lit("unknown action "), F.coalesce(action, F.lit("null"))))
    return changes.groupBy(*KEY).agg(F.sum(F.coalesce(docs, wrong)).cast("long").alias("n_docs"), F.sum(F.coalesce(tokens, wrong.cast("long"))).cast("long").alias("n_tokens"))


class Rollup:
    """Committed batches under ``root``, a folder that driver and executors share."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark._jvm
        self.path = jvm.org.apache.hadoop.fs.Path
        self.fs = self.path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        at = self.path(f"{self.root}/{folder}")
        return sorted(s.getPath().getName() for s in self.fs.listStatus(at)) if self.fs.exists(at) else []

    def _create(self, name: str, content: dict) -> bool:
        """Publish a whole file under ``name``; False where that name is taken."""
        aside, target = self.path(f"{self.root}/pending/{uuid.uuid4().hex}"), self.path(f"{self.root}/{name}")
        out = self.fs.create(aside, False)
        out.write(bytearray(json.dumps(content).encode()))
        out.close()
        self.fs.mkdirs(target.getParent())
        try:
            self._rename(aside, target)
        except Py4JJavaError:
            if not self.fs.exists(target):
                raise
            self.fs.delete(aside, False)
            return False
        return True

    def _rename(self, source, target) -> None:
        """Rename, an error where the target exists."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        kind = getattr(hadoop, "Options$Rename")
        how = self.spark.sparkContext._gateway.new_array(kind, 1)
        how[0] = kind.NONE
        files = hadoop.FileContext.getFileContext(self.fs.getUri(), self.spark._jsc.hadoopConfiguration())
        files.rename(source, target, how)

    def _load(self, name: str) -> dict:
        at = self.path(f"{self.root}/{name}")
        stream = self.fs.open(at)
        try:
            return json.loads(bytes(self.spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)))
        finally:
            stream.close()

    def _data(self, sums: DataFrame) -> str:
        name = f"data/{uuid.uuid4().hex}"
        sums.write.parquet(f"{self.root}/{name}")
        return name

    def committed(self) -> list[str]:
        return self._names("commits")

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Add a batch; False, and nothing changes, where its id is committed already."""
        if not re.fullmatch(r"[A-Za-z0-9-]+", batch):
            raise ValueError(f"batch id {batch!r}")
        if self.fs.exists(self.path(f"{self.root}/commits/{batch}")):
            return False
        return self._create(f"commits/{batch}", {"data": self._data(signed(changes))})

    def _sums(self) -> tuple[DataFrame, list[str]]:
        batches = self.committed()
        snapshots = self._names("snapshots")
        last = self._load(f"snapshots/{snapshots[-1]}") if snapshots else {"data": None, "batches": []}
        rest = [b for b in batches if b not in set(last["batches"])]
        paths = [self._load(f"commits/{b}")["data"] for b in rest] + [last["data"]] * bool(last["data"])
        rows = self.spark.read.schema(SUMS).parquet(*[f"{self.root}/{p}" for p in paths]) if paths else self.spark.createDataFrame([], SUMS)
        return rows.groupBy(*KEY).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")), batches

    def totals(self) -> DataFrame:
        return self._sums()[0].filter("n_docs <> 0 OR n_tokens <> 0")

    def compact(self) -> bool:
        """Sum the commits so far into a snapshot."""
        sums, batches = self._sums()
        return self._create(f"snapshots/{len(self._names('snapshots')):08d}", {"data": self._data(sums), "batches": batches})


def by_version(docs: DataFrame, action: str, counts: dict[str, tuple[Column, Column | None]]) -> DataFrame:
    """Changes of ``docs`` under each tokenizer version: its count, and the one before if revised."""
    each = [F.struct(F.lit(v).alias("version"), n.cast("long").alias("n_tokens"), (F.lit(None) if old is None else old).cast("long").alias("old_tokens")) for v, (n, old) in counts.items()]
    return docs.select(F.lit(action).alias("action"), "source", "lang", F.explode(F.array(*each)).alias("c")).select("action", "source", "lang", "c.*")
