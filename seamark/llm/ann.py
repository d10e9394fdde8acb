"""Nearest neighbours by inner product over a hierarchical k-means tree.

Equal vectors are one point that keeps its ``TOP + 1`` smallest vec_ids: no other copy can be among
the ``TOP`` nearest of any row. Largest inner product becomes smallest distance with one more
coordinate, ``sqrt(largest norm ** 2 - norm ** 2)``.

The tree is fitted on at most ``FIT_POINTS`` points (the smallest by hash), with leaves for about
``LEAF_POINTS`` points each and ``FIT_POINTS // 8`` leaves at most; every point is then assigned to a leaf. A query
pops nodes from a priority queue by distance to their centre and visits leaves in that order
(best bin first). How many is calibrated: for ``TRIAL`` queries the exact neighbours over all points
are found, and visits widen until ``RECALL`` of them lie in visited leaves.

Points and queries meet by leaf. A leaf of more than ``BLOCK`` points is dealt into blocks,
and a block's queries into batches, so that a group is one bounded matrix product in double
precision on the original vectors. Only the best of each leave it.

Rows that have no vec_id, or whose vector is null, zero, of another length than most, or holds a
null or non-finite component, take no part. Repeated rows of one vec_id and vector count once.
A query finds all candidates where there are no more than ``TOP``. Other columns are ignored.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seamark.llm.common import written

TOP = 20
FIT_POINTS, LEAF_POINTS = 1 << 15, 256
BRANCHES, ROUNDS = 16, 8
TRIAL, RECALL = 200, 0.97
BLOCK, BATCH = 4096, 2048
ENOUGH = 4 * TOP


def usable(vectors: DataFrame) -> DataFrame:
    """Distinct (vec_id, v) that take part, v in doubles."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v")).filter("vec_id IS NOT NULL AND v IS NOT NULL")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(finite & F.exists("v", lambda x: x != 0))
    most = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.filter(F.size("v") == (most["d"] if most else 0)).distinct()


def points(rows: DataFrame) -> DataFrame:
    """(v, ids, key): distinct vectors with their smallest vec_ids, in order."""
    turn = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    kept = rows.withColumn("turn", turn).filter(F.col("turn") <= TOP + 1)
    return kept.groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")).withColumn("key", F.xxhash64("v"))


def matrix(column: pa.Array) -> np.ndarray:
    n = len(column)
    flat = np.asarray(column.flatten())
    return flat.reshape(n, -1) if n else np.zeros((0, 1))


@dataclass
class Tree:
    """Nodes hold the centres of their children; a child is a node, or a leaf if negative."""

    most: float
    centres: list[np.ndarray] = field(default_factory=list)
    children: list[list[int]] = field(default_factory=list)
    leaves: int = 0

    def lifted(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.most - (x * x).sum(axis=1), 0))
        return np.hstack([x, rest[:, None]])

    def grow(self, x: np.ndarray, leaf_points: float, rng: np.random.Generator) -> int:
        k = int(min(BRANCHES, np.ceil(len(x) / leaf_points)))
        centres, own = k_means(x, k, rng) if k > 1 else (x[:1], None)
        if len(centres) < 2:
            self.leaves += 1
            return -self.leaves
        at = len(self.centres)
        self.centres.append(centres)
        self.children.append([])
        for c in range(len(centres)):
            self.children[at].append(self.grow(x[own == c], leaf_points, rng))
        return at

    def assign(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each row of lifted points."""
        out = np.zeros(len(x), np.int32)
        todo = [(0, np.arange(len(x)))] if self.centres else []
        while todo:
            node, rows = todo.pop()
            own = nearest(x[rows], self.centres[node])
            for c, child in enumerate(self.children[node]):
                part = rows[own == c]
                if child < 0:
                    out[part] = -child - 1
                elif len(part):
                    todo.append((child, part))
        return out

    def visits(self, q: np.ndarray, least: int, sizes: np.ndarray, enough: int = ENOUGH) -> list[int]:
        """Leaves in best-bin-first order: ``least`` of them, and more until they hold ``enough`` points."""
        if not self.centres:
            return [0]
        out, held = [], 0
        queue = [(0.0, 0)]
        while queue and (len(out) < least or held < enough):
            _, node = heapq.heappop(queue)
            if node < 0:
                out.append(-node - 1)
                held += sizes[-node - 1]
                continue
            gap = self.centres[node] - q
            for d, child in zip(np.einsum("ij,ij->i", gap, gap).tolist(), self.children[node]):
                heapq.heappush(queue, (d, child))
        return out


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres * centres).sum(axis=1) - 2 * x @ centres.T).argmin(axis=1)


def k_means(x: np.ndarray, k: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    centres = x[rng.choice(len(x), k, replace=False)]
    for _ in range(ROUNDS):
        own = nearest(x, centres)
        n = np.bincount(own, minlength=len(centres))
        pick = np.zeros((len(centres), len(x)))
        pick[own, np.arange(len(x))] = 1
        centres = (pick @ x)[n > 0] / n[n > 0][:, None]
    return centres, nearest(x, centres)


def fit(found: DataFrame, n: int) -> Tree:
    most = found.agg(F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))).first()[0] or 0.0
    tree = Tree(most)
    sample = np.array([r["v"] for r in found.select("key", "v").orderBy("key").limit(FIT_POINTS).select("v").toLocalIterator()])
    leaves = min(FIT_POINTS // 8, -(-n // LEAF_POINTS))
    if len(sample) and leaves > 1:
        tree.grow(tree.lifted(sample), len(sample) / leaves, np.random.default_rng(1))
    tree.leaves = max(1, tree.leaves)
    return tree


def with_leaf(found: DataFrame, tree: Tree) -> DataFrame:
    shared = found.sparkSession.sparkContext.broadcast(tree)

    def run(batches):
        for batch in batches:
            x = shared.value.lifted(matrix(batch.column("v"))) if batch.num_rows else np.zeros((0, 1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shared.value.assign(x), pa.int32())], [*batch.schema.names, "leaf"])

    return found.select("key", "v", "ids").mapInArrow(run, "key long, v array<double>, ids array<long>, leaf int")


def best(q: np.ndarray, x: np.ndarray, ids: pa.Array, top: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(point, vec_id, score) of the ``top`` best of each query, ties to smaller vec_id."""
    product = q @ x.T
    first = np.array([i[0] for i in ids.to_pylist()])
    flat, count = np.asarray(ids.flatten()), np.diff(np.asarray(ids.offsets))
    start = np.asarray(ids.offsets)[:-1] - ids.offsets[0].as_py()
    out = []
    for s in product:
        near = np.arange(len(s))
        if len(s) > top:
            near = np.flatnonzero(s >= np.partition(s, len(s) - top)[len(s) - top])
        near = near[np.lexsort([first[near], -s[near]])][:top]
        point = np.repeat(near, count[near])
        vec = np.concatenate([flat[start[i] : start[i] + count[i]] for i in near])
        order = np.lexsort([vec, -s[point]])[:top]
        out.append((point[order], vec[order], s[point][order]))
    return out


def true_leaves(placed: DataFrame, trial: np.ndarray) -> np.ndarray:
    """Leaves of the exact ``TOP + 1`` best of each trial query, over all points."""
    shared = placed.sparkSession.sparkContext.broadcast(trial)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                leaf = np.asarray(part.column("leaf"))
                found = best(shared.value, matrix(part.column("v")), part.column("ids"), TOP + 1)
                query = np.repeat(np.arange(len(found)), [len(f[0]) for f in found])
                point, vec, s = (np.concatenate(x) for x in zip(*found))
                yield pa.RecordBatch.from_arrays([pa.array(query), pa.array(vec), pa.array(leaf[point]), pa.array(s)], ["query", "vec", "leaf", "s"])

    turn = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("s"), "vec"))
    rows = placed.select("v", "ids", "leaf").mapInArrow(run, "query long, vec long, leaf int, s double")
    return rows.withColumn("turn", turn).filter(F.col("turn") <= TOP + 1).select("query", "leaf").toPandas().to_numpy()


def calibrate(placed: DataFrame, queries: DataFrame, tree: Tree, sizes: np.ndarray) -> int:
    """Fewest leaf visits that reach ``RECALL`` on the trial queries."""
    trial = np.array([r["v"] for r in queries.orderBy("key").limit(TRIAL).select("v").collect()])
    if not len(trial) or tree.leaves == 1:
        return 1
    place = np.zeros((len(trial), tree.leaves), np.int64)
    flat = np.hstack([trial, np.zeros((len(trial), 1))])
    for i, q in enumerate(flat):
        order = tree.visits(q, tree.leaves, sizes, 0)
        place[i, order] = np.arange(len(order))
    true = true_leaves(placed, trial)
    depth = np.sort(place[true[:, 0], true[:, 1]])
    return int(depth[int(np.ceil(RECALL * len(depth))) - 1]) + 1


def search(vectors: DataFrame) -> DataFrame:
    """(query_id, rank, vec_id, score) of every row whose vec_id is divisible by 20."""
    spark = vectors.sparkSession
    rows = written(usable(vectors), "vectors")
    found = written(points(rows), "points")
    n = found.count()
    tree = fit(found, n)
    placed = written(with_leaf(found, tree), "leaves")
    sizes = np.zeros(tree.leaves, np.int64)
    for r in placed.groupBy("leaf").count().collect():
        sizes[r["leaf"]] = r["count"]
    asking = rows.filter("vec_id % 20 = 0").select("vec_id", F.xxhash64("v").alias("key"), "v")
    queries = asking.select("key", "v").distinct()
    least = calibrate(placed, queries, tree, sizes)
    shared = spark.sparkContext.broadcast((tree, sizes, least))

    def route(batches):
        tree, sizes, least = shared.value
        for batch in batches:
            q = matrix(batch.column("v"))
            leaves = [tree.visits(np.append(x, 0.0), least, sizes) for x in q] if batch.num_rows else []
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaves, pa.list_(pa.int32()))], ["key", "v", "leaves"])

    blocks = F.array(*[F.lit(int(b)) for b in np.maximum(1, -(-sizes // BLOCK))])
    block_of = F.get(blocks, F.col("leaf"))
    held = placed.withColumn("block", F.pmod(F.xxhash64("key", F.lit(3)), block_of).cast("int"))
    routed = queries.mapInArrow(route, "key long, v array<double>, leaves array<int>").select("key", "v", F.explode("leaves").alias("leaf"))
    asked = routed.withColumn("block", F.explode(F.sequence(F.lit(0), block_of - 1)))

    def meet(q: pa.Table, x: pa.Table) -> pa.Table:
        out = ([], [], [])
        if q.num_rows and x.num_rows:
            x = x.combine_chunks()
            vectors, ids = matrix(x["v"].combine_chunks()), x["ids"].combine_chunks()
            for at in range(0, q.num_rows, BATCH):
                part = q.slice(at, BATCH)
                for key, (_, vec, s) in zip(part["key"].to_pylist(), best(matrix(part["v"].combine_chunks()), vectors, ids, TOP + 1)):
                    for column, value in zip(out, (key, vec, -s)):
                        column.append(value)
        return pa.table([pa.array(out[0], pa.int64()), pa.array(out[1], pa.list_(pa.int64())), pa.array(out[2], pa.list_(pa.float64()))], ["key", "vec", "neg"])

    met = asked.groupBy("leaf", "block").cogroup(held.select("leaf", "block", "v", "ids").groupBy("leaf", "block")).applyInArrow(meet, "key long, vec array<long>, neg array<double>")
    ranked = met.groupBy("key").agg(F.flatten(F.collect_list(F.arrays_zip("neg", "vec"))).alias("near"))
    ranked = ranked.select("key", F.slice(F.array_sort("near"), 1, TOP + 1).alias("near"))
    own = asking.select(F.col("vec_id").alias("query_id"), "key").join(ranked, "key")
    near = own.withColumn("near", F.slice(F.filter("near", lambda x: x["vec"] != F.col("query_id")), 1, TOP))
    return near.select("query_id", F.posexplode("near").alias("at", "x")).select("query_id", (F.col("at") + 1).alias("rank"), F.col("x.vec").alias("vec_id"), (-F.col("x.neg")).alias("score"))
