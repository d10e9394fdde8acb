"""Similarity join of documents on sets of word five-grams: Jaccard of ``THRESHOLD`` or more.

1. Every text becomes the set of its five-grams (a text of one to four words has one
   shingle, all its words; an empty text has none and no links). Texts with equal sets are
   one class, so copies cost one aggregate row whatever their number.
2. ``bands_for`` picks the most rows a band, within ``MOST_HASHES`` MinHash values, for which a
   pair at the threshold shares a band with ``RECALL``. Classes shuffle on their band hashes;
   buckets of two or more are candidates. A bucket larger than ``BLOCK`` is dealt into
   blocks, and every pair of blocks is a group of its own.
3. In a group, pairs whose MinHash values agree to less than ``ESTIMATE`` are let go (four
   standard deviations below the threshold). Of the others only a spanning forest leaves the
   task; its components are small sets of truly similar texts.
4. The full shingle sets travel once by component (once a pair of blocks if it is large) and
   every estimated pair is verified exactly by matrix products over shared shingles. Link
   counts and again a spanning forest leave the task, never the pairs.

A document's links are all other documents of Jaccard at or above the threshold, copies
included; its class_id is the smallest doc_id of the documents reached over links.

Rows are documents; of rows that share a doc_id each has a row in the result. Rows without
doc_id count as links of others and get a class_id where some linked document has an id.
Shingles are known by 64-bit hashes of their words as they stand. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seamark.llm import words as W
from seamark.llm.common import written
from seamark.llm.graphs import components
from seamark.llm.words import U

GRAM_WORDS = 5
THRESHOLD = 0.8
RECALL = 0.999
MOST_HASHES = 128
ESTIMATE = 0.64
BLOCK = 1024
TILE = 512


def bands_for(threshold: float = THRESHOLD, recall: float = RECALL, most: int = MOST_HASHES) -> tuple[int, int]:
    """(bands, rows): most rows a band, then fewest bands, that find a pair at the threshold with ``recall``."""
    for rows in range(most, 0, -1):
        bands = int(np.ceil(np.log(1 - recall) / np.log1p(-(threshold**rows))))
        if bands * rows <= most:
            return bands, rows
    return most, 1


BANDS, ROWS = bands_for()
HASHES = BANDS * ROWS
_rng = np.random.default_rng(11)
FLIP = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint32)
TIMES = _rng.integers(0, 1 << 31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def shingle_sets(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each row, sorted, and the offsets of the rows."""
    w = W.Words(data, off)
    hashes = W.Hasher(data).spans(w.start, w.end)
    long, at = W.grams(hashes, w.at, GRAM_WORDS)
    sets = []
    for i, n in enumerate(w.count):
        if n >= GRAM_WORDS:
            sets.append(np.unique(long[at[i] : at[i + 1]]))
        elif n:
            sets.append(W.mix((hashes[w.at[i] : w.at[i + 1]] * W.GRAM[:n]).sum(dtype=U, keepdims=True) + U(n)))
        else:
            sets.append(long[:0])
    to = np.zeros(len(sets) + 1, np.int64)
    np.cumsum([len(s) for s in sets], out=to[1:])
    return np.concatenate(sets) if sets else long[:0], to


def row_sums(values: np.ndarray, to: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, U)
    np.cumsum(values, dtype=U, out=total[1:])
    return total[to[1:]] - total[to[:-1]]


def minhashes(shingles: np.ndarray, to: np.ndarray) -> np.ndarray:
    """``HASHES`` values of each row; rows without shingles hold zeros."""
    out = np.zeros((len(to) - 1, HASHES), "<u4")
    some = np.flatnonzero(to[:-1] < to[1:])
    if len(some):
        short = (shingles >> U(32)).astype(np.uint32)
        for k in range(HASHES):
            out[some, k] = np.minimum.reduceat((short ^ FLIP[k]) * TIMES[k], to[some])
    return out


def signatures(docs: DataFrame, carried: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, h1, h2, n, sig) and the long columns ``carried``: two sums that name the shingle set, its size and MinHash values."""

    def run(batches):
        for batch in batches:
            ids = batch.column("doc_id").cast(pa.int64())
            for a, b, data, off in W.blocks(batch.column("text")):
                shingles, to = shingle_sets(data, off)
                raw = minhashes(shingles, to).tobytes()
                width = 4 * HASHES
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(a, b - a),
                        pa.array(row_sums(shingles, to).view(np.int64)),
                        pa.array(row_sums(W.mix(shingles ^ U(0xA5A5A5A5)), to).view(np.int64)),
                        pa.array(np.diff(to)),
                        pa.array([raw[i : i + width] for i in range(0, len(raw), width)], pa.binary()),
                        *(batch.column(c).slice(a, b - a) for c in carried),
                    ],
                    ["doc_id", "h1", "h2", "n", "sig", *carried],
                )

    return docs.select("doc_id", "text", *carried).mapInArrow(run, ", ".join(["doc_id long, h1 long, h2 long, n long, sig binary", *(f"{c} long" for c in carried)]))


def sharing(classes: DataFrame) -> DataFrame:
    """(h1, bucket, m): classes by the band buckets they share with others, and the bucket's size."""
    band = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda k: F.xxhash64(k, F.substring("sig", k * (4 * ROWS) + 1, F.lit(4 * ROWS))))
    members = classes.select("h1", F.explode(band).alias("bucket"))
    crowded = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    return members.join(crowded, "bucket")


def dealt(rows: DataFrame) -> DataFrame:
    """Rows of a group of ``m`` dealt to pairs of blocks (lo, hi) of about ``BLOCK`` rows; ``block`` is the row's own."""
    blocks = F.ceil(F.col("m") / BLOCK)
    own = rows.withColumn("block", F.pmod(F.xxhash64("h1", F.lit(5)), blocks).cast("int"))
    paired = own.withColumn("other", F.explode(F.sequence(F.lit(0), (blocks - 1).cast("int"))))
    return paired.withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other")).drop("other", "m")


class Forest:
    """Union-find over the rows of one group."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i

    def join(self, linked: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> None:
        """Unite rows and columns of a matrix of links."""
        if not linked.any():
            return
        nodes = np.concatenate([rows, columns])
        label = np.arange(len(nodes))
        r, c = label[: len(rows)], label[len(rows) :]
        far = len(nodes)
        while True:
            new_c = np.minimum(c, np.where(linked, r[:, None], far).min(axis=0))
            new_r = np.minimum(r, np.where(linked, new_c[None, :], far).min(axis=1))
            if (new_c == c).all() and (new_r == r).all():
                break
            r, c = new_r, new_c
        for i, k in enumerate(np.concatenate([r, c])):
            a, b = self.root(nodes[i]), self.root(nodes[k])
            if a != b:
                self.up[max(a, b)] = min(a, b)


def tiles(block: np.ndarray, lo: int, hi: int):
    """Row and column numbers of the tiles that hold each pair of a group once; a tile on the
    diagonal holds its own pairs twice."""
    first, second = np.flatnonzero(block == lo), np.flatnonzero(block == hi)
    cut = lambda x: [x[i : i + TILE] for i in range(0, len(x), TILE)]
    for i, rows in enumerate(cut(first)):
        for j, columns in enumerate(cut(second)):
            if lo != hi or i <= j:
                yield rows, columns


def alike(sig: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Pairs whose MinHash values agree to ``ESTIMATE`` or more; a row is not alike to itself."""
    agree = np.zeros((len(rows), len(columns)), np.int16)
    a, b = np.ascontiguousarray(sig[rows].T), np.ascontiguousarray(sig[columns].T)
    for x, y in zip(a, b):
        agree += x[:, None] == y[None, :]
    return (agree >= ESTIMATE * HASHES) & (rows[:, None] != columns[None, :])


def distinct_rows(table: pa.Table) -> pa.Table:
    return table.take(pa.array(np.unique(np.asarray(table["h1"]), return_index=True)[1]))


def likely(table: pa.Table) -> pa.Table:
    """A forest over the estimated pairs of one group of a bucket."""
    h1, block = np.asarray(table["h1"]), np.asarray(table["block"])
    sig = np.frombuffer(b"".join(table["sig"].to_pylist()), "<u4").reshape(-1, HASHES)
    forest = Forest(len(h1))
    for rows, columns in tiles(block, table["lo"][0].as_py(), table["hi"][0].as_py()):
        forest.join(alike(sig, rows, columns), rows, columns)
    root = np.array([forest.root(i) for i in range(len(h1))], np.int64)
    moved = root != np.arange(len(h1))
    return pa.table({"a": h1[moved], "b": h1[root[moved]]})


def shared_counts(sets: list[np.ndarray], rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of row and column sets."""
    which = np.concatenate([rows, columns])
    place = np.repeat(np.arange(len(which)), [len(sets[i]) for i in which])
    _, code, times = np.unique(np.concatenate([sets[i] for i in which]), return_inverse=True, return_counts=True)
    common = times > 1
    code = np.where(common, np.cumsum(common) - 1, -1)[code]
    out = np.zeros((len(rows), len(columns)), np.float32)
    for at in range(0, int(common.sum()), 2048):
        here = (code >= at) & (code < at + 2048)
        held = np.zeros((len(which), 2048), np.float32)
        held[place[here], code[here] - at] = 1
        out += held[: len(rows)] @ held[len(rows) :].T
    return out


def verified(table: pa.Table) -> pa.Table:
    """Links of one group of a component: by class, the linked documents and a forest."""
    table = distinct_rows(table)
    h1, block, size = (np.asarray(table[c]) for c in ("h1", "block", "size"))
    sig = np.frombuffer(b"".join(table["sig"].to_pylist()), "<u4").reshape(-1, HASHES)
    sets = [np.frombuffer(s, "<u8") for s in table["shingles"].to_pylist()]
    n = np.array([len(s) for s in sets])
    links = np.zeros(len(h1), np.int64)
    forest = Forest(len(h1))
    for rows, columns in tiles(block, table["lo"][0].as_py(), table["hi"][0].as_py()):
        near = alike(sig, rows, columns)
        if not near.any():
            continue
        both = shared_counts(sets, rows, columns).astype(np.int64)
        near &= both / (n[rows][:, None] + n[columns][None, :] - both) >= THRESHOLD
        links[rows] += near @ size[columns]
        if rows[0] != columns[0]:
            links[columns] += size[rows] @ near
        forest.join(near, rows, columns)
    root = np.array([forest.root(i) for i in range(len(h1))], np.int64)
    some = links > 0
    return pa.table({"h1": h1[some], "links": links[some], "root": h1[root[some]]})


def class_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(h1, comp, m, size, sig, shingles) of each wanted class, from the text of its representative."""

    def run(batches):
        for batch in batches:
            want = np.asarray(batch.column("h1"))
            for a, b, data, off in W.blocks(batch.column("text")):
                shingles, to = shingle_sets(data, off)
                right = np.flatnonzero(row_sums(shingles, to).view(np.int64) == want[a:b])
                part = batch.slice(a, b - a).take(pa.array(right))
                sets = pa.array([shingles[to[i] : to[i + 1]].tobytes() for i in right], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(c) for c in ("h1", "comp", "m", "size", "sig")] + [sets], ["h1", "comp", "m", "size", "sig", "shingles"])

    texts = docs.select(F.col("doc_id").alias("id"), "text")
    joined = texts.join(wanted, texts["id"].eqNullSafe(wanted["rep"])).select("text", "h1", "comp", "m", "size", "sig")
    return joined.mapInArrow(run, "h1 long, comp long, m long, size long, sig binary, shingles binary")


def marked(docs: DataFrame, carried: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, root, class_id, n_links) and ``carried`` of every row of ``docs``; root names the class,
    also where classes share doc_ids, and is NULL for rows without shingles."""
    sigs = written(signatures(docs, carried), "signatures")
    classes = written(sigs.filter("n > 0").groupBy("h1", "h2", "n", "sig").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("size")).drop("h2", "n"), "classes")
    buckets = dealt(sharing(classes)).join(classes.select("h1", "sig"), "h1")
    near = components(buckets.groupBy("bucket", "lo", "hi").applyInArrow(likely, "a long, b long"))
    comp = near.select(F.col("a").alias("h1"), F.col("b").alias("comp")).unionByName(near.select(F.col("b").alias("h1"), F.col("b").alias("comp")).distinct())
    sized = comp.join(comp.groupBy("comp").agg(F.count(F.lit(1)).alias("m")), "comp")
    groups = dealt(class_sets(docs, sized.join(classes, "h1")))
    found = written(groups.groupBy("comp", "lo", "hi").applyInArrow(verified, "h1 long, links long, root long"), "links")
    root = components(found.select(F.col("h1").alias("a"), F.col("root").alias("b"))).select(F.col("a").alias("h1"), F.col("b").alias("root"))
    links = found.groupBy("h1").agg(F.sum("links").alias("links"))
    known = classes.drop("sig").join(links, "h1", "left").join(root, "h1", "left").withColumn("root", F.coalesce("root", "h1"))
    ids = known.groupBy("root").agg(F.min("rep").alias("class_id"))
    known = known.join(ids, "root").select("h1", "root", "class_id", (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    rows = sigs.select("doc_id", *carried, F.when(F.col("n") > 0, F.col("h1")).alias("h1"))
    return rows.join(known, "h1", "left").select("doc_id", *carried, "root", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def similar(docs: DataFrame) -> DataFrame:
    """(doc_id, class_id, n_links) of every row of ``docs``."""
    return marked(docs).select("doc_id", "class_id", "n_links")


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay when each class keeps the row of its smallest doc_id.

    Rows without doc_id stay. Rows are known by doc_id and text, so texts that share a doc_id but
    no class each stay; where rows of a class share its smallest doc_id, the one whose text has the
    smallest hash stays, and of repeated rows one. Texts without shingles are classes of their own.
    """

    def free(name: str) -> str:
        while name in docs.columns:
            name += "_"
        return name

    digest, turn = free("digest"), free("turn")
    named = docs.filter("doc_id IS NOT NULL").withColumn(digest, F.xxhash64(F.coalesce("text", F.lit(""))))
    every = docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("digest"))
    least = marked(every, ("digest",)).filter("doc_id = class_id").groupBy("root", "doc_id", F.when(F.col("root").isNull(), F.col("digest")).alias("alone"))
    stay = least.agg(F.min("digest").alias("d")).select(F.col("doc_id").alias("id"), "d")
    first = Window.partitionBy("doc_id", digest).orderBy(F.lit(0))
    kept = named.join(stay, (named["doc_id"] == stay["id"]) & (named[digest] == stay["d"]), "left_semi").withColumn(turn, F.row_number().over(first)).filter(F.col(turn) == 1).drop(turn, digest)
    return kept.unionByName(docs.filter("doc_id IS NULL"))
