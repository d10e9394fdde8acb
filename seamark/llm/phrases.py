"""Phrase collocations mined with an FM-index per shard of word ids.

Texts are lower-cased (A-Z), split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and those into words
``[^\\x20\\x09]+``. All counts are per language. A phrase of 2 to ``LONGEST`` words with ``LEAST`` or more
occurrences inside pieces is a candidate. Cut after its first k words it scores
``floor(1000 a n / (l r))``, where a, l and r are the counts of the phrase, its first k words and the rest, and n is
the number of words; the lowest cut counts, the smallest k of equal ones. A candidate goes if a
candidate one word longer that holds it has ``COVER`` percent of its occurrences; as counts
do not grow with length, this covers all longer ones.

1. Tasks deal the texts into shards: word ids of one language, 0 between pieces, with
   the words spelt out, about ``SHARD_WORDS`` ids each (``shards``, a written table).
2. In the FM-index of each shard the interval of every word is extended to the left by every word
   before it; words and pairs travel as arrays of hashes with counts to buckets of the hash range, are
   summed there across shards, and the sums of ``LEAST`` or more go back to the shards that asked.
3. Each shard cuts its pieces where a pair is not frequent, as no candidate spans such a place, and builds
   a bidirectional index of what is left. Intervals in the text and in its reverse are kept in step
   and extended in turn, to the right to two words, to the left to three, to the right to four, to
   the left to five. Counts of three words and more are summed as before.
4. The first shard that holds a candidate finds it in its ids by hash and spells it out. All
   parts of a candidate are frequent and occur where it does, so their sums have come back as well.

A shard, a bucket of the hash range and the answers to one shard are the largest things that a task holds; a piece
of any length stays in one shard. No word, phrase or language fills a task by its frequency: every
shard names it once. Hashes have 64 bits: two phrases share one with a chance of 2**-64 a pair. Scores are
Python integers.

Edge cases: null and empty texts have no words; a null lang is ``und``. Every row counts, repeated ones
too. Other columns are ignored. An empty table, or one without a frequent pair, gives no row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seamark.llm import words as W
from seamark.llm.common import input_bytes, task_count, written
from seamark.llm.words import U

LEAST, LONGEST, COVER, TOP = 100, 5, 100, 2000
UNKNOWN = "und"
SHARD_WORDS = 1 << 20
BUCKET_BYTES, TASK_BYTES, MOST_BUCKETS = 4 << 20, 8 << 20, 1 << 17  # bytes of packed shards

BREAK = np.zeros(256, bool)
BREAK[[*range(0x0A, 0x0E), *b".,;:!?"]] = True
APART = BREAK.copy()
APART[[0x20, 0x09]] = True

SHARD = "shard long, kind int, lang string, a binary, b binary"
ASKED = "bucket int, shard long, a binary, b binary"
FOUND = "lang string, size int, phrase string, hash long, head long, tail long, a long, l long, r long, n long, score long"
TEXT, ANSWER = 0, 1


def packed(values: np.ndarray | bytes) -> bytes:
    """Zstandard with the length in front; arrays go byte plane by byte plane, as high bytes are mostly 0."""
    raw = values if isinstance(values, bytes) else np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T).tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpacked(data: bytes) -> bytes:
    size = int.from_bytes(data[:8], "little")
    return pa.decompress(data[8:], size, codec="zstd", asbytes=True) if size else b""


def unpacked_ids(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(unpacked(data), np.uint8).reshape(4, -1).T).view("<i4").ravel().astype(np.int64)


def piece_words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, W.Words, np.ndarray, np.ndarray]:
    """(lower-cased bytes, words, hashes, whether a word begins a piece) of a block."""
    low = W.LOWER[data]
    w = W.Words(low, off, APART)
    rows = w.rows()
    breaks = np.zeros(len(low) + 1, np.int64)
    np.cumsum(BREAK[low], out=breaks[1:])
    fresh = np.ones(len(rows), bool)
    fresh[1:] = (rows[1:] != rows[:-1]) | (breaks[w.start[1:]] != breaks[w.end[:-1]])
    return low, w, np.maximum(W.Hasher(low).spans(w.start, w.end), U(1)), fresh


class Pile:
    """Words of one language that wait to become a shard."""

    def __init__(self):
        self.words = 0
        self.hashes: list[np.ndarray] = []
        self.known: list[np.ndarray] = []
        self.spelt: list[bytes] = []

    def add(self, data: np.ndarray, off: np.ndarray) -> None:
        low, w, hashes, fresh = piece_words(data, off)
        line = np.zeros(len(hashes) + int(fresh.sum()), U)
        line[np.arange(len(hashes)) + np.cumsum(fresh)] = hashes
        known, at = np.unique(hashes, return_index=True)
        raw = low.tobytes()
        self.hashes.append(line)
        self.known.append(known)
        self.spelt += [raw[s:e] for s, e in zip(w.start[at].tolist(), w.end[at].tolist())]
        self.words += len(hashes)

    def shard(self) -> tuple[bytes, bytes]:
        """(ids, 0 before and after every piece; words of ids 1 on, most frequent first)."""
        line = np.concatenate([*self.hashes, np.zeros(1, U)])
        _, ids, count = np.unique(line, return_inverse=True, return_counts=True)
        order = np.concatenate([[0], 1 + np.argsort(-count[1:], kind="stable")])
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        first = np.unique(np.concatenate(self.known), return_index=True)[1]
        return packed(rank[ids].astype("<i4")), packed(b"\n".join(self.spelt[first[i - 1]] for i in order[1:]))


def shards(docs: DataFrame) -> DataFrame:
    """The texts of ``docs`` as rows of ``SHARD``."""

    def run(batches):
        piles: dict[str, Pile] = {}
        made = 0

        def flush(lang: str) -> pa.RecordBatch:
            nonlocal made
            a, b = piles.pop(lang).shard()
            made += 1
            return shard_batch([((TaskContext.get().partitionId() << 32) + made, TEXT, lang, a, b)])

        for batch in batches:
            langs = batch.column("lang").fill_null(UNKNOWN).dictionary_encode()
            codes = np.asarray(langs.indices)
            for code, lang in enumerate(langs.dictionary.to_pylist()):
                texts = batch.column("text").take(pa.array(np.flatnonzero(codes == code)))
                for _, _, data, off in W.blocks(texts):
                    piles.setdefault(lang, Pile()).add(data, off)
                    if piles[lang].words >= SHARD_WORDS:
                        yield flush(lang)
            while sum(p.words for p in piles.values()) > 4 * SHARD_WORDS:
                yield flush(max(piles, key=lambda x: piles[x].words))
        for lang in list(piles):
            if piles[lang].words:
                yield flush(lang)

    return docs.select("lang", "text").mapInArrow(run, SHARD)


def shard_batch(rows: list[tuple[int, int, str | None, bytes, bytes]]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int32(), pa.string(), pa.binary(), pa.binary()))], ["shard", "kind", "lang", "a", "b"])


class Shard:
    """Ids of a shard, and the hashes of phrases at places in it."""

    def __init__(self, lang: str, a: bytes, b: bytes):
        self.ids = unpacked_ids(a)
        self.words = unpacked(b).split(b"\n")
        ends = np.cumsum([0] + [len(w) for w in self.words])
        self.hash = np.concatenate([np.zeros(1, U), W.Hasher(np.frombuffer(b"".join(self.words), np.uint8)).spans(ends[:-1], ends[1:])])
        self.salt = U(int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little"))

    def total(self) -> np.ndarray:
        """The hash under which a language counts all its words."""
        return W.mix(np.array([self.salt]))

    def phrase(self, ids: np.ndarray, size: int) -> np.ndarray:
        """Hashes of phrases, given one row of ids for each."""
        out = np.full(len(ids), self.salt)
        for k in range(size):
            out += self.hash[ids[:, k]] * W.GRAM[k]
        return W.mix(out)

    def phrases(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(places, hashes) of all phrases of ``size`` words."""
        count = max(0, len(self.ids) - size + 1)
        inside = np.ones(count, bool)
        for k in range(size):
            inside &= self.ids[k : k + count] > 0
        at = np.flatnonzero(inside)
        return at, self.phrase(self.ids[at[:, None] + np.arange(size)], size)


def suffix_order(text: np.ndarray, symbols: int, depth: int) -> np.ndarray:
    """Places of ``text`` by the next ``depth`` symbols. Ties are in no order: no interval of a phrase of that depth sees it."""
    n = len(text)
    padded = np.concatenate([text, np.zeros(depth, np.int64)])
    key, size, done = text, symbols, 1
    while done < depth:
        if done > 1:
            key = np.unique(key, return_inverse=True)[1]
            size = int(key.max()) + 1
        while done < depth and size * symbols < 1 << 62:
            key = key * symbols + padded[done : done + n]
            size *= symbols
            done += 1
    return np.argsort(key)


class Index:
    """FM-index of a text: suffix places, last column, and the map from a place of the last column to the first."""

    def __init__(self, text: np.ndarray, symbols: int, depth: int):
        self.places = suffix_order(text, symbols, depth)
        self.last = text[self.places - 1]
        self.to_first = np.empty(len(text), np.int64)
        self.to_first[np.argsort(self.last, kind="stable")] = np.arange(len(text))
        self.symbols = symbols

    def extend(self, low: np.ndarray, size: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Every interval ``low`` with ``size`` rows extended by every word in front of it.

        Returns (interval extended, low, size, low in the index of the reverse text), given the
        latter for the intervals as ``other``: there an interval is parted by the next word, in order.
        """
        edge = np.concatenate([[0], np.cumsum(size)])
        parent = np.repeat(np.arange(len(low)), size)
        at = np.arange(edge[-1]) + np.repeat(low - edge[:-1], size)
        key, first, count = np.unique(parent * self.symbols + self.last[at], return_index=True, return_counts=True)
        parent = key // self.symbols
        before = np.concatenate([[0], np.cumsum(count)[:-1]]) if len(count) else count
        word = key % self.symbols > 0
        parent, first, count, before = parent[word], first[word], count[word], before[word]
        return parent, self.to_first[at[first]], count, other[parent] + before - edge[parent]


def word_intervals(text: np.ndarray, symbols: int) -> tuple[np.ndarray, np.ndarray]:
    """(low, size) of the words that occur."""
    count = np.bincount(text, minlength=symbols)
    low = np.cumsum(count) - count
    some = np.flatnonzero(count[1:]) + 1
    return low[some], count[some]


def pairs(shard: Shard) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, counts) of the words and of the pairs of a shard, and of the number of its words."""
    symbols = len(shard.hash)
    index = Index(shard.ids, symbols, 2)
    low, size = word_intervals(shard.ids, symbols)
    words = shard.phrase(shard.ids[index.places[low]][:, None], 1)
    _, at, count, _ = index.extend(low, size, low)
    both = shard.ids[index.places[at][:, None] + np.arange(2)]
    return np.concatenate([shard.total(), words, shard.phrase(both, 2)]), np.concatenate([[size.sum()], size, count])


def longer(shard: Shard, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, counts) of all phrases of three words or more whose pairs are ``frequent`` (sorted hashes)."""
    at, hashes = shard.phrases(2)
    at = at[among(hashes, frequent)[0]]
    linked = np.zeros(len(shard.ids) + 1, bool)
    linked[at] = True
    # Runs of places in which each word makes a frequent pair with the next, 0 before each run.
    keep = linked[:-1] | np.append(False, linked[:-2])
    fresh = keep & ~np.append(False, linked[:-2])
    text = np.zeros(int(keep.sum() + fresh.sum()) + 1, np.int64)
    text[(np.cumsum(keep) + np.cumsum(fresh) - 1)[keep]] = shard.ids[keep]
    symbols = len(shard.hash)
    index, mirror = Index(text, symbols, LONGEST), Index(text[::-1].copy(), symbols, LONGEST)
    low, size = word_intervals(text, symbols)
    back = low
    out = [(np.zeros(0, U), np.zeros(0, np.int64))]
    for length in range(2, LONGEST + 1):
        if length % 2:
            _, low, size, back = index.extend(low, size, back)
        else:
            _, back, size, low = mirror.extend(back, size, low)
        if length > 2:
            out.append((shard.phrase(text[index.places[low][:, None] + np.arange(length)], length), size))
    return tuple(np.concatenate(x) for x in zip(*out))


def among(hashes: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(whether a hash is in sorted ``known``, its place there)."""
    if not len(known):
        return np.zeros(len(hashes), bool), np.zeros(len(hashes), np.int64)
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    return known[at] == hashes, at


def asked(shard_id: int, hashes: np.ndarray, counts: np.ndarray, shift: int) -> pa.RecordBatch:
    """Counts of one shard by bucket of the hash range."""
    order = np.argsort(hashes)
    hashes, counts = hashes[order], counts[order].astype("<i8")
    bucket = (hashes >> U(shift)).astype(np.int64) if shift < 64 else np.zeros(len(hashes), np.int64)
    edge = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(hashes) else np.zeros(0, np.int64)
    rows = [(int(bucket[i]), shard_id, hashes[i:j].tobytes(), counts[i:j].tobytes()) for i, j in zip(edge, [*edge[1:], len(hashes)])]
    columns = list(zip(*rows)) or [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int32(), pa.int64(), pa.binary(), pa.binary()))], ["bucket", "shard", "a", "b"])


def sums(counted: DataFrame, least: int, tasks: int) -> DataFrame:
    """Answers to the shards: their hashes with ``least`` or more in all, and the sum twice, plus one
    for the first shard that has the hash."""

    def merge(table: pa.Table) -> pa.Table:
        table = table.sort_by("shard")
        parts = [np.frombuffer(x, U) for x in table["a"].to_pylist()]
        keys, first, at = np.unique(np.concatenate(parts), return_index=True, return_inverse=True)
        total = np.zeros(len(keys), np.int64)
        np.add.at(total, at, np.concatenate([np.frombuffer(x, "<i8") for x in table["b"].to_pylist()]))
        owner = np.zeros(len(at), bool)
        owner[first] = True
        enough = total[at] >= least
        rows, to = [], np.cumsum([0] + [len(p) for p in parts])
        for shard_id, i, j in zip(table["shard"].to_pylist(), to, to[1:]):
            some = i + np.flatnonzero(enough[i:j])
            if len(some):
                rows.append((shard_id, ANSWER, None, keys[at[some]].tobytes(), (2 * total[at[some]] + owner[some]).astype("<i8").tobytes()))
        return pa.Table.from_batches([shard_batch(rows)])

    return counted.repartition(tasks, "bucket").groupBy("bucket").applyInArrow(merge, SHARD)


def opened(table: pa.Table) -> tuple[Shard, np.ndarray, np.ndarray, np.ndarray] | None:
    """(shard, sorted hashes of the answers, sums, whether it is the first shard with the hash); None without answers."""
    kinds = np.asarray(table["kind"])
    if not (kinds == ANSWER).any():
        return None
    at = int(np.flatnonzero(kinds == TEXT)[0])
    told = table.filter(pa.array(kinds == ANSWER))
    keys = np.concatenate([np.frombuffer(x, U) for x in told["a"].to_pylist()])
    total = np.concatenate([np.frombuffer(x, "<i8") for x in told["b"].to_pylist()])
    order = np.argsort(keys)
    return Shard(table["lang"][at].as_py(), table["a"][at].as_py(), table["b"][at].as_py()), keys[order], total[order] >> 1, (total[order] & 1).astype(bool)


def spelt(lang: str, shard: Shard, keys: np.ndarray, total: np.ndarray, first: np.ndarray) -> Iterator[list[tuple]]:
    """Rows of ``FOUND`` for the candidates of which this is the first shard."""
    n = int(total[among(shard.total(), keys)[1]][0])
    for size in range(2, LONGEST + 1):
        at, hashes = shard.phrases(size)
        known, where = among(hashes, keys)
        mine = np.flatnonzero(known & first[where]) if len(keys) else np.zeros(0, np.int64)
        mine = mine[np.unique(hashes[mine], return_index=True)[1]]
        if not len(mine):
            continue
        ids = shard.ids[at[mine][:, None] + np.arange(size)]
        heads = [shard.phrase(ids[:, :k], k) for k in range(1, size)]
        tails = [shard.phrase(ids[:, k:], size - k) for k in range(1, size)]
        left, right = ([total[among(h, keys)[1]].tolist() for h in side] for side in (heads, tails))
        a = total[where[mine]].tolist()
        rows = []
        for i, (words, whole) in enumerate(zip(ids.tolist(), hashes[mine].view(np.int64).tolist())):
            score, _, l, r = min((1000 * a[i] * n // (left[k][i] * right[k][i]), k, left[k][i], right[k][i]) for k in range(size - 1))
            phrase = b" ".join(shard.words[w - 1] for w in words).decode(errors="replace")
            rows.append((lang, size, phrase, whole, int(heads[-1][i].view(np.int64)), int(tails[0][i].view(np.int64)), a[i], l, r, n, score))
        yield rows


def candidates(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """Rows of ``FOUND``: every phrase of two words or more with ``least`` occurrences, and its lowest-scoring cut."""
    texts = written(shards(docs), "phrase-shards")
    tasks = task_count(texts, TASK_BYTES)
    buckets = min(MOST_BUCKETS, max(16, input_bytes(texts) // BUCKET_BYTES))
    shift = 64 - int(buckets - 1).bit_length()

    def count_pairs(batches):
        for batch in batches:
            for shard_id, lang, a, b in zip(*(batch.column(c).to_pylist() for c in ("shard", "lang", "a", "b"))):
                yield asked(shard_id, *pairs(Shard(lang, a, b)), shift)

    def count_longer(table: pa.Table) -> pa.Table:
        has = opened(table)
        none = np.zeros(0, U), np.zeros(0, np.int64)
        return pa.Table.from_batches([asked(table["shard"][0].as_py(), *(longer(has[0], has[1]) if has else none), shift)])

    def spell(table: pa.Table) -> pa.Table:
        has = opened(table)
        langs = [x for x in table["lang"].to_pylist() if x is not None]
        rows = [r for part in (spelt(langs[0], *has) if has else ()) for r in part]
        columns = list(zip(*rows)) or [()] * 11
        kinds = (pa.string(), pa.int32(), pa.string(), *[pa.int64()] * 8)
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=[f.split()[0] for f in FOUND.split(", ")])

    short = written(sums(texts.mapInArrow(count_pairs, ASKED), least, tasks), "phrase-pairs")
    long = sums(texts.unionByName(short).repartition(tasks, "shard").groupBy("shard").applyInArrow(count_longer, ASKED), least, tasks)
    long = written(long, "phrase-longer")
    return texts.unionByName(short).unionByName(long).repartition(tasks, "shard").groupBy("shard").applyInArrow(spell, FOUND)


def collocations(docs: DataFrame, least: int = LEAST, cover: int = COVER, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of the first ``top`` phrases of every language."""
    found = written(candidates(docs, least), "phrases")
    wider = found.filter("size > 2").select(F.explode(F.array("head", "tail")).alias("hash"), F.col("a").alias("wide")).groupBy("hash").agg(F.max("wide").alias("wide"))
    kept = found.join(wider, "hash", "left").filter(F.col("wide").isNull() | (F.col("wide") * 100 < F.col("a") * cover))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    return kept.withColumn("rank", rank.cast("long")).filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
