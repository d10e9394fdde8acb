"""Scoring texts by a log-bilinear language model trained with noise-contrastive estimation.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; every text ends with an end token. The
training texts are those whose crc32 of doc_id (as text; none counts as empty) is not 0 modulo 10.

The model has two factors, both log-bilinear and trained by noise contrast.

1. Symbols: the end, the ``OWN`` most frequent words, and ``TAILS`` classes of all other words by
   their look (last byte, first byte, non-ASCII or not). Trigrams of symbols over all training
   tokens are counted on Spark, and the driver takes full-batch steps on the exact expectation over the
   noise (unigram, ``NOISE`` to one).
2. Words: ``room`` words, a number that grows with the root of the tokens, have vectors of their
   own. All rarer words share hashed slots of their class, whose number grows alike; a slot has
   vectors too, and a word in it its smoothed share ``(c + 0.1) / (N + 0.1 (V + 1))``, one unknown word a slot
   included. With ``h = C1 r1 + C2 r2`` from the vectors of the two entries before, entry e is reached by
   choices symbol, group of its class, entry of the group (``Tree``); at each, child x has the
   probability ``p(x) exp(h . q_x + b_x)``, normalised over all children, where p is factor 1 at the root and
   the share of training tokens below. So the probabilities sum to one over all words.

Factor 2 is trained on every training token in Spark tasks (``train_words``). The texts are written once as
arrays of entries, dealt by a hash into ``ROUNDS`` rounds of ``parts_of`` parts each, whatever the number of
cores. The noise of a choice is p, ``NOISE`` to one, and its expectation over all children is exact, as in
factor 1. In each round every part steps over its texts, in the order of their hashes, from the same
parameters, and the moves are averaged row by row, weighted by the squared gradients that the row met. The
exponential of factor 2 is linear between powers of two (``exponent``), alike in training and scoring.

Word counts are exact over the whole training text. Counts and lookups travel as arrays in
buckets of the hash range (a 59-bit hash and 5 bits of class), a number that follows the input.
The end and words above a count that at most ``KNOWN`` words (or ``room``, if more) reach are broadcast and looked up in place, so no
bucket is filled by one frequent word; the others meet their counts in their bucket.

Null texts count as empty: one end token. Each row is scored by itself, repeated rows too. Other
columns are ignored.
"""

from __future__ import annotations

import copy
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seamark.llm import words as W
from seamark.llm.common import input_bytes, written
from seamark.llm.words import U

SYMBOLS, TAILS, WIDTH = 128, 20, 24
OWN = SYMBOLS - TAILS - 1
END = SYMBOLS - 1
KNOWN = 1 << 16
DEPTH = 15  # of the vectors of words
ROOM = 8
LEAST = 8  # count from which a word has vectors of its own
ROUNDS, BATCH, SCORED, CELLS, WORD_RATE, CALM = 4, 1 << 16, 1 << 18, 1 << 18, 0.25, 1.0
PART_TOKENS, STEPS_A_PART = 1 << 22, 256
ALPHA = 0.1
NOISE, STEPS, RATE = 8, 160, 0.05
BUCKET_BYTES = 8 << 20
CLASS_BITS = U(5)
END_KEY = U(0x5E3A_11D7_0C92_47DF)  # its class, 31, is no word's
FLUSH = 1 << 20

ENDING = np.full(256, 2, np.uint8)
ENDING[[*range(97, 123), *range(128, 256)]] = 4
ENDING[48:58] = 3
ENDING[ord(".")], ENDING[ord(",")] = 0, 1
STARTING = np.zeros(256, np.uint8)
STARTING[[*range(97, 123), *range(128, 256)]] = 1

META = np.dtype([("row", "<i8"), ("doc", "<i8"), ("none", "?"), ("held", "?"), ("n", "<i8"), ("known", "<i8"), ("base", "<f8"), ("score", "<f8")])
PART = np.dtype([("row", "<i8"), ("known", "<i8"), ("log", "<f8")])
BLOCK = "bucket int, kind int, a binary, b binary"


def word_keys(data: np.ndarray, off: np.ndarray) -> tuple[W.Words, np.ndarray]:
    """Words of a block and their keys: 59 bits of hash above 5 of class."""
    low = W.LOWER.take(data)
    w = W.Words(low, off)
    high = np.zeros(len(low) + 1, np.int64)
    np.cumsum(low > 127, out=high[1:])
    look = (ENDING[low[w.end - 1]] * 2 + STARTING[low[w.start]]) * 2 + (high[w.end] > high[w.start])
    return w, W.Hasher(low).spans(w.start, w.end) >> CLASS_BITS << CLASS_BITS | look.astype(U)


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found, at = np.unique(keys, return_inverse=True)
    return found, np.bincount(at, counts, len(found)).astype(np.int64)


def slices(keys: np.ndarray, shift: int, *values: np.ndarray) -> Iterator[tuple[int, bytes, bytes]]:
    """(bucket, keys, values) of entries sorted by key."""
    bucket = (keys >> U(shift)).astype(np.int64) if shift < 64 else np.zeros(len(keys), np.int64)
    edge = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(keys) else []
    for i, j in zip(edge, [*edge[1:], len(keys)]):
        yield int(bucket[i]), keys[i:j].tobytes(), *(v[i:j].tobytes() for v in values)


def block_batch(rows: list[tuple[int, int, bytes, bytes]]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int32(), pa.int32(), pa.binary(), pa.binary()))], ["bucket", "kind", "a", "b"])


def count_words(docs: DataFrame, shift: int) -> DataFrame:
    """Key counts of all texts, the end token included: one row a bucket (a: sorted keys, b: counts)."""

    def count(batches):
        keys, counts, held, ends = [], [], 0, 0
        for batch in batches:
            ends += batch.num_rows
            for _, _, data, off in W.blocks(batch.column("text")):
                k, c = np.unique(word_keys(data, off)[1], return_counts=True)
                keys.append(k)
                counts.append(c)
                held += len(k)
            if held > 2 * FLUSH:
                k, c = summed(np.concatenate(keys), np.concatenate(counts))
                keys, counts, held = [k], [c], len(k)
                if held > FLUSH:
                    yield block_batch([(b, 0, x, y) for b, x, y in slices(k, shift, c)])
                    keys, counts, held = [], [], 0
        if ends:
            k, c = summed(np.concatenate([*keys, np.array([END_KEY])]), np.concatenate([*counts, np.array([ends])]))
            yield block_batch([(b, 0, x, y) for b, x, y in slices(k, shift, c)])

    def merge(table: pa.Table) -> pa.Table:
        k, c = summed(*(np.concatenate([np.frombuffer(x, d) for x in table[n].to_pylist()]) for n, d in (("a", "<u8"), ("b", "<i8"))))
        return pa.Table.from_batches([block_batch([(table["bucket"][0].as_py(), 0, k.tobytes(), c.tobytes())])])

    return docs.select("text").mapInArrow(count, BLOCK).groupBy("bucket").applyInArrow(merge, BLOCK)


def magnitude(counts: np.ndarray) -> np.ndarray:
    """Counts by size, eight steps an octave; a larger count never has a smaller step."""
    return (8 * np.log2(counts)).astype(np.int64)


def room(n: int) -> int:
    """Words with vectors of their own after ``n`` training tokens."""
    return max(1 << 10, int(ROOM * n**0.5))


def slot_of(keys: np.ndarray, slots: int) -> np.ndarray:
    """Slot of a word among ``slots`` of each class."""
    return (keys & U(31)).astype(np.int64) * slots + ((keys >> CLASS_BITS) % U(slots)).astype(np.int64)


@dataclass
class Vocabulary:
    """Totals of the training tokens, and the frequent words with counts and entries.

    Entries are the symbols, then words with vectors of their own, then slots. ``mass`` is an
    entry's smoothed count (0 for symbols), ``look`` its class.
    """

    n: int
    distinct: int
    keys: np.ndarray
    counts: np.ndarray
    entry: np.ndarray  # -1: in a slot
    slots: int
    mass: np.ndarray
    look: np.ndarray

    def __post_init__(self):
        # First place of each stretch of the hash range; the fullest holds ``most`` keys, a few as they are hashes.
        bits = len(self.keys).bit_length() + 1
        self.shift = U(64 - bits)
        self.begin = np.searchsorted(self.keys, np.arange(1 << bits, dtype=U) << self.shift)
        self.most = int(np.diff(self.begin, append=len(self.keys)).max())

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(found, place) of keys among the frequent words; the place counts where found."""
        if not len(self.keys):
            return np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)
        last = len(self.keys) - 1
        at = np.minimum(self.begin[keys >> self.shift], last)
        left = np.flatnonzero(self.keys[at] < keys)
        for _ in range(self.most - 1):
            at[left] = np.minimum(at[left] + 1, last)
            left = left[self.keys[at[left]] < keys[left]]
        return self.keys[at] == keys, at

    def entries(self, keys: np.ndarray, found: np.ndarray, at: np.ndarray) -> np.ndarray:
        slot = len(self.mass) - TAILS * self.slots + slot_of(keys, self.slots)
        return np.where(found & (self.entry[at] >= 0), self.entry[at], slot) if len(self.keys) else slot

    def symbols(self, entries: np.ndarray) -> np.ndarray:
        return np.where(entries < SYMBOLS, entries, OWN + self.look[entries])


def vocabulary(counted: DataFrame) -> Vocabulary:
    def sizes(batches):
        for batch in batches:
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
                k, c = np.frombuffer(a, "<u8"), np.frombuffer(b, "<i8")
                cells, at = np.unique(magnitude(c), return_inverse=True)
                yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(np.bincount(at)), pa.array(np.bincount(at, c).astype(np.int64))], ["cell", "words", "tokens"])

    size = counted.mapInArrow(sizes, "cell long, words long, tokens long").groupBy("cell").agg(F.sum("words").alias("words"), F.sum("tokens").alias("tokens")).toPandas()
    step, words, tokens = (size[c].to_numpy(np.int64) for c in ("cell", "words", "tokens"))
    n = int(tokens.sum())
    above = np.cumsum(np.bincount(step, words)[::-1])[::-1] if len(step) else np.zeros(1)

    def least_for(most: int) -> int:
        enough = np.flatnonzero(above <= most)
        return int(enough[0]) if len(enough) else len(above)

    least, own = least_for(max(KNOWN, room(n))), max(least_for(room(n)), int(magnitude(np.array([LEAST]))[0]))
    slots = -(-room(n) // (4 * TAILS))

    def frequent(batches):
        for batch in batches:
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
                k, c = np.frombuffer(a, "<u8"), np.frombuffer(b, "<i8")
                top = (magnitude(c) >= least) | (k == END_KEY)
                yield pa.RecordBatch.from_arrays([pa.array(k[top].view(np.int64)), pa.array(c[top])], ["k", "c"])

    def rest(batches):
        for batch in batches:
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
                k, c = np.frombuffer(a, "<u8"), np.frombuffer(b, "<i8")
                few = (magnitude(c) < own) & (k != END_KEY)
                cells, at = np.unique(slot_of(k[few], slots), return_inverse=True)
                yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(np.bincount(at, minlength=len(cells))), pa.array(np.bincount(at, c[few], len(cells)).astype(np.int64))], ["cell", "words", "tokens"])

    top = counted.mapInArrow(frequent, "k long, c long").toPandas()
    keys, counts = top["k"].to_numpy(np.int64).view(U), top["c"].to_numpy(np.int64)
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    low = counted.mapInArrow(rest, "cell long, words long, tokens long").groupBy("cell").agg(F.sum("words").alias("words"), F.sum("tokens").alias("tokens")).toPandas()
    slot_n, slot_words = np.zeros(TAILS * slots), np.zeros(TAILS * slots)
    slot_n[low["cell"].to_numpy(np.int64)], slot_words[low["cell"].to_numpy(np.int64)] = low["tokens"], low["words"]
    entry = np.full(len(keys), -1)
    order = [i for i in np.lexsort([keys, -counts]) if keys[i] != END_KEY]
    entry[order[:OWN]] = np.arange(min(OWN, len(order)))
    entry[keys == END_KEY] = END
    for i in order[:OWN]:
        if magnitude(counts[i : i + 1])[0] < own:
            slot = slot_of(keys[i : i + 1], slots)
            slot_n[slot] -= counts[i]
            slot_words[slot] -= 1
    mine = np.array([i for i in order[OWN:] if magnitude(counts[i : i + 1])[0] >= own], np.int64)
    entry[mine] = SYMBOLS + np.arange(len(mine))
    mass = np.concatenate([np.zeros(SYMBOLS), counts[mine] + ALPHA, slot_n + ALPHA * (slot_words + 1)])
    look = np.concatenate([np.zeros(SYMBOLS, np.int64), (keys[mine] & U(31)).astype(np.int64), np.repeat(np.arange(TAILS), slots)])
    return Vocabulary(n, int(words.sum()), keys, counts, entry, slots, mass, look)


def sequences(w: W.Words, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(entry two before, entry before, entry, row) of every token, ends included."""
    row = np.concatenate([w.rows(), np.arange(len(w.count))])
    place = np.concatenate([np.arange(len(entries)) + row[: len(entries)], w.at[1:] + np.arange(len(w.count))])
    seq = np.full(len(place), END)
    seq[place[: len(entries)]] = entries
    rows = np.empty(len(place), np.int64)
    rows[place] = row
    first = np.append(True, rows[1:] != rows[:-1])[: len(rows)]
    one = np.append(END, seq[:-1])[: len(seq)]
    two = np.append(END, one[:-1])[: len(seq)]
    return np.where(first, END, two), one, seq, rows


def parts_of(n: int) -> int:
    """Parts of the training texts, each for one task, after ``n`` training tokens. They grow with the root of
    n, as the words with vectors do, so that all moves together grow with the text."""
    return max(1, int(np.ceil((n / PART_TOKENS) ** 0.5)))


def encoded(docs: DataFrame, vocab: Vocabulary, rounds: int) -> DataFrame:
    """The entries of every text, the end included, with the round and part that train on it.

    Both follow from a hash of the row; equal rows of a batch go to different parts."""
    shared = docs.sparkSession.sparkContext.broadcast(vocab)
    parts = parts_of(vocab.n)

    def run(batches):
        v = shared.value
        for batch in batches:
            hashes = np.asarray(batch.column("at"))
            order = np.argsort(hashes, kind="stable")
            again = np.arange(len(hashes)) - np.searchsorted(hashes[order], hashes[order])
            copy = np.empty(len(hashes), np.int64)
            copy[order] = again
            part = ((hashes >> 16) + copy) % parts
            for a, b, data, off in W.blocks(batch.column("text")):
                w, keys = word_keys(data, off)
                seq = sequences(w, v.entries(keys, *v.find(keys)))[2].astype("<i4")
                to = w.at + np.arange(b - a + 1)
                ids = pa.array([seq[i:j].tobytes() for i, j in zip(to, to[1:])], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(hashes[a:b] % rounds, pa.int32()), pa.array(part[a:b], pa.int32()), pa.array(hashes[a:b], pa.int64()), ids], ["turn", "part", "at", "ids"])

    return docs.select("text", F.xxhash64("text", "doc_id").alias("at")).mapInArrow(run, "turn int, part int, at long, ids binary")


def contexts(seq: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry two before, entry before) of the tokens of whole texts, each of which ends in an end."""
    one = np.append(END, seq[:-1])[: len(seq)]
    return np.where(one == END, END, np.append(END, one[:-1])[: len(seq)]), one


def count_trigrams(encoded: DataFrame, vocab: Vocabulary) -> np.ndarray:
    """Tokens by (context, symbol) over all texts."""
    shared = encoded.sparkSession.sparkContext.broadcast(vocab.symbols(np.arange(len(vocab.mass))))
    cells = SYMBOLS**3

    def count(batches):
        total = np.zeros(cells, np.int64)
        for batch in batches:
            seq = shared.value[np.frombuffer(b"".join(batch.column("ids").to_pylist()), "<i4")]
            two, one = contexts(seq)
            np.add.at(total, (two * SYMBOLS + one) * SYMBOLS + seq, 1)
        some = np.flatnonzero(total)
        yield block_batch([(b, 0, x, y) for b, x, y in slices(some.astype(U), 17, total[some])])

    def merge(table: pa.Table) -> pa.Table:
        k, c = summed(*(np.concatenate([np.frombuffer(x, d) for x in table[n].to_pylist()]) for n, d in (("a", "<u8"), ("b", "<i8"))))
        return pa.Table.from_batches([block_batch([(0, 0, k.astype("<u4").tobytes(), c.tobytes())])])

    out = np.zeros(cells)
    for r in encoded.select("ids").mapInArrow(count, BLOCK).groupBy("bucket").applyInArrow(merge, BLOCK).select("a", "b").toLocalIterator():
        out[np.frombuffer(r["a"], "<u4")] = np.frombuffer(r["b"], "<i8")
    return out.reshape(SYMBOLS**2, SYMBOLS)


@dataclass
class Bilinear:
    """Parameters of the model."""

    r: np.ndarray
    q: np.ndarray
    c1: np.ndarray
    c2: np.ndarray
    b: np.ndarray

    def predicted(self, context: np.ndarray) -> np.ndarray:
        return (self.r @ self.c1)[context % SYMBOLS] + (self.r @ self.c2)[context // SYMBOLS]

    def log_probabilities(self) -> np.ndarray:
        """Normalised natural logs, one row a context."""
        s = self.predicted(np.arange(SYMBOLS**2)) @ self.q.T + self.b
        s -= s.max(axis=1, keepdims=True)
        return s - np.log(np.exp(s).sum(axis=1, keepdims=True))


def train(trigrams: np.ndarray, steps: int = STEPS, seed: int = 0) -> Bilinear:
    """Adam on the expected noise-contrastive loss over all counted trigrams."""
    rng = np.random.default_rng(seed)
    shape = {"r": (SYMBOLS, WIDTH), "q": (SYMBOLS, WIDTH), "c1": (WIDTH, WIDTH), "c2": (WIDTH, WIDTH)}
    model = Bilinear(**{k: rng.normal(0, 0.1 if k in "rq" else WIDTH**-0.5, v).astype(np.float32) for k, v in shape.items()}, b=np.zeros(SYMBOLS, np.float32))
    total = trigrams.sum()
    if total == 0:
        return model
    unigram = (trigrams.sum(axis=0) + 1) / (total + SYMBOLS)
    model.b[:] = np.log(unigram)
    context = np.flatnonzero(trigrams.any(axis=1))
    data = (trigrams[context] / total).astype(np.float32)
    noise = (NOISE * data.sum(axis=1, keepdims=True) * unigram).astype(np.float32)
    level = np.log(NOISE * unigram).astype(np.float32)
    one, two = context % SYMBOLS, context // SYMBOLS
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in vars(model).items()}
    pick1, pick2 = (np.zeros((len(context), SYMBOLS), np.float32) for _ in range(2))
    pick1[np.arange(len(context)), one] = 1
    pick2[np.arange(len(context)), two] = 1
    for step in range(1, steps + 1):
        h = model.predicted(context)
        true = 1 / (1 + np.exp(level - h @ model.q.T - model.b))
        pull = (data + noise) * true - data
        dh = pull @ model.q
        d1, d2 = pick1.T @ dh, pick2.T @ dh
        grad = {"q": pull.T @ h, "b": pull.sum(axis=0), "c1": model.r.T @ d1, "c2": model.r.T @ d2, "r": d1 @ model.c1.T + d2 @ model.c2.T}
        rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
        for k, g in grad.items():
            m, v = moment[k]
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            getattr(model, k)[...] -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return model


class Tree:
    """The choices that lead to an entry. Node k has the rows ``first[k]`` to ``first[k + 1]``: node 0 the
    symbols, nodes 1 to ``TAILS`` the groups of a class, all others the entries of a group."""

    def __init__(self, vocab: Vocabulary):
        groups, members = [], []
        for c in range(TAILS):
            own = np.flatnonzero(vocab.look[SYMBOLS:] == c) + SYMBOLS
            own = own[np.argsort(-vocab.mass[own], kind="stable")]
            count = int(np.ceil(len(own) ** 0.5))
            members.append(np.array_split(own, count))
            groups.append(np.array([vocab.mass[m].sum() for m in members[-1]]))
        sizes = [SYMBOLS, *map(len, groups), *(len(m) for g in members for m in g)]
        self.first = np.concatenate([[0], np.cumsum(sizes)])
        self.node = np.repeat(np.arange(len(sizes)), sizes)
        flat = [m for g in members for m in g]
        mass = np.concatenate([np.ones(SYMBOLS), *groups, *(vocab.mass[m] for m in flat)])
        self.share = (mass / np.add.reduceat(mass, self.first[:-1])[self.node]).astype(np.float32)
        self.path = np.full((len(vocab.mass), 3), -1, np.int32)
        self.path[:, 0] = vocab.symbols(np.arange(len(vocab.mass)))
        for k, m in enumerate(flat):
            self.path[m, 1] = SYMBOLS + k
            self.path[m, 2] = np.arange(self.first[1 + TAILS + k], self.first[2 + TAILS + k])

        self.rank = np.where(self.path[:, 2] >= 0, self.path[:, 2], np.arange(len(vocab.mass)) - SYMBOLS)
        self.starts = self.first[1 + TAILS : -1]
        self.classes = self.starts[np.cumsum([0, *map(len, members)])[:-1]]
        cut = np.diff(sizes, prepend=0) != 0
        cut[[0, 1, 1 + TAILS]] = True
        edge = [*np.flatnonzero(cut), len(sizes)]
        self.runs = [(int(i), int(j), sizes[i]) for i, j in zip(edge, edge[1:])]  # neighbouring nodes of one depth with equally many children

    def blocks(self, values: np.ndarray, run: tuple[int, int, int]) -> np.ndarray:
        """The part of ``values``, node by node, that belongs to the nodes of a run: one matrix a node, or
        one row if there is one value a row of the tree."""
        i, j, size = run
        wide = len(values) // len(self.node)
        part = values[wide * self.first[i] : wide * self.first[j]]
        return part.reshape((j - i, size) if wide == 1 else (j - i, wide, size))

    def by_row(self, values: np.ndarray) -> np.ndarray:
        """Matrices of the nodes as one row a row of the tree."""
        return np.concatenate([self.blocks(values, run).swapaxes(1, 2).reshape(-1, DEPTH + 1) for run in self.runs])

    def by_node(self, rows: np.ndarray) -> np.ndarray:
        return np.concatenate([rows[self.first[i] : self.first[j]].reshape(j - i, size, -1).swapaxes(1, 2).reshape(-1) for i, j, size in self.runs])

    def stacks(self, entries: np.ndarray, rank: np.ndarray) -> Iterator[tuple[tuple[int, int, int], np.ndarray, list[tuple[np.ndarray, np.ndarray]]]]:
        """The nodes below the root that the entries pass, which come in the order of their ``rank``, as stacks of
        nodes of one run with about equally many tokens: the run, their places in it, and (token, chosen child) of
        these nodes, some tokens at a time. Where a node has fewer tokens stands ``len(rank)``."""
        edges = [np.append(np.searchsorted(rank, starts), len(rank)) for starts in (self.classes, self.starts)]
        paths = [np.append(self.path[entries, depth], 0) for depth in (1, 2)]
        for run in self.runs[1:]:
            i, j, size = run
            if size == 1:
                continue
            below = int(i > TAILS)
            first = i - 1 - below * TAILS
            edge, path = edges[below][first : first + j - i + 1], paths[below]
            count = np.diff(edge)
            order = np.argsort(-count, kind="stable")
            falling = -count[order]
            at, end = 0, int(np.searchsorted(falling, 0))
            while at < end:
                most = -int(falling[at])
                to = at + int(np.searchsorted(falling[at : min(end, at + max(1, CELLS // (most * size)))], -most // 2, "right"))
                k, few, pieces = order[at:to], max(1, CELLS // size), []
                start = self.first[i + k, None]
                for t in range(0, most, few):
                    token = edge[k, None] + np.arange(t, min(t + few, most))
                    none = token >= edge[k + 1, None]
                    child = path[np.minimum(token, len(rank))] - start
                    token[none], child[none] = len(rank), 0
                    pieces.append((token, child))
                yield run, k, pieces
                at = to


# 2**23 / ln 2 and the bits of 1.0 as float32, less the shift that centres the error.
STEEP, ONE_BITS, MOST_BITS = np.float32(12102203.16), np.float32(1064866805.0), np.float32(2.1e9)
MOST_SUM = 80  # sums to this, of either sign, stay within the limits


class Choice:
    """The exponentials of children for some tokens at a time, in two arrays that are used again and again."""

    def __init__(self, own: np.ndarray):
        """``own``: predicted vectors of all tokens that will come; their last column is 1."""
        self.floats, self.whole = np.empty(CELLS, np.float32), np.empty(CELLS, np.int32)
        self.reach = float(np.einsum("ij,ij->i", own, own).max(initial=0)) ** 0.5

    def between(self, q: np.ndarray, tokens: int) -> None:
        """Take the columns of ``q``, or of each of its matrices, as children for so many tokens each."""
        self.bits = q * STEEP
        self.bits[..., -1, :] += ONE_BITS
        # Few tokens are limited sooner than judged.
        self.steep = tokens <= 2 * q.shape[-2] or self.reach * float(np.einsum("...dm,...dm->...m", q, q).max()) ** 0.5 > MOST_SUM

    def exponent(self, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """exp(own . q) for every row of ``own`` and column of ``q``, linear between powers of two (relative error
        below 3 percent): the sum, scaled, is read as the bits of a float. And an array of its shape."""
        shape = (*own.shape[:-1], self.bits.shape[-1])
        cells = math.prod(shape)
        if cells > len(self.floats):
            self.floats, self.whole = np.empty(cells, np.float32), np.empty(cells, np.int32)
        s, out = self.floats[:cells].reshape(shape), self.whole[:cells].reshape(shape)
        np.matmul(own, self.bits, out=s)
        if self.steep:
            np.clip(s, np.float32(0), MOST_BITS, out=s)
        np.copyto(out, s, casting="unsafe")
        return out.view(np.float32), s


def averaged(parts: list[np.ndarray], weights: list[np.ndarray]) -> np.ndarray:
    total = np.maximum(sum(weights), 1e-12)
    return sum(p * (w / total).reshape(-1, *[1] * (p.ndim - 1)) for p, w in zip(parts, weights))


class WordModel:
    """Vectors of entries as context (r) and of children, node by node (q: one column a child, the last row the bias)."""

    def __init__(self, vocab: Vocabulary, tree: Tree, table: np.ndarray, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.vocab, self.tree, self.table = vocab, tree, table  # table: probability by (context, symbol)
        self.noise, self.noise_table = NOISE * tree.share, NOISE * table
        self.r = rng.normal(0, 0.3, (len(vocab.mass), DEPTH)).astype(np.float32)
        self.q = np.zeros(len(tree.share) * (DEPTH + 1), np.float32)
        self.c = rng.normal(0, DEPTH**-0.5, (2 * DEPTH, DEPTH)).astype(np.float32)
        self.met = {k: np.zeros(n, np.float32) for k, n in (("r", len(self.r)), ("q", len(tree.share)), ("c", len(self.c)))}

    def context(self, two: np.ndarray, one: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(context of symbols, vectors of the entry before and of that before it, predicted vector and a one)."""
        x1, x2 = (np.take(self.r, e, axis=0, mode="clip") for e in (one, two))
        c = np.pad(self.c, ((0, 0), (0, 1)))
        h = x1 @ c[:DEPTH]
        h += x2 @ c[DEPTH:]
        h[:, DEPTH] = 1
        symbol = self.tree.path[:, 0]
        return symbol[two] * np.int32(SYMBOLS) + symbol[one], x1, x2, h

    def below(self, entries: np.ndarray, rank: np.ndarray, order: np.ndarray, h: np.ndarray) -> tuple[int, np.ndarray]:
        """(first place in ``order``, which sorts ``rank``, of an entry that is no symbol; vectors from there, and one more)."""
        low = int(np.searchsorted(rank, 0))
        return low, np.take(h, np.append(order[low:], 0), axis=0, mode="clip")

    def log_probabilities(self, two: np.ndarray, one: np.ndarray, entries: np.ndarray) -> np.ndarray:
        """Normalised natural logs of entries after their contexts."""
        out = np.zeros(len(entries))
        root = self.tree.blocks(self.q, self.tree.runs[0])[0]
        for at in range(0, len(entries), SCORED):
            here = entries[at : at + SCORED]
            context, _, _, h = self.context(two[at : at + SCORED], one[at : at + SCORED])
            choice = Choice(h)
            log = np.empty(len(here), np.float32)

            order = np.argsort(context)  # so that rows of the table are read in turn
            choice.between(root, len(here))
            few, symbol = CELLS // SYMBOLS, self.tree.path[here, 0]
            for t in range(0, len(here), few):
                those = order[t : t + few]
                p, base = choice.exponent(h.take(those, axis=0))
                np.take(self.table, context[those], axis=0, out=base, mode="clip")
                own = np.arange(0, p.size, SYMBOLS) + symbol[those]
                log[those] = np.log(p.reshape(-1)[own] * base.reshape(-1)[own] / np.einsum("ij,ij->i", p, base))

            rank = self.tree.rank[here]
            order = np.argsort(rank)
            rank = rank[order]
            low, h = self.below(here, rank, order, h)
            found = np.zeros(len(h), np.float32)
            for run, k, pieces in self.tree.stacks(here[order[low:]], rank[low:]):
                choice.between(self.tree.blocks(self.q, run).take(k, axis=0), pieces[0][0].shape[1])
                share = self.tree.blocks(self.tree.share, run).take(k, axis=0)
                for token, child in pieces:
                    p, _ = choice.exponent(h.take(token, axis=0))
                    own = np.arange(0, p.size, p.shape[2]).reshape(child.shape) + child
                    own_share = share.reshape(-1)[np.arange(0, share.size, p.shape[2])[:, None] + child]
                    found[token] += np.log(p.reshape(-1)[own] * own_share / np.einsum("gtm,gm->gt", p, share))
            log[order[low:]] += found[:-1]
            out[at : at + SCORED] = log
        return out

    def move(self, name: str, rows: np.ndarray | slice, g: np.ndarray) -> None:
        met = self.met[name]
        met[rows] += np.einsum("ij,ij->i", g, g) / np.float32(g.shape[1])
        getattr(self, name)[rows] -= WORD_RATE * g / np.sqrt(met[rows] + CALM)[:, None]

    def move_nodes(self, run: tuple[int, int, int], k: np.ndarray, q: np.ndarray, g: np.ndarray) -> None:
        """Move the matrices ``q`` of the nodes ``k`` of a run."""
        met = self.tree.blocks(self.met["q"], run)
        new = met[k] + np.einsum("gdm,gdm->gm", g, g) / np.float32(DEPTH + 1)
        met[k] = new
        g *= (-WORD_RATE / np.sqrt(new + CALM))[:, None]
        g += q
        self.tree.blocks(self.q, run)[k] = g

    def step(self, two: np.ndarray, one: np.ndarray, entries: np.ndarray) -> None:
        """One step on the summed gradients of the tokens of a stretch of texts."""
        context, x1, x2, h = self.context(two, one)
        choice = Choice(h)

        def pulled(own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            pull, room = choice.exponent(own)
            np.add(pull, np.float32(NOISE), out=room)
            np.divide(pull, room, out=pull)
            return pull, room

        order = np.argsort(context)  # so that rows of the table are read in turn
        q = self.tree.blocks(self.q, self.tree.runs[0])
        dq, dh = np.zeros((SYMBOLS, DEPTH + 1), np.float32), np.empty_like(h)
        choice.between(q[0], len(order))
        few, symbol = CELLS // SYMBOLS, self.tree.path[entries, 0]
        for t in range(0, len(order), few):
            those = order[t : t + few]
            own = h.take(those, axis=0)
            pull, noise = pulled(own)
            np.take(self.noise_table, context[those], axis=0, out=noise, mode="clip")
            at = np.arange(0, pull.size, SYMBOLS) + symbol[those]
            flat = pull.reshape(-1)
            true = flat[at]
            pull *= noise
            flat[at] += true - 1
            dq += pull.T @ own
            dh[t : t + few] = pull @ q[0].T
        self.move_nodes(self.tree.runs[0], np.zeros(1, np.int64), q, dq.T[None].copy())
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        dh = dh.take(place, axis=0)

        rank = self.tree.rank[entries]
        order = np.argsort(rank)
        rank = rank[order]
        low, h = self.below(entries, rank, order, h)
        h[-1] = 0
        down = np.zeros((len(order) + 1, DEPTH + 1), np.float32)
        for run, k, pieces in self.tree.stacks(entries[order[low:]], rank[low:]):
            q, noise = self.tree.blocks(self.q, run).take(k, axis=0), self.tree.blocks(self.noise, run)[k, None]
            dq = None
            choice.between(q, pieces[0][0].shape[1])
            for token, child in pieces:
                own = h.take(token, axis=0)
                pull, _ = pulled(own)
                at = np.arange(0, pull.size, pull.shape[2]).reshape(child.shape) + child
                flat = pull.reshape(-1)
                true = flat[at]
                pull *= noise
                flat[at] += true - 1
                more = np.matmul(own.swapaxes(1, 2), pull)
                dq = more if dq is None else np.add(dq, more, out=dq)
                down[low + token] += np.matmul(pull, q.swapaxes(1, 2))
            self.move_nodes(run, k, q, dq)
        place[order] = np.arange(len(order))
        dh += down.take(place, axis=0)

        dh = dh[:, :DEPTH]
        d1, d2 = dh @ self.c[:DEPTH].T, dh @ self.c[DEPTH:].T
        self.move("c", slice(None), np.concatenate([x1.T @ dh, x2.T @ dh]))
        # Entry i is the context of tokens i + 1 and i + 2, but that the end stands two before a text's first token.
        first, second = d1[0], d2[:2].copy()
        unusual = np.flatnonzero(two[2:] != entries[:-2]) + 2
        ends = d2[unusual].sum(axis=0)
        d2[unusual] = 0
        dr = np.zeros((len(order), DEPTH), np.float32)
        dr[:-1] = d1[1:]
        dr[:-2] += d2[2:]
        edge = np.flatnonzero(np.append(True, rank[1:] != rank[:-1]))
        dr = np.add.reduceat(dr.take(order, axis=0), edge)
        rest = [(END, ends), (one[0], first), (two[0], second[0]), *((two[1], second[1]) for _ in order[1:2])]
        for entry, g in rest:
            at = np.searchsorted(rank[edge], self.tree.rank[entry])
            if at < len(edge) and rank[edge[at]] == self.tree.rank[entry]:
                dr[at] += g
            else:
                self.move("r", np.array([entry]), g[None])
        self.move("r", entries[order[edge]], dr)


ROWS_SENT = 1 << 14
FREED = 31 << 20


def keep_freed_memory() -> None:
    """Every step makes the same arrays again. The C library gives back to the system what exceeds twice the
    largest array freed so far (of those below 32 MB), and then each step has to fetch its pages anew."""
    np.empty(FREED, np.uint8)


def train_words(encoded: DataFrame, model: WordModel, rounds: int = ROUNDS) -> WordModel:
    """``model`` after all tokens of ``encoded``, in rounds over a part of the texts each."""
    if not model.vocab.n:
        return model
    sc = encoded.sparkSession.sparkContext
    parts = parts_of(model.vocab.n)
    size = int(np.clip(model.vocab.n // (STEPS_A_PART * parts), 1 << 11, BATCH))

    for k in range(rounds):
        shared = sc.broadcast(model)

        def run(batches, shared=shared):
            at, texts = [], []
            for batch in batches:
                at.append(np.asarray(batch.column("at")))
                texts += batch.column("ids").to_pylist()
            if not texts:
                return
            entries = np.frombuffer(b"".join(texts[i] for i in np.argsort(np.concatenate(at), kind="stable")), "<i4")
            two, one = contexts(entries)
            keep_freed_memory()
            old = shared.value
            own = copy.copy(old)
            own.r, own.q, own.c, own.met = old.r.copy(), old.q.copy(), old.c.copy(), {k: v.copy() for k, v in old.met.items()}
            for at in range(0, len(entries), size):
                own.step(two[at : at + size], one[at : at + size], entries[at : at + size])
            for i, name in enumerate("rqc"):
                gain, delta = own.met[name] - old.met[name], getattr(own, name) - getattr(old, name)
                if name == "q":
                    delta = own.tree.by_row(delta)
                for at in range(0, len(gain), ROWS_SENT):
                    here = slice(at, at + ROWS_SENT)
                    yield block_batch([(at // ROWS_SENT, i, gain[here].tobytes(), delta[here].tobytes())])

        def merge(table: pa.Table) -> pa.Table:
            i = table["kind"][0].as_py()
            gains = [np.frombuffer(x, "<f4") for x in table["a"].to_pylist()]
            deltas = [np.frombuffer(x, "<f4").reshape(len(g), -1) for g, x in zip(gains, table["b"].to_pylist())]
            mean = averaged(deltas, gains).astype("<f4")
            return pa.Table.from_batches([block_batch([(table["bucket"][0].as_py(), i, sum(gains).astype("<f4").tobytes(), mean.tobytes())])])

        dealt = encoded.filter(F.col("turn") == k).repartitionById(parts, F.col("part")).select("at", "ids")
        part = dealt.mapInArrow(run, BLOCK).groupBy("kind", "bucket").applyInArrow(merge, BLOCK)
        moved = [(int(x["kind"]), int(x["bucket"]), bytes(x["a"]), bytes(x["b"])) for x in part.toLocalIterator()]
        model.q = model.tree.by_row(model.q)
        for i, bucket, a, b in moved:
            name = "rqc"[i]
            here = slice(bucket * ROWS_SENT, (bucket + 1) * ROWS_SENT)
            model.met[name][here] += np.frombuffer(a, "<f4")
            getattr(model, name)[here] += np.frombuffer(b, "<f4").reshape(-1, getattr(model, name).shape[1])
        model.q = model.tree.by_node(model.q)
        shared.unpersist()
    return model


@dataclass
class Scorer:
    vocab: Vocabulary
    model: WordModel

    def block(self, data: np.ndarray, off: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Fill in what is known here; (key, row) of the tokens whose counts are not."""
        v = self.vocab
        w, keys = word_keys(data, off)
        found, at = v.find(keys)
        entries = v.entries(keys, found, at)
        two, one, entry, row = sequences(w, entries)
        n = len(meta)
        meta["n"] = w.count + 1
        meta["score"] = np.bincount(row, self.model.log_probabilities(two, one, entry) / np.log(10), n)
        row = w.rows()
        log = np.log10(v.counts + ALPHA)
        ends, where = v.find(np.array([END_KEY]))
        end_count = v.counts[where[0]] if ends[0] else 0
        known = np.where(found, log[at], 0.0) if len(log) else np.zeros(len(keys))
        meta["base"] = np.bincount(row, known, n) + np.log10(end_count + ALPHA) - meta["n"] * np.log10(v.n + ALPHA * (v.distinct + 1))
        shared = entries >= len(v.mass) - TAILS * v.slots
        within = known - np.log10(np.where(shared, v.mass[entries], 1.0))
        meta["score"] += np.bincount(row, np.where(shared, within, 0.0), n)
        meta["known"] = np.bincount(row[found], minlength=n) + (end_count > 0)
        return keys[~found], row[~found]


def score(docs: DataFrame, scorer: Scorer, counted: DataFrame, shift: int) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(scorer)

    def run(batches):
        keys, rows, held, meta = [], [], 0, []
        keep_freed_memory()

        def flush():
            k, r = np.concatenate(keys), np.concatenate(rows)
            order = np.argsort(k, kind="stable")
            return block_batch([(b, 1, x, y) for b, x, y in slices(k[order], shift, r[order])] + [(i % (1 << (64 - shift)) if shift < 64 else 0, 2, m.tobytes(), b"") for i, m in enumerate(meta)])

        for batch in batches:
            ids = batch.column("doc_id").cast(pa.int64())
            own = np.asarray(batch.column("row"))
            for a, b, data, off in W.blocks(batch.column("text")):
                m = np.zeros(b - a, META)
                m["row"], m["doc"], m["none"] = own[a:b], np.asarray(ids.slice(a, b - a).fill_null(0)), np.asarray(ids.slice(a, b - a).is_null())
                m["held"] = np.asarray(batch.column("held").slice(a, b - a))
                k, r = shared.value.block(data, off, m)
                keys.append(k)
                rows.append(own[a:b][r])
                meta.append(m)
                held += len(k)
                if held > FLUSH:
                    yield flush()
                    keys, rows, held, meta = [], [], 0, []
        if meta:
            yield flush()

    def look_up(table: pa.Table) -> pa.Table:
        kind, a, b = table["kind"].to_pylist(), table["a"].to_pylist(), table["b"].to_pylist()
        keys, counts = next(((np.frombuffer(x, "<u8"), np.frombuffer(y, "<i8")) for k, x, y in zip(kind, a, b) if k == 0), (np.zeros(0, U), np.zeros(0, np.int64)))
        out = []
        for k, x, y in zip(kind, a, b):
            if k == 1:
                ask, row = np.frombuffer(x, "<u8"), np.frombuffer(y, "<i8")
                c = np.zeros(len(ask), np.int64)
                if len(keys):
                    at = np.minimum(np.searchsorted(keys, ask), len(keys) - 1)
                    c = np.where(keys[at] == ask, counts[at], 0)
                rows, i = np.unique(row, return_inverse=True)
                part = np.zeros(len(rows), PART)
                part["row"], part["known"], part["log"] = rows, np.bincount(i, c > 0), np.bincount(i, np.log10(c + ALPHA))
                out.append((int(rows[0] >> 33), 1, part.tobytes(), b""))
            elif k == 2:
                out.append((int(np.frombuffer(x, META)["row"][0] >> 33), 2, x, b""))
        return pa.Table.from_batches([block_batch(out)])

    def collect(table: pa.Table) -> pa.Table:
        kind, a = np.asarray(table["kind"]), table["a"].to_pylist()
        meta = np.concatenate([np.frombuffer(x, META) for k, x in zip(kind, a) if k == 2])
        meta = meta[np.argsort(meta["row"])]
        for x in (x for k, x in zip(kind, a) if k == 1):
            part = np.frombuffer(x, PART)
            at = np.searchsorted(meta["row"], part["row"])
            meta["known"][at] += part["known"]
            meta["base"][at] += part["log"]
            meta["score"][at] += part["log"]
        n = np.full(len(meta), shared.value.vocab.n)
        return pa.table({"doc_id": pa.array(meta["doc"], mask=meta["none"]), "held_out": meta["held"], "n_tokens": meta["n"], "n_known": meta["known"], "train_tokens": n, "base_score": meta["base"], "score": meta["score"]})

    asked = docs.select("doc_id", "text", "held", F.monotonically_increasing_id().alias("row")).mapInArrow(run, BLOCK)
    found = counted.unionByName(asked).groupBy("bucket").applyInArrow(look_up, BLOCK)
    return found.groupBy("bucket").applyInArrow(collect, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def fit(docs: DataFrame, shift: int) -> tuple[Scorer, DataFrame]:
    """The model of the texts of ``docs``, and their counts in buckets."""
    counted = written(count_words(docs, shift), "words")
    vocab = vocabulary(counted)
    texts = written(encoded(docs, vocab, ROUNDS), "word-ids")
    table = np.exp(train(count_trigrams(texts, vocab)).log_probabilities()).astype(np.float32)
    return Scorer(vocab, train_words(texts, WordModel(vocab, Tree(vocab), table))), counted


def score_documents(docs: DataFrame) -> DataFrame:
    """Train on the texts that are not held out, score all."""
    buckets = max(16, input_bytes(docs) // BUCKET_BYTES)
    shift = 64 - int(buckets - 1).bit_length()
    ids = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    split = docs.select("doc_id", "text", (F.crc32(ids) % 10 == 0).alias("held"))
    scorer, counted = fit(split.filter("NOT held"), shift)
    return score(split, scorer, counted, shift)
