"""Best-fit packing of tokenised documents by exact-complement hashing.

Lengths are at most ``CAPACITY``, so the plan is made on the count of pieces by length, a
table of ``CAPACITY`` rows whatever the corpus. From the longest length down, a length looks up
its gap among the sums of one, two and three available lengths and consumes as many such
combinations as the counts allow. What finds no exact complement is placed best-fit: the
longest first, each into the open sequence with the smallest gap that holds it. A plan is a list
of patterns (lengths in order) with how often each is used.

Pieces then meet the plan by rank among the pieces of their length. Ranks come from counts
by (length, bucket), with buckets of a bounded number of pieces, so a length that many pieces
share is ranked in many tasks.

Token ids are those of the ``tokenizers`` library for the whole text. Texts are split at spaces
that precede a visible character, where every match of a byte-level tokenizer's pattern
begins, and a bounded memo in each worker keeps the ids of words already seen. Texts that hold an added
token of the tokenizer (``<|endoftext|>``) go to the library whole, which gives that token its one id.

Nulls count as empty texts: the final id alone. Each row is a document of its own; repeated
rows are packed once each. Other columns are ignored.
"""

from __future__ import annotations

import functools
import os
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seamark.llm.common import written

CAPACITY = 2048
MEMO = 500_000
TOGETHER = 64
BUCKET_ROWS = 10_000
SPACE, FEED = "\u0120", "\u010a"  # a space and a line feed in the vocabulary of byte-level tokenizers
SPLIT = re.compile("\x20(?=[^\\s\u180e])")


def even(text: str) -> bool:
    """Single spaces and line feeds between visible characters, and no other blanks?"""
    return (
        text != ""
        and text.replace("\n", "").isprintable()
        and not any(x in text for x in ("  ", " \n", "\n ", "\n\n"))
        and text[0] not in " \n"
        and text[-1] not in " \n"
    )


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # The memo takes the place of the library's own cache of words, which is smaller.
        getattr(self.tokenizer.model, "_resize_cache", lambda _: None)(0)
        self.memo: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}  # the memo before; what is met again moves over
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.marks = dict(zip(",.", self.whole([",", "."])))
        vocabulary = self.tokenizer.get_vocab()
        self.begins = {}
        for mark in (SPACE, FEED):
            self.begins[mark] = np.zeros(max(vocabulary.values()) + 1, bool)
            self.begins[mark][[i for t, i in vocabulary.items() if t.startswith(mark)]] = True

    def learn(self, words: list[str]) -> None:
        """Words of one leading space, or line feed, and no other are encoded as one text, in
        which the tokens with a leading space, or line feed, begin a word; the others one by one."""
        fed = [w for w in words if w[0] == "\n"]
        spaced = [w for w in words if w[0] != "\n" and " " not in w and "\n" not in w]
        for mark, several, text in ((FEED, fed, "".join(fed)), (SPACE, spaced, " " + " ".join(spaced))):
            if several:
                ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
                at = np.append(np.flatnonzero(self.begins[mark][ids]), len(ids)) * 4
                raw = ids.tobytes()
                self.memo.update(zip(several, map(raw.__getitem__, map(slice, at[:-1].tolist(), at[1:].tolist()))))
        other = [w for w in words if w[0] != "\n" and (" " in w or "\n" in w)]
        self.memo.update(zip(other, self.whole([" " + w for w in other])))

    def whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def extended(self, word: str) -> bool:
        """Take a known word that ends in a letter, and the comma or full stop after it, which is a match of its own."""
        mark = self.marks.get(word[-1])
        if mark is None or not word[-2:-1].isalpha() or word[-2] >= "\u0250":
            return False
        known = self.memo.get(word[:-1]) or self.old.get(word[:-1])
        if known:
            self.memo[word] = known + mark
        return bool(known)

    def look_up(self, words: list[str]) -> list[bytes]:
        """Ids of words that each follow a space, or begin with a line feed that stands alone."""
        found = list(map(self.memo.get, words))
        lacking = [i for i, ids in enumerate(found) if ids is None]
        if lacking:
            new = {words[i] for i in lacking}
            if len(self.memo) + len(new) > MEMO:
                self.old, self.memo = self.memo, {}
            again = new & self.old.keys()
            self.memo.update(zip(again, map(self.old.__getitem__, again)))
            self.learn([w for w in new - again if not self.extended(w)])
            for i in lacking:
                found[i] = self.memo[words[i]]
        return found

    def ids(self, texts: list[str]) -> list[bytes]:
        """Ids of each text; what is not in the memo is encoded together."""
        words: list[str] = []
        starts: list[bytes | None] = []
        edges = [0]
        for text in texts:
            if self.added is not None and self.added.search(text):
                starts.append(self.whole([text])[0])
            # An even text can follow a line feed, whose one id is taken off again.
            elif even(text):
                words += ("\n" + text.replace("\n", " \n")).split(" ")
                starts.append(None)
            else:
                parts = SPLIT.split(text)
                starts.append(self.whole(parts[:1])[0])
                words += parts[1:]
            edges.append(len(words))
        found: list[bytes] = []
        for i in range(0, len(words), MEMO // 2):
            found += self.look_up(words[i : i + MEMO // 2])
        joined = [b"".join(found[i:j]) for i, j in zip(edges, edges[1:])]
        return [ids[4:] if start is None else start + ids for start, ids in zip(starts, joined)]


@functools.lru_cache(2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens; the first takes what full pieces leave."""
    first = n % capacity or capacity
    return [(0, min(first, n))] + [(s, capacity) for s in range(first, n, capacity)]


PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, path: str) -> DataFrame:
    """One row a piece of at most ``CAPACITY`` tokens."""

    def run(batches):
        enc = encoder(path)
        for batch in batches:
            rows, which = [], []
            texts = batch.column("text").cast(pa.large_string()).fill_null("").to_pylist()
            for at in range(0, len(texts), TOGETHER):
                for i, raw in enumerate(enc.ids(texts[at : at + TOGETHER]), at):
                    ids = memoryview(raw + b"\0\0\0\0")
                    for k, (s, n) in enumerate(cut(len(ids) // 4)):
                        rows.append((k, s, n, zlib.crc32(ids[4 * s : 4 * (s + n)])))
                        which.append(i)
            piece, start, length, crc = np.array(rows, np.int64).reshape(-1, 4).T
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()).take(pa.array(which, pa.int64())), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc)],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, PIECE)


class Stock:
    """Available pieces by length, and what combinations of them sum to."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.left = np.zeros(capacity + 1, np.int64)
        for length, n in counts.items():
            self.left[length] = n

    def pair(self, total: int, *used: int) -> tuple[int, int] | None:
        """Two available lengths of that sum besides those in use, the larger first and largest."""
        if total < 2:
            return None
        left = self.left[: total + 1]
        x = np.arange(total - 1, (total - 1) // 2, -1)
        both = (left[x] > 0) & (left[total - x] > 0)
        for i in np.flatnonzero(both):
            got = (int(x[i]), total - int(x[i]))
            if self.fits((*used, *got)):
                return got
        return None

    def fits(self, pattern: tuple[int, ...]) -> bool:
        return all(self.left[v] >= pattern.count(v) for v in set(pattern))

    def complement(self, length: int, capacity: int) -> tuple[int, ...] | None:
        """One, two or three available lengths that fill the gap exactly."""
        gap = capacity - length
        if gap == 0:
            return ()
        if self.fits((length, gap)):
            return (gap,)
        if (two := self.pair(gap, length)) is not None:
            return two
        held = np.flatnonzero(self.left[:gap])[::-1]
        for x in held:
            if 3 * x < gap:
                break
            if self.fits((length, int(x))) and (two := self.pair(gap - int(x), length, int(x))) is not None:
                return (int(x), *two)
        return None

    def take(self, pattern: tuple[int, ...]) -> int:
        """Consume the pattern as often as the counts allow."""
        times = min(int(self.left[v]) // pattern.count(v) for v in set(pattern))
        for v in pattern:
            self.left[v] -= times
        return times


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Patterns and their numbers of uses that hold all pieces."""
    stock = Stock(counts, capacity)
    out = []
    for length in range(capacity, 0, -1):
        while stock.left[length] and (rest := stock.complement(length, capacity)) is not None:
            pattern = (length, *rest)
            out.append((pattern, stock.take(pattern)))
    open_: dict[int, dict[tuple[int, ...], int]] = defaultdict(lambda: defaultdict(int))
    for length in range(capacity, 0, -1):
        n = int(stock.left[length])
        while n:
            gap = next((g for g in range(length, capacity) if open_.get(g)), None)
            if gap is None:
                fit = capacity // length
                if n >= fit:
                    open_[capacity - fit * length][(length,) * fit] += n // fit
                n = n % fit if n >= fit else n
                if n:
                    open_[capacity - n * length][(length,) * n] += 1
                n = 0
                continue
            pattern, m = next(iter(open_[gap].items()))
            fit = min(gap // length, n)
            times = min(m, n // fit)
            if times == m:
                del open_[gap][pattern]
            else:
                open_[gap][pattern] -= times
            open_[gap - fit * length][pattern + (length,) * fit] += times
            n -= fit * times
    return out + [(p, m) for by in open_.values() for p, m in by.items()]


def slots(patterns: list[tuple[tuple[int, ...], int]]) -> np.ndarray:
    """Rows (length, first rank, first sequence, offset), in order of length and rank."""
    used: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for pattern, times in patterns:
        at = 0
        for length in pattern:
            rows.append((length, used[length], sequence, at))
            used[length] += times
            at += length
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def ranked(cut_pieces: DataFrame) -> DataFrame:
    """Rank of each piece among those of its length, from 0."""
    buckets = max(1, -(-cut_pieces.count() // BUCKET_ROWS))
    dealt = cut_pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)))
    counts = dealt.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("bucket")) - F.col("n")
    own = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    return dealt.join(counts.select("length", "bucket", before.alias("before")), ["length", "bucket"]).withColumn("rank", F.row_number().over(own) - 1 + F.col("before"))


def pack(docs: DataFrame, path: str) -> DataFrame:
    """Every piece with its sequence and place."""
    held = written(pieces(docs, path), "pieces")
    counts = {r["length"]: r["n"] for r in held.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    table = docs.sparkSession.sparkContext.broadcast(slots(plan(counts)))

    def place(batches):
        length, first, sequence, offset = table.value.T
        key = length << 44 | first
        for batch in batches:
            own, rank = (np.asarray(batch.column(c)).astype(np.int64) for c in ("length", "rank"))
            i = np.searchsorted(key, own << 44 | rank, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")] + [pa.array(sequence[i] + rank - first[i]), pa.array(offset[i])],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return ranked(held).select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(place, f"{PIECE}, sequence_id long, offset long")
