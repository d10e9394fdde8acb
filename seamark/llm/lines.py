"""Line dedup by two Bloom filters and an exact check of the suspects.

The key of a line is the line stripped of ``[\\x20\\x09-\\x0D]`` with A-Z lower-cased. Keys of
``LEAST_CHARS`` code points found in ``LEAST_DOCS`` documents lose all their lines but those of
the document with the largest doc_id that holds them.

First pass: every task marks its keys in a filter of once-seen hashes, and those that two of
its documents hold in one of twice-seen hashes; only the set bits travel, in segments of 65,536
bits, as positions while few. Merged, a bit is twice-seen if some task says so or two tasks saw
it once. So every key of two documents has all its bits twice-seen, whatever the filter's size.
Second pass: keys whose bits are all twice-seen are suspects; only these shuffle, as 128-bit
digests with their doc_id, for the exact count and the choice of the document that keeps them.

The filter has a bit for every ``BYTES_PER_BIT`` bytes of input, ``MOST_BITS`` at most (64 MB,
the bound of what is broadcast). Beyond about a terabyte of text it fills up, and then more and
more single lines shuffle as suspects; the result stays exact.

A null text counts as empty: one empty line. Rows that share a doc_id count as one document;
rows without one are together one document, smaller than all others. Other columns pass through.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seamark.llm import words as W
from seamark.llm.common import input_bytes
from seamark.llm.words import U

LEAST_CHARS, LEAST_DOCS = 40, 5
PROBES = 3
BYTES_PER_BIT = 4
LEAST_BITS, MOST_BITS = 1 << 20, 1 << 29
SEGMENT = 1 << 16
BLANKS = b" \t\n\x0b\x0c\r"


def filter_bits(docs: DataFrame) -> int:
    want = max(1, input_bytes(docs) // BYTES_PER_BIT)
    return min(MOST_BITS, max(LEAST_BITS, 1 << (want - 1).bit_length()))


def positions(hashes: np.ndarray, bits: int) -> np.ndarray:
    """One row of ``PROBES`` bit positions for each hash."""
    step = (hashes >> U(32)) | U(1)
    return ((hashes[:, None] + step[:, None] * np.arange(PROBES, dtype=U)) & U(bits - 1)).astype(np.int64)


def line_keys(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, hash, row) of the long enough keys of a block, each once a row."""
    start, end, row = W.line_spans(data, off)
    w = W.Words(data, off)
    a, b = np.searchsorted(w.start, start), np.searchsorted(w.start, end)
    some = a < b
    start, end, row = w.start[a[some]], w.end[b[some] - 1], row[some]
    chars = np.zeros(len(data) + 1, np.int64)
    np.cumsum(~W.CONTINUATION[data], out=chars[1:])
    long = chars[end] - chars[start] >= LEAST_CHARS
    start, end, row = start[long], end[long], row[long]
    hashes = W.Hasher(W.LOWER[data]).spans(start, end)
    first = np.unique(hashes ^ W.mix(row.astype(U) + U(1)), return_index=True)[1]
    return start[first], end[first], hashes[first], row[first]


def pack(low: np.ndarray) -> bytes:
    """Set bits of a segment: sorted 16-bit positions, or the bitmap where that is shorter."""
    if len(low) < SEGMENT // 16:
        return low.astype("<u2").tobytes()
    bits = np.zeros(SEGMENT, bool)
    bits[low] = True
    return np.packbits(bits).tobytes()


def unpack(packed: bytes) -> np.ndarray:
    if len(packed) < SEGMENT // 8:
        bits = np.zeros(SEGMENT, bool)
        bits[np.frombuffer(packed, "<u2")] = True
        return bits
    return np.unpackbits(np.frombuffer(packed, np.uint8)).astype(bool)


def segments(once: np.ndarray, twice: np.ndarray):
    """(segment, once, twice) of sorted distinct bit positions."""
    ids = np.unique(once // SEGMENT)
    for s, a, b, c, d in zip(ids, *(np.searchsorted(x, (ids + k) * SEGMENT) for x in (once, twice) for k in (0, 1))):
        yield int(s), pack(once[a:b] - s * SEGMENT), pack(twice[c:d] - s * SEGMENT)


def twice_seen(docs: DataFrame, bits: int) -> np.ndarray:
    """The merged filter of twice-seen hashes, as bytes of 8 bits."""

    def mark(batches):
        seen = [np.zeros(0, U)]
        for batch in batches:
            for _, _, data, off in W.blocks(batch.column("text")):
                seen.append(line_keys(data, off)[2])
        keys, n = np.unique(np.concatenate(seen), return_counts=True)
        rows = list(segments(np.unique(positions(keys, bits)), np.unique(positions(keys[n > 1], bits))))
        columns = list(zip(*rows)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.binary()), pa.array(columns[2], pa.binary())], ["segment", "once", "twice"])

    def merge(table: pa.Table) -> pa.Table:
        times, twice = np.zeros(SEGMENT, np.int32), np.zeros(SEGMENT, bool)
        for once, two in zip(table["once"].to_pylist(), table["twice"].to_pylist()):
            times += unpack(once)
            twice |= unpack(two)
        twice |= times > 1
        return pa.table({"segment": table["segment"][:1], "bits": pa.array([pack(np.flatnonzero(twice))] if twice.any() else [None], pa.binary())})

    marked = docs.select("text").mapInArrow(mark, "segment int, once binary, twice binary")
    merged = marked.groupBy("segment").applyInArrow(merge, "segment int, bits binary").filter("bits IS NOT NULL")
    out = np.zeros(bits // 8, np.uint8)
    for r in merged.toLocalIterator():
        at = r["segment"] * (SEGMENT // 8)
        out[at : at + SEGMENT // 8] = np.packbits(unpack(bytes(r["bits"])))
    return out


def digest(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def suspects(docs: DataFrame, bits: int, twice: np.ndarray) -> DataFrame:
    """(key digest, doc_id) of the keys that the filter takes for repeats."""
    shared = docs.sparkSession.sparkContext.broadcast(twice)

    def run(batches):
        for batch in batches:
            ids = batch.column("doc_id").cast(pa.int64())
            for a, _, data, off in W.blocks(batch.column("text")):
                start, end, hashes, row = line_keys(data, off)
                at = positions(hashes, bits)
                hit = np.flatnonzero((shared.value[at >> 3] & (128 >> (at & 7)).astype(np.uint8)).all(axis=1))
                low = W.LOWER[data].tobytes() if len(hit) else b""
                yield pa.RecordBatch.from_arrays([pa.array([digest(low[start[i] : end[i]]) for i in hit], pa.binary()), ids.take(pa.array(row[hit] + a))], ["key", "doc_id"])

    return docs.select("doc_id", "text").mapInArrow(run, "key binary, doc_id long")


def repeats(docs: DataFrame) -> DataFrame:
    """One row a document that loses lines: doc_id, and the digests of the keys it loses."""
    bits = filter_bits(docs)
    found = suspects(docs, bits, twice_seen(docs, bits)).distinct()
    keep = found.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("keep")).filter(F.col("n") >= LEAST_DOCS).drop("n")
    return found.join(keep, "key").filter("NOT doc_id <=> keep").groupBy("doc_id").agg(F.collect_list("key").alias("lost"))


def without(text: str, lost: set[bytes]) -> tuple[str, int]:
    """The text without the lines of the lost keys, and their number."""
    kept = []
    lines = text.split("\n")
    for line in lines:
        key = line.encode().strip(BLANKS).lower()
        if not lost or len(key) < LEAST_CHARS or digest(key) not in lost:
            kept.append(line)
    return "\n".join(kept), len(lines) - len(kept)


def dedup_lines(docs: DataFrame, n_lines: str = "n_lines", n_dropped: str = "n_dropped") -> DataFrame:
    """``docs`` with repeated lines gone from text (null becomes empty) and two counts added.

    The counts take the place of columns of ``docs`` that have their names.
    """
    mark = "lost"
    while mark in docs.columns:
        mark += "_"
    lost = repeats(docs).withColumnsRenamed({"doc_id": "lost_from", "lost": mark})
    texts = docs.drop(n_lines, n_dropped)
    joined = texts.join(lost, texts["doc_id"].eqNullSafe(lost["lost_from"]), "left").select(*[texts[c] for c in texts.columns], lost[mark])

    def run(batches):
        for batch in batches:
            new, lines, dropped = [], [], []
            for text, keys in zip(batch.column("text").to_pylist(), batch.column(mark).to_pylist()):
                text = text or ""
                lines.append(text.count("\n") + 1)
                kept, n = without(text, set(keys)) if keys else (text, 0)
                new.append(kept)
                dropped.append(n)
            columns = {c: batch.column(c) for c in batch.schema.names if c != mark}
            columns["text"] = pa.array(new, pa.string())
            columns |= {n_lines: pa.array(lines, pa.int64()), n_dropped: pa.array(dropped, pa.int64())}
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in texts.schema)
    return joined.mapInArrow(run, f"{fields}, `{n_lines}` long, `{n_dropped}` long")
