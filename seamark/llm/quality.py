"""Quality rules: text statistics and a hashed n-gram log-likelihood ratio per document.

Two multinomials over ``BUCKETS`` hashed word unigrams and bigrams are counted: the
raw corpus (every word of every document) and the trusted target (documents that
``labels`` calls good, at most ``TRUSTED_DOCS`` of them, the smallest by hash of
doc_id). A document's score is the mean over its n-grams of
``log((target + 1) / (expected target at the raw rate + 1))``; rare buckets count
little on either side.

The verdict is deterministic: a document is kept unless a base rule fails or its
score lies more than ``SLACK + SLACK_WORDS / sqrt(words)`` below the median score of
the trusted documents held out of the fit (one in twenty). Without trusted documents
all scores are 0 and only the base rules decide.

Nulls count as empty texts, an empty text has 0 words and fails the base rule.
Repeated rows give repeated results. Columns besides doc_id and text are ignored by
``quality`` and passed through by ``keep_good``. Rows of ``labels`` with a null
doc_id or quality are not trusted.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seamark.llm import words as W
from seamark.llm.words import U

BUCKETS = 1 << 16
TRUSTED_DOCS = 50_000
WINDOW = 8
SLACK, SLACK_WORDS = 0.08, 0.5

SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True

STATS = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, score double"


def duplicates(keys: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """By row, how many of its keys equal an earlier one of the same row."""
    own = keys ^ W.mix(row.astype(U) + U(1))
    order = np.argsort(own, kind="stable")
    again = own[order][1:] == own[order][:-1]
    return np.bincount(row[order[1:][again]], minlength=rows)


def repeated_words(w: W.Words, hashes: np.ndarray) -> np.ndarray:
    """By row, words inside ``WINDOW``-word windows that its text holds at least twice."""
    windows, at = W.grams(hashes, w.at, WINDOW)
    if len(windows) == 0:
        return np.zeros(len(w.count), np.int64)
    count = np.diff(at)
    row = np.repeat(np.arange(len(count)), count)
    own = windows ^ W.mix(row.astype(U) + U(1))
    order = np.argsort(own, kind="stable")
    same = own[order][1:] == own[order][:-1]
    twice = np.zeros(len(own), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    first = np.flatnonzero(twice)
    first = first - at[row[first]] + w.at[row[first]]
    edge = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(edge, first, 1)
    np.add.at(edge, first + WINDOW, -1)
    return W.per_doc(np.cumsum(edge[:-1]) > 0, w.at)


def line_repeats(w: W.Words, hasher: W.Hasher) -> np.ndarray:
    """By row, lines with a word that equal an earlier line."""
    start, end, row = W.line_spans(w.data, w.off)
    filled = np.searchsorted(w.start, end) > np.searchsorted(w.start, start)
    return duplicates(hasher.spans(start[filled], end[filled]), row[filled], len(w.count))


def features(w: W.Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, row) of every unigram and bigram of a block."""
    pairs, at = W.grams(hashes, w.at, 2)
    row = np.concatenate([w.rows(), np.repeat(np.arange(len(w.count)), np.diff(at))])
    return (np.concatenate([hashes, pairs]) >> U(48)).astype(np.int64), row


@dataclass(frozen=True)
class Ratio:
    """Log-likelihood ratio by bucket, and the median score of held-out trusted documents."""

    log_ratio: np.ndarray
    middle: float

    def scores(self, w: W.Words, hashes: np.ndarray) -> np.ndarray:
        bucket, row = features(w, hashes)
        n = len(w.count)
        return np.bincount(row, self.log_ratio[bucket], n) / np.maximum(np.bincount(row, minlength=n), 1)

    def good(self, n_words: np.ndarray, repeat: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        failed = (n_words < 20) | (100 * repeat > 30 * n_words)
        return failed, ~failed & (score >= self.middle - SLACK - SLACK_WORDS / np.sqrt(np.maximum(n_words, 1)))


def count_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for batch in batches:
        trusted = np.asarray(batch.column("trusted").fill_null(False))
        for a, b, data, off in W.blocks(batch.column("text")):
            w = W.Words(data, off)
            bucket, row = features(w, W.Hasher(data).spans(w.start, w.end))
            raw += np.bincount(bucket, minlength=BUCKETS)
            target += np.bincount(bucket[trusted[a:b][row]], minlength=BUCKETS)
    some = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(raw[some]), pa.array(target[some])], ["bucket", "raw", "target"])


def fit(docs: DataFrame, labels: DataFrame) -> Ratio:
    """Counts over all of ``docs``; what comes to the driver is one row a bucket."""
    spark = docs.sparkSession
    chosen = (
        labels.filter("quality = 1 AND doc_id IS NOT NULL")
        .select(F.col("doc_id").cast("long").alias("doc_id"))
        .distinct()
        .select("doc_id", F.xxhash64("doc_id").alias("h"))
        .orderBy("h", "doc_id")
        .limit(TRUSTED_DOCS)
        .withColumn("held", F.pmod("h", F.lit(20)) == 0)
        .toPandas()
    )
    chosen = spark.createDataFrame(chosen[["doc_id", "held"]].values.tolist(), "doc_id long, held boolean")
    fitted, held = chosen.filter("NOT held").select("doc_id"), chosen.filter("held").select("doc_id")
    texts = docs.select("doc_id", "text")
    flagged = texts.join(F.broadcast(fitted.withColumn("trusted", F.lit(True))), "doc_id", "left")
    sums = (
        flagged.select("text", "trusted")
        .mapInArrow(count_buckets, "bucket int, raw long, target long")
        .groupBy("bucket")
        .agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
        .toPandas()
    )
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    raw[sums["bucket"]], target[sums["bucket"]] = sums["raw"], sums["target"]
    if target.sum() == 0:
        return Ratio(np.zeros(BUCKETS), 0.0)
    ratio = Ratio(np.log((target + 1) / (raw * (target.sum() / raw.sum()) + 1)), 0.0)
    trial = measure(texts.join(F.broadcast(held), "doc_id", "left_semi"), ratio).filter("n_words >= 20")
    middle = trial.agg(F.percentile_approx("score", F.lit(0.5), F.lit(10_000))).first()[0]
    return Ratio(ratio.log_ratio, float(middle or 0.0))


def block_stats(data: np.ndarray, off: np.ndarray, ratio: Ratio) -> dict[str, np.ndarray]:
    w = W.Words(data, off)
    hasher = W.Hasher(data)
    hashes = hasher.spans(w.start, w.end)
    return {
        "n_words": w.count,
        "word_chars": W.per_doc(w.inside & ~W.CONTINUATION[data], off),
        "n_symbols": W.per_doc(SYMBOL[data], off),
        "n_dup_lines": line_repeats(w, hasher),
        "n_repeat_words": repeated_words(w, hashes),
        "score": ratio.scores(w, hashes),
    }


def measure(docs: DataFrame, ratio: Ratio) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(ratio)

    def run(batches):
        for batch in batches:
            for a, b, data, off in W.blocks(batch.column("text")):
                s = block_stats(data, off, shared.value)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a).cast(pa.int64())] + [pa.array(v) for v in s.values()], ["doc_id", *s]
                )

    return docs.select("doc_id", "text").mapInArrow(run, STATS)


def quality(docs: DataFrame, ratio: Ratio) -> DataFrame:
    """One row a document: its statistics, ``score``, ``base_failed`` and ``kept``."""
    floor = F.lit(ratio.middle - SLACK) - F.lit(SLACK_WORDS) / F.sqrt(F.greatest("n_words", F.lit(1)))
    return (
        measure(docs, ratio)
        .withColumn("base_failed", F.expr("n_words < 20 OR 100 * n_repeat_words > 30 * n_words"))
        .withColumn("kept", ~F.col("base_failed") & (F.col("score") >= floor))
    )


def keep_good(docs: DataFrame, ratio: Ratio) -> DataFrame:
    """The rows of ``docs`` that ``quality`` keeps, all columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(ratio)

    def run(batches):
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for a, b, data, off in W.blocks(batch.column("text")):
                w = W.Words(data, off)
                hashes = W.Hasher(data).spans(w.start, w.end)
                keep[a:b] = shared.value.good(w.count, repeated_words(w, hashes), shared.value.scores(w, hashes))[1]
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
