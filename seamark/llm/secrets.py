"""Secret scan: three fixed patterns, and a battery of randomness tests on key-like strings.

Candidates of the battery are maximal runs of ``[A-Za-z0-9+/_-]`` (with trailing ``=``)
of ``LEAST`` characters or more that hold a letter and a digit and overlap no base span.
The encoding is the smallest known alphabet that holds them. Under "random characters of
that alphabet" three p-values follow: chi-squared of the character counts, runs above and
below the middle of the alphabet, and lag-1 serial correlation; Fisher's rule joins them,
and a candidate below ``PASS`` is not random.

Reports are discoveries against "ordinary string": the chi-squared statistic of letters as
uneven as prose (``PROSE``: sums of squared and cubed letter shares) has a known mean and
variance at each length, and a candidate's p-value is the chance that such a string looks
as even as it does. Short strings reach no small p-value. Benjamini-Hochberg's rule runs over
all candidates of the corpus in a length band at ``FDR``, on p-values rounded up to steps of
a fifth of a decade, so what comes to the driver is a bounded table of counts.

Offsets are code points, ends exclusive. Nulls count as empty texts, which hold no span.
Each row is scanned alone; repeated rows repeat. Other columns are ignored by ``scan``
and passed through by ``redact``.
"""

from __future__ import annotations

import hashlib
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seamark.llm.common import written

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api")

LEAST = 20
FDR = 0.05
PASS = 0.01
STEPS, DEEPEST = 5, 60
#: Sums of squared and of cubed character shares of prose, by alphabet size up to the first figure.
PROSE = ((16, 0.13, 0.02), (99, 0.0655, 0.0053))
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{%d,}={0,2}" % LEAST)
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ENCODINGS = (
    DIGITS + "abcdef",
    DIGITS + "ABCDEF",
    UPPER + "234567",
    DIGITS + LOWER,
    DIGITS + UPPER,
    UPPER + LOWER + DIGITS,
    UPPER + LOWER + DIGITS + "+/",
    UPPER + LOWER + DIGITS + "-_",
    UPPER + LOWER + DIGITS + "+/-_",
)
LETTERS = UPPER + LOWER
CODES = tuple({c: i for i, c in enumerate(a)} for a in ENCODINGS)
SETS = tuple(frozenset(a) for a in ENCODINGS)
BANDS = 16

SPAN = "struct<start: int, kind: int, end: int>"
SCAN = f"doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, base array<{SPAN}>, found array<struct<start: int, end: int, band: int, level: int>>"


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, in order."""
    out = []
    if "=" in text or ":" in text:
        low = text.lower()
        if any(w in low for w in ASSIGN_WORDS):
            out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def upper_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def randomness(key: str) -> tuple[int, int] | None:
    """(length band, level) of a candidate: the p-value against an ordinary string is at most
    ``10 ** (-level / STEPS)``, and level 0 is not random. None without a letter and a digit."""
    body = key.rstrip("=")
    used = frozenset(body)
    if used.isdisjoint(DIGITS) or used.isdisjoint(LETTERS):
        return None
    which = next(i for i, s in enumerate(SETS) if used <= s)
    code, size, n = CODES[which], len(ENCODINGS[which]), len(body)
    band = min(BANDS - 1, max(0, int(2 * math.log2(n / LEAST))))
    values = [code[c] for c in body]
    even = sum(body.count(c) ** 2 for c in used) * size / n - n
    p_even = upper_tail((even - (size - 1)) / math.sqrt(2 * (size - 1) * (n - 1) / n))
    high = [v >= size / 2 for v in values]
    above = sum(high)
    p_runs = 0.0
    if 0 < above < n:
        mean = 2 * above * (n - above) / n + 1
        var = (mean - 1) * (mean - 2) / (n - 1)
        runs = 1 + sum(a != b for a, b in zip(high, high[1:]))
        p_runs = 2 * upper_tail(abs(runs - mean) / math.sqrt(var)) if var > 0 else 1.0
    centred = [v - (size - 1) / 2 for v in values]
    serial = sum(a * b for a, b in zip(centred, centred[1:])) / sum(v * v for v in centred) * math.sqrt(n)
    s = -sum(math.log(min(max(p, 1e-12), 1.0)) for p in (p_even, p_runs, 2 * upper_tail(abs(serial))))
    if math.exp(-s) * (1 + s + s * s / 2) < PASS:
        return band, 0
    _, two, three = next(x for x in PROSE if size <= x[0])
    mean = size * (1 + (n - 1) * two) - n
    sd = size / n * math.sqrt(2 * n * (n - 1) * (two + 2 * (n - 2) * three - (2 * n - 3) * two * two))
    p = upper_tail((mean - even) / sd)
    return band, min(DEEPEST, int(-STEPS * math.log10(max(p, 1e-99))))


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int]]:
    out, at = [], 0
    ends = sorted((s, e) for s, _, e in base)
    for m in CANDIDATE.finditer(text):
        while at < len(ends) and ends[at][1] <= m.start():
            at += 1
        if any(s < m.end() and m.start() < e for s, e in ends[at : at + 4]):
            continue
        if (seen := randomness(m.group())) is not None:
            out.append((m.start(), m.end(), *seen))
    return out


def name_spans(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def texts_of(batch: pa.RecordBatch) -> list[str]:
    return batch.column("text").cast(pa.large_string()).fill_null("").to_pylist()


def scan(docs: DataFrame) -> DataFrame:
    """One row a document: counts, digest and array of base spans, and its candidates with band and level."""
    span = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
    key = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("band", pa.int32()), ("level", pa.int32())]))

    def run(batches):
        for batch in batches:
            counts, digests, spans, found = [[], [], []], [], [], []
            for text in texts_of(batch):
                base = base_spans(text)
                for k in range(3):
                    counts[k].append(sum(s[1] == k for s in base))
                digests.append(hashlib.sha256(name_spans(base).encode()).hexdigest())
                spans.append([{"start": s, "kind": k, "end": e} for s, k, e in base])
                found.append([{"start": s, "end": e, "band": b, "level": v} for s, e, b, v in candidates(text, base)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()), pa.array(spans, span), pa.array(found, key)],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "base", "found"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, SCAN)


def cuts(scanned: DataFrame) -> dict[int, int]:
    """Least level reported, by length band; at most ``BANDS * (DEEPEST + 1)`` counts come to the driver."""
    counts = scanned.select(F.explode("found").alias("c")).groupBy("c.band", "c.level").count().collect()
    by_band: dict[int, list[int]] = {}
    for r in counts:
        by_band.setdefault(r["band"], [0] * (DEEPEST + 1))[r["level"]] += r["count"]
    out = {}
    for band, n in by_band.items():
        for level in range(1, DEEPEST + 1):
            if sum(n[level:]) and sum(n) * 10 ** (-level / STEPS) <= FDR * sum(n[level:]):
                out[band] = level
                break
    return out


def report(scanned: DataFrame, cut: dict[int, int]) -> DataFrame:
    """Spans of every document: the base ones and the candidates at or above their band's cut."""
    limit = F.array(*[F.lit(cut.get(b, DEEPEST + 1)) for b in range(BANDS)])
    kept = F.filter("found", lambda c: c["level"] >= F.get(limit, c["band"]))
    extra = F.transform(kept, lambda c: F.struct(c["start"].alias("start"), F.lit(3).alias("kind"), c["end"].alias("end")))
    spans = F.array_sort(F.concat("base", extra))
    names = F.array(*[F.lit(k) for k in KINDS])
    text = F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"]))
    return scanned.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", F.concat_ws(",", text).alias("spans"), F.size(extra).cast("long").alias("n_random"))


def secrets(docs: DataFrame) -> DataFrame:
    scanned = written(scan(docs), "secrets")
    return report(scanned, cuts(scanned))


MASK = "[SECRET]"


def masked(text: str, cut: dict[int, int]) -> str:
    """``text`` with every reported span, or union of overlapping ones, as ``MASK``."""
    base = base_spans(text)
    spans = sorted([(s, e) for s, _, e in base] + [(s, e) for s, e, band, level in candidates(text, base) if level >= cut.get(band, DEEPEST + 1)])
    if not spans:
        return text
    out, at = [], 0
    for s, e in spans:
        if s >= at:
            out += [text[at:s], MASK]
        at = max(at, e)
    return "".join(out) + text[at:]


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with secrets masked and n_chars, where there is one, counted anew for changed texts. Nulls stay null."""
    cut = cuts(scan(docs))

    def run(batches):
        for batch in batches:
            old = batch.column("text").to_pylist()
            new = [t if t is None else masked(t, cut) for t in old]
            columns = {f.name: batch.column(f.name) for f in batch.schema}
            columns["text"] = pa.array(new, batch.schema.field("text").type)
            if "n_chars" in columns:
                kept = columns["n_chars"].to_pylist()
                columns["n_chars"] = pa.array([k if a == b else len(b) for a, b, k in zip(old, new, kept)], batch.schema.field("n_chars").type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)
