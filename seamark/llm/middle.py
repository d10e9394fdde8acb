"""Fill-in-the-middle by in-place block rotation, and its exact inverse.

A text is cut into units, ``[^\\n]*\\n|[^\\n]+``. Two cuts between units, drawn from a hash of doc_id,
part it into prefix, middle and suffix. The bytes of the text lie in one bytearray: the cuts are
found by a scan for line feeds, sentinels are inserted before the three parts, and one rotation
brings them into order::

    <P>prefix <M>middle <S>suffix        after the inserts
    <P>prefix <S>suffix <M>middle        psm: the two last parts change places
    <S>suffix <P>prefix <M>middle        spm: the last part goes to the front

A rotation is three reversals, each of which swaps chunks of ``CHUNK`` bytes from both ends, so it
needs two chunks beside the buffer. ``restore`` finds the sentinels, rotates back and takes them out.
A sentinel begins with ``<`` and ends with ``>`` and has neither inside, so none can arise across
the border of a part and a sentinel; texts that hold one themselves stay plain.

Edge cases: null and empty texts are plain and come out empty. A null doc_id is hashed as an empty
string; rows that share a doc_id are cut alike. Other columns pass through; those that have the name
of a new column are replaced.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from seamark.llm.common import with_columns_in_arrow

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SEED, RATE, SPM_RATE = 7, 100, 50
CHUNK = 1 << 16
PLAIN, PSM, SPM = "plain", "psm", "spm"
FEED = 10


def reverse(data: np.ndarray, start: int, end: int) -> None:
    """Reverse ``data[start:end]`` in place, a chunk from either end at a time."""
    while end - start > 1:
        size = min(CHUNK, (end - start) // 2)
        head = data[start : start + size].copy()
        data[start : start + size] = data[end - size : end][::-1]
        data[end - size : end] = head[::-1]
        start += size
        end -= size


def rotate(buffer: bytearray, start: int, cut: int, end: int) -> None:
    """Exchange ``buffer[start:cut]`` and ``buffer[cut:end]`` in place by three reversals."""
    data = np.frombuffer(buffer, np.uint8)
    reverse(data, start, cut)
    reverse(data, cut, end)
    reverse(data, start, end)


def draws(doc_id: int | None, seed: int) -> list[int]:
    """Four unsigned 32-bit integers of a document."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[i : i + 4], "big") for i in range(0, 16, 4)]


def chars(data: np.ndarray) -> int:
    return int(((data & 0xC0) != 0x80).sum())


def into_form(text: bytes, doc_id: int | None, seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE) -> tuple[bytes | bytearray, str, int, int | None, int | None]:
    """(output, form, units, code points of the prefix, of the middle)."""
    if not text:
        return text, PLAIN, 0, None, None
    data = np.frombuffer(text, np.uint8)
    ends = np.flatnonzero(data == FEED) + 1
    n = len(ends) + int(data[-1] != FEED)
    h1, h2, h3, h4 = draws(doc_id, seed)
    if h3 % 100 >= rate or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
        return text, PLAIN, n, None, None
    first, second = (0 if k == 0 else len(data) if k == n else int(ends[k - 1]) for k in sorted((h1 % (n + 1), h2 % (n + 1))))
    sizes = chars(data[:first]), chars(data[first:second])
    buffer = bytearray(text)
    for at, mark in ((second, SUFFIX), (first, MIDDLE), (0, PREFIX)):
        buffer[at:at] = mark
    middle = first + len(PREFIX)
    suffix = second + len(PREFIX) + len(MIDDLE)
    spm = h4 % 100 < spm_rate
    rotate(buffer, 0 if spm else middle, suffix, len(buffer))
    return buffer, SPM if spm else PSM, n, *sizes


def out_of_form(output: bytes, form: str | None) -> bytes | bytearray:
    """The text of which ``into_form`` made ``output``."""
    if form not in (PSM, SPM):
        return output
    buffer = bytearray(output)
    start = 0 if form == SPM else buffer.index(SUFFIX)
    cut = buffer.index(PREFIX if form == SPM else MIDDLE, start)
    suffix = len(buffer) - (cut - start)
    rotate(buffer, start, cut, len(buffer))
    middle = buffer.index(MIDDLE)
    for at, mark in ((suffix, SUFFIX), (middle, MIDDLE), (0, PREFIX)):
        del buffer[at : at + len(mark)]
    return buffer


def texts_of(column: pa.Array) -> list[bytes]:
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def transform(docs: DataFrame, output: str = "output", seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """``docs`` with ``output``, form, n, prefix_chars and middle_chars."""

    def run(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        ids = batch.column("doc_id").to_pylist()
        made = [into_form(t, i, seed, rate, spm_rate) for t, i in zip(texts_of(batch.column("text")), ids)]
        texts, forms, n, first, middle = zip(*made)
        return {
            output: pa.array([bytes(t) for t in texts], pa.binary()).cast(pa.string()),
            "form": pa.array(forms, pa.string()),
            "n": pa.array(n, pa.int64()),
            "prefix_chars": pa.array(first, pa.int64()),
            "middle_chars": pa.array(middle, pa.int64()),
        }

    return with_columns_in_arrow(docs, run, {output: "string", "form": "string", "n": "long", "prefix_chars": "long", "middle_chars": "long"}, "text")


def restore(docs: DataFrame, output: str = "output", restored: str = "restored") -> DataFrame:
    """``docs`` with the texts rebuilt from ``output`` and form."""

    def run(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        texts = [bytes(out_of_form(t, f)) for t, f in zip(texts_of(batch.column(output)), batch.column("form").to_pylist())]
        return {restored: pa.array(texts, pa.binary()).cast(pa.string())}

    return with_columns_in_arrow(docs, run, {restored: "string"}, output)
