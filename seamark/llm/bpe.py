"""Byte-level BPE encoding and decoding with tiktoken and a local rank file.

Long texts are cut before they meet the splitting pattern, whose look-ahead needs
stack space for long stretches of blanks. A cut is safe between a visible ASCII
character and a following space or line feed: no match of the pattern spans it and
nothing before it is looked at. A run of more than ``LONG_BLANK`` blanks is itself one
match (all of it at the end of the text, else all but its last character, which the
next match may take along) and goes to the merges directly.

Decoding joins raw bytes, never text, so tokens may end inside a character.
Nulls count as empty texts, which give no ids. Rows are independent; repeated rows
repeat; other columns are ignored.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

PART = 1 << 17
LONG_BLANK = 500
BLANK = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
LONG = re.compile(f"[{BLANK}]{{{LONG_BLANK},}}")
CUT = re.compile(r"(?<=[!-~])[ \n]")


@functools.lru_cache(4)
def encoding(path: str, pattern: str) -> tiktoken.Encoding:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def parts(text: str, at: int, end: int):
    """Pieces of text[at:end] cut at safe places, each of about ``PART`` characters where such places exist."""
    while end - at > PART:
        m = CUT.search(text, at + PART, end)
        if m is None:
            break
        yield text[at : m.start()]
        at = m.start()
    if at < end:
        yield text[at:end]


def encode(enc: tiktoken.Encoding, text: str) -> list[int]:
    """Ids of the whole text, as one call without limits would give them."""
    if len(text) <= LONG_BLANK:
        return enc.encode_ordinary(text)
    out: list[int] = []
    at = 0
    for m in LONG.finditer(text):
        whole = m.end() if m.end() == len(text) else m.end() - 1
        for p in parts(text, at, m.start()):
            out += enc.encode_ordinary(p)
        out += enc._encode_single_piece(text[m.start() : whole])
        at = whole
    for p in parts(text, at, len(text)):
        out += enc.encode_ordinary(p)
    return out


def decode(enc: tiktoken.Encoding, ids: list[int]) -> bytes:
    return enc.decode_bytes(ids)


def digest(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Encode and decode every text: number and digest of its ids, digest of the decoded bytes."""

    def run(batches):
        enc = encoding(path, pattern)
        for batch in batches:
            n, ids_sha, back_sha = [], [], []
            for text in batch.column("text").cast(pa.large_string()).fill_null("").to_pylist():
                ids = encode(enc, text)
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
                back_sha.append(hashlib.sha256(decode(enc, ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(back_sha, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode_column(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and ``ids array<int>``."""

    def run(batches):
        enc = encoding(path, pattern)
        for batch in batches:
            texts = batch.column("text").cast(pa.large_string()).fill_null("").to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array([encode(enc, t) for t in texts], pa.list_(pa.int32()))], ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode_column(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and the raw ``bytes binary`` of its ids (null: none)."""

    def run(batches):
        enc = encoding(path, pattern)
        for batch in batches:
            back = [decode(enc, ids or []) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(back, pa.binary())], ["doc_id", "bytes"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, bytes binary")
