"""WARC archives: a deterministic sharded writer and a verifying reader.

Pages are dealt into shards by ranges of page_id and sorted (then by url and payload); each shard is a
task that writes gzip files in order, one member a record, which roll once ``ROLL_BYTES``
compressed bytes are reached. The ranges follow from exact counts of bytes (``starts``) and from nothing else, so the
same pages give the same files whatever the session, its partitions or its cores. Headers are made anew: record ids from page_id, digest and
the count of earlier equal records, block and payload digests, lengths.

Of pages with equal payloads of ``LEAST_PAYLOAD`` bytes or more, those with the smallest page_id
are responses, the others revisits that carry no payload. Which they are is settled by an aggregate
on digests that never moves the payloads.

Tasks write under temporary names that hold their attempt; the rows they return, which Spark
takes from one attempt of each task only, say what is to be renamed. Renames run as tasks and
may be repeated. The manifest is written last, and a reader opens only what it lists. So lost
executors, retries and speculative copies leave no record twice and none out.

Null html is an empty payload, a null url gives a page URN. Repeated rows give a record each;
rows that share the smallest page_id of their payload are all responses. Rows without page_id
come first, and revisit any page of their payload that has one. They, and a page_id that is larger than a
shard, are dealt over several shards by payload. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

LEAST_PAYLOAD = 100
ROLL_BYTES = 32 << 20
LEAST_SHARD, MOST_SHARD, SHARDS, CELLS = 4 << 20, 128 << 20, 64, 4
RECORD_BYTES = 512  # of headers
LEVEL = 5
DATE = "2000-01-01T00:00:00Z"
SOFTWARE = "seamark"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")

MANIFEST = "shard int, file int, temporary string, name string, records long, bytes long, sha256 string"
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def filesystem(root: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(root)


def revisits(pages: DataFrame) -> DataFrame:
    """(page_id, digest, refers_to) of the pages whose payload a smaller page_id has."""
    html = F.coalesce("html", F.lit(""))
    facts = pages.select("page_id", F.sha2(html, 256).alias("digest"), F.octet_length(html).alias("size")).filter(F.col("size") >= LEAST_PAYLOAD).drop("size")
    first = facts.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).filter("n > 1 AND refers_to IS NOT NULL").drop("n")
    return facts.join(first, "digest").filter("page_id IS NULL OR page_id > refers_to").select("page_id", "digest", "refers_to").distinct()


def record_id(page_id: int | None, digest: str, ordinal: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{page_id}|{digest}|{ordinal}')}>"


def target(url: str | None, page_id: int | None) -> str:
    if not url:
        return f"urn:page:{page_id}"
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def record(kind: str, rid: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member."""
    head = [("WARC-Type", kind), ("WARC-Record-ID", rid), ("WARC-Date", DATE), *fields]
    head += [("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"), ("Content-Length", str(len(block)))]
    raw = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n"
    z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return z.compress(raw.encode()) + z.compress(block) + z.compress(b"\r\n\r\n") + z.flush()


def page_record(page_id: int | None, url: str | None, payload: bytes, digest: str, ordinal: int, refers_to: int | None) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    fields = [("WARC-Target-URI", target(url, page_id)), ("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "application/http; msgtype=response")]
    if page_id is not None:
        fields.append(("X-Page-ID", str(page_id)))
    if refers_to is None:
        return record("response", record_id(page_id, digest, ordinal), fields, http + payload)
    fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to, digest, 0)), ("X-Refers-To-Page", str(refers_to))]
    return record("revisit", record_id(page_id, digest, ordinal), fields, http)


class Shard:
    """The rolling files of one task."""

    def __init__(self, root: str, shard: int, attempt: int, roll: int):
        self.fs, self.path = filesystem(root)
        self.shard, self.attempt, self.roll = shard, attempt, roll
        self.out, self.done = None, []

    def open(self) -> None:
        self.stem = f"{self.shard:06d}-{len(self.done):05d}"
        self.temporary = f"_temporary/{self.stem}-{self.attempt}.warc.gz"
        self.out = self.fs.open_output_stream(f"{self.path}/{self.temporary}")
        self.bytes, self.records, self.sum = 0, 0, hashlib.sha256()
        info = f"software: {SOFTWARE}\r\nformat: WARC File Format 1.1\r\n".encode()
        self.put(record("warcinfo", record_id(None, self.stem, 0), [("WARC-Filename", f"{self.stem}.warc.gz"), ("Content-Type", "application/warc-fields")], info))
        self.records = 0

    def put(self, member: bytes) -> None:
        self.out.write(member)
        self.sum.update(member)
        self.bytes += len(member)
        self.records += 1

    def add(self, member: bytes) -> None:
        if self.out is None:
            self.open()
        self.put(member)
        if self.bytes >= self.roll:
            self.close()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None
            self.done.append((self.shard, len(self.done), self.temporary, f"{self.stem}.warc.gz", self.records, self.bytes, self.sum.hexdigest()))


def starts(pages: DataFrame) -> tuple[np.ndarray, int]:
    """(first page_id of each shard, ascending; number of shards before them for rows without one).

    A shard has ``SHARDS`` to the whole of the bytes, within ``LEAST_SHARD`` and ``MOST_SHARD``. Bytes are
    counted by cells of page_id, and cells that fill a quarter of a shard are counted again in smaller ones; so
    the driver sees a few rows a shard. A page_id that fills shards by itself begins as many of them.
    """
    sized = pages.select("page_id", (F.octet_length(F.coalesce("html", F.lit(""))) + RECORD_BYTES).cast("long").alias("size"))
    none = F.col("page_id").isNull()
    low, high, some, rest = sized.agg(F.min("page_id"), F.max("page_id"), F.coalesce(F.sum(F.when(~none, F.col("size"))), F.lit(0)), F.coalesce(F.sum(F.when(none, F.col("size"))), F.lit(0))).first()
    target = min(MOST_SHARD, max(LEAST_SHARD, (some + rest) // SHARDS))
    first = -(-rest // target)
    if low is None:
        return np.zeros(0, np.int64), max(1, first)

    def cells(rows: DataFrame, shift: int) -> list[tuple[int, int]]:
        cell = F.shiftright("page_id", shift)
        return sorted((int(c), int(n)) for c, n in rows.groupBy(cell.alias("cell")).agg(F.sum("size")).toLocalIterator())

    fine = max(1, (CELLS * some // target).bit_length())
    shift = max(0, (high - low).bit_length() - max(fine, 12))
    sizes = {(c << shift, shift): n for c, n in cells(sized.filter(~none), shift)}
    while shift:
        large = sorted({c for (c, s), n in sizes.items() if s == shift and n * CELLS > target})
        if not large:
            break
        heavy = sized.sparkSession.createDataFrame([(c >> shift,) for c in large], "cell long")
        smaller = max(0, shift - 12)
        rows = sized.filter(~none).withColumn("cell", F.shiftright("page_id", shift)).join(heavy, "cell", "left_semi")
        sizes = {k: n for k, n in sizes.items() if k[1] != shift or n * CELLS <= target} | {(c << smaller, smaller): n for c, n in cells(rows, smaller)}
        shift = smaller
    out, held = [], target + 1
    for (start, _), n in sorted(sizes.items()):
        if n > target:
            out += [start] * -(-n // target)
            held = target + 1
        elif held + n > target:
            out.append(start)
            held = n
        else:
            held += n
    return np.array(out, np.int64), first


def dealt(pages: DataFrame) -> DataFrame:
    """Pages (kind 1) and what is known of their revisits (kind 0), one partition a shard, in order."""
    begin, first = starts(pages)
    split = first > 1 or len(np.unique(begin)) < len(begin)

    @F.pandas_udf(LongType())
    def place(page_id: pd.Series, payload: pd.Series) -> pd.Series:
        ids = page_id.to_numpy(np.int64)
        right, left = np.searchsorted(begin, ids, "right"), np.searchsorted(begin, ids, "left")
        own = np.where(left < right, left, np.maximum(right - 1, 0))
        return pd.Series(own + payload.to_numpy(np.int64) % np.maximum(right - own, 1))

    def shard(digest: Column) -> Column:
        payload = F.pmod(F.xxhash64(digest), F.lit(1 << 40)) if split else F.lit(0).cast("long")
        return F.when(F.col("page_id").isNull(), payload % max(1, first)).otherwise(first + place(F.coalesce("page_id", F.lit(0)), payload)).cast("int").alias("shard")

    text, number = F.lit(None).cast("string"), F.lit(None).cast("long")
    whole = pages.select("page_id", F.lit(1).alias("kind"), "url", "html", text.alias("digest"), number.alias("refers_to"), shard(F.sha2(F.coalesce("html", F.lit("")), 256)))
    known = revisits(pages).select("page_id", F.lit(0).alias("kind"), text.alias("url"), text.alias("html"), "digest", "refers_to", shard(F.col("digest")))
    placed = whole.unionByName(known).repartitionById(max(1, first + len(begin)), F.col("shard")).drop("shard")
    return placed.sortWithinPartitions("page_id", "kind", "url", F.xxhash64("html"))


def write(pages: DataFrame, root: str, roll: int = ROLL_BYTES) -> DataFrame:
    """Write ``pages`` (page_id, url, html) under ``root``, a new folder that all executors reach; returns the manifest."""
    spark = pages.sparkSession
    fs, path = filesystem(root)
    fs.create_dir(f"{path}/_temporary", recursive=True)
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        shard = Shard(root, context.partitionId(), context.taskAttemptId(), roll)
        last, refers, seen = object(), {}, {}
        for batch in batches:
            for page_id, kind, url, html, digest, refers_to in zip(*(batch.column(c).to_pylist() for c in ("page_id", "kind", "url", "html", "digest", "refers_to"))):
                if page_id != last:
                    last, refers, seen = page_id, {}, {}
                if kind == 0:
                    refers[digest] = refers_to
                    continue
                payload = (html or "").encode()
                digest = hashlib.sha256(payload).hexdigest()
                ordinal = seen[digest] = seen.get(digest, -1) + 1
                shard.add(page_record(page_id, url, payload, digest, ordinal, refers.get(digest)))
        shard.close()
        columns = list(zip(*shard.done)) or [()] * 7
        kinds = (pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["shard", "file", "temporary", "name", "records", "bytes", "sha256"])

    dealt(pages).mapInArrow(run, MANIFEST).write.parquet(f"{root}/_staged")
    staged = spark.read.schema(MANIFEST).parquet(f"{root}/_staged")

    def commit(batches):
        fs, path = filesystem(root)
        for batch in batches:
            for old, new in zip(batch.column("temporary").to_pylist(), batch.column("name").to_pylist()):
                if fs.get_file_info(f"{path}/{old}").type == pafs.FileType.File:
                    fs.move(f"{path}/{old}", f"{path}/{new}")
                elif fs.get_file_info(f"{path}/{new}").type != pafs.FileType.File:
                    raise FileNotFoundError(f"{path}/{old}")
            yield batch

    staged.mapInArrow(commit, MANIFEST).drop("temporary").write.parquet(f"{root}/_manifest")
    fs.delete_dir(f"{path}/_temporary")
    return manifest(spark, root)


def manifest(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/_manifest")


def members(stream) -> Iterator[bytes]:
    """Records of an archive, one gzip member each."""
    rest = b""
    while True:
        z = zlib.decompressobj(31)
        out = []
        while not z.eof:
            rest = rest or stream.read(1 << 20)
            if not rest:
                if out:
                    raise EOFError("archive ends inside a record")
                return
            out.append(z.decompress(rest))
            rest = z.unused_data if z.eof else b""
        yield b"".join(out)


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of a record; digests and lengths must agree."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    if rest[len(block) :] != b"\r\n\r\n" or f"sha256:{hashlib.sha256(block).hexdigest()}" != fields["WARC-Block-Digest"]:
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    return fields, block


def read_record(raw: bytes) -> tuple | None:
    """A row of ``RECORD``; None for records that hold no page."""
    fields, block = parse(raw)
    kind = fields["WARC-Type"]
    if kind not in ("response", "revisit"):
        return None
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"(?i)\r\ncontent-length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"damaged payload {fields['WARC-Record-ID']}")
    page, refers = fields.get("X-Page-ID"), fields.get("X-Refers-To-Page")
    return page and int(page), fields["WARC-Target-URI"], size, digest, kind, refers and int(refers)


def read(spark: SparkSession, root: str) -> DataFrame:
    """One row a page record of the archives that the manifest lists, each digest verified."""

    def run(batches):
        fs, path = filesystem(root)
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64())
        names = [f.split()[0] for f in RECORD.split(", ")]

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        for batch in batches:
            for name in batch.column("name").to_pylist():
                rows = []
                with fs.open_input_stream(f"{path}/{name}") as stream:
                    for raw in members(stream):
                        if (row := read_record(raw)) is not None:
                            rows.append(row)
                        if len(rows) == 4096:
                            yield batch_of(rows)
                            rows = []
                if rows:
                    yield batch_of(rows)

    files = manifest(spark, root)
    return files.select("name").repartition(max(1, int(np.ceil(files.count() / 2)))).mapInArrow(run, RECORD)
