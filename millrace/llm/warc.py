"""WARC archives: a deterministic sharded writer and its reader.

One record a row, sorted by key and payload digest.  Quantiles of these, weighted by payload bytes, cut
the rows into ranges; a range is written by one task as a run of files that roll when they are
full.  Only rows that agree in key and payload cannot be cut apart.  Headers and digests
are made anew from the row, nothing depends on clocks, tasks or attempts, so equal input gives
equal files.  A file is written under a temporary name in ``_temporary`` and then renamed; the
manifest, one row a file, is committed after all files, and the reader refuses a folder whose
files are not those of its manifest.

Payload: the text in UTF-8, null as empty.  Of rows with equal payloads (SHA-1 and length) of
at least ``MIN_REVISITED`` bytes, those with the largest key are responses, the others revisit
it.  Rows with a null key come first and are always responses.  Rows that repeat a key are
records of their own, told apart by a number in their ids.  A URL's characters up to the space are
percent-encoded in the header; a null URL has no header.  An empty table gives an empty
manifest and no files.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.scratch import keep

MIN_REVISITED = 1000
#: Payload bytes of a range of keys, and compressed bytes at which a file is full.
RANGE_BYTES = 16 << 20
ROLL_BYTES = 4 << 20
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Places at which ranges may begin, about: the driver and every task have them all.
POINTS = 1 << 16
SALTS = 32
MANIFEST = "file string, records long, bytes long, sha256 string"


def _base32(digest: bytes) -> str:
    return "sha1:" + base64.b32encode(digest).decode()


def _record_id(key: int | None, digest: str, again: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{key}/{digest}/{again}')}>"


def _member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """A record as a gzip member of its own."""
    head = "".join(f"{k}: {v}\r\n" for k, v in (*headers, ("Content-Length", str(len(block)))))
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(f"WARC/1.1\r\n{head}\r\n".encode() + block + b"\r\n\r\n") + pack.flush()


def _page(key: int | None, url: str | None, payload: bytes, digest: str, refers: int | None, again: int) -> bytes:
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if refers is None:
        block += payload
    headers = [("WARC-Type", "response" if refers is None else "revisit"), ("WARC-Record-ID", _record_id(key, digest, again)),
               ("WARC-Date", DATE), ("Content-Type", "application/http; msgtype=response"),
               ("WARC-Payload-Digest", _base32(bytes.fromhex(digest))), ("WARC-Block-Digest", _base32(hashlib.sha1(block).digest()))]
    if url is not None:
        headers.append(("WARC-Target-URI", "".join(f"%{ord(c):02X}" if c <= " " or c == "\x7f" else c for c in url)))
    if key is not None:
        headers.append(("X-Key", str(key)))
    if refers is not None:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _record_id(refers, digest, 0)), ("X-Refers-To-Key", str(refers))]
    return _member(headers, block)


class _Roll:
    """The files of one range of keys."""

    def __init__(self, root: str, part: int, roll_bytes: int):
        self.fs, self.root = fs.FileSystem.from_uri(root)
        self.part, self.roll_bytes, self.n, self.out = part, roll_bytes, 0, None
        self.fs.create_dir(f"{self.root}/_temporary", recursive=True)

    def add(self, record: bytes) -> Iterator[tuple]:
        if self.out is None:
            self.name = f"{self.part:06d}-{self.n:05d}.warc.gz"
            self.temporary = f"{self.root}/_temporary/{uuid.uuid4().hex}"
            self.out, self.records, self.bytes, self.sha = self.fs.open_output_stream(self.temporary), -1, 0, hashlib.sha256()
            self.put(_member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", _record_id(None, self.name, 0)), ("WARC-Date", DATE),
                              ("WARC-Filename", self.name), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
        self.put(record)
        if self.bytes >= self.roll_bytes:
            yield from self.close()

    def put(self, record: bytes) -> None:
        self.out.write(record)
        self.sha.update(record)
        self.records += 1
        self.bytes += len(record)

    def close(self) -> Iterator[tuple]:
        if self.out is not None:
            self.out.close()
            self.fs.move(self.temporary, f"{self.root}/{self.name}")
            self.out, self.n = None, self.n + 1
            yield self.name, self.records, self.bytes, self.sha.hexdigest()


def _below(points: list[tuple], keys: pa.Array, digests: pa.Array) -> np.ndarray:
    """How many of the sorted points (key or None first, digest) are not above each row's."""
    order = [(k is not None, k or 0, d) for k, d in points]
    return np.array([bisect_right(order, (k is not None, k or 0, d)) for k, d in zip(keys.to_pylist(), digests.to_pylist())], np.int32)


def _ranges(rows: DataFrame, range_bytes: int):
    """Column function (key, digest) -> number of the range, and how many ranges there are.

    Points chosen by a hash of key and digest, ``POINTS`` at the most (about), cut all rows into cells,
    dense keys, one hot key and null keys alike; neighbouring cells make a range up to
    ``range_bytes``.  The same rows give the same points, however they are partitioned."""
    spark = rows.sparkSession
    apart = rows.count() // POINTS + 1
    chosen = rows.where(F.pmod(F.xxhash64("key", "digest"), F.lit(apart)) == 0).select("key", "digest").distinct()
    points = sorted(((r.key, r.digest) for r in chosen.toLocalIterator()), key=lambda p: (p[0] is not None, p[0] or 0, p[1]))
    shared = spark.sparkContext.broadcast(points)

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(points) + 1, np.int64)
        for batch in batches:
            total += np.bincount(_below(shared.value, batch.column(0), batch.column(1)), batch.column(2).to_numpy(), len(total)).astype(np.int64)
        cells = np.flatnonzero(total)
        yield pa.record_batch({"cell": pa.array(cells.astype(np.int32)), "bytes": pa.array(total[cells])})

    weights = rows.select("key", "digest", F.col("n").cast("long")).mapInArrow(weighed, "cell int, bytes long").groupBy("cell").agg(F.sum("bytes").alias("bytes"))
    bytes_of = {r.cell: r.bytes for r in weights.toLocalIterator()}
    part, held, parts = 0, 0, []
    for cell in range(len(points) + 1):
        more = bytes_of.get(cell, 0)
        if held and held + more > range_bytes:
            part, held = part + 1, 0
        held += more
        parts.append(part)
    of = spark.sparkContext.broadcast(np.array(parts, np.int32))

    def number(keys: pa.Array, digests: pa.Array) -> pa.Array:
        return pa.array(of.value[_below(shared.value, keys, digests)])

    return F.arrow_udf(number, "int"), part + 1


def write(pages: DataFrame, root: str, key: str = "page_id", url: str = "url", payload: str = "html",
          range_bytes: int = RANGE_BYTES, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Write the archives to ``root``, a folder nobody used before, and return the manifest."""
    spark = pages.sparkSession
    rows = pages.select(
        F.col(key).cast("long").alias("key"), F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(payload).cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    narrow = keep(rows.select("key", "digest", F.octet_length("payload").alias("n")), "warc")
    # copies of one payload may be a third of all rows: they meet in salted groups first
    salted = narrow.where((F.col("n") >= MIN_REVISITED) & F.col("key").isNotNull()) \
        .withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(SALTS)))
    some = keep(salted.groupBy("digest", "n", "salt").agg(F.max("key").alias("last"), F.count("*").alias("copies")), "warc")
    shared = some.groupBy("digest", "n").agg(F.max("last").alias("refers"), F.sum("copies").alias("copies")).where("copies > 1")
    refers = salted.join(some.join(shared.drop("copies"), ["digest", "n"]).select("digest", "n", "salt", "refers"), ["digest", "n", "salt"]) \
        .where(F.col("key") != F.col("refers")).select("key", "digest", "refers").distinct()

    number, parts = _ranges(narrow, range_bytes)
    both = (
        refers.select("key", "digest", F.lit(0).alias("kind"), "refers", F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"))
        .unionByName(rows.withColumns({"kind": F.lit(1), "refers": F.lit(None).cast("long")}))
        .withColumn("part", number("key", "digest"))
        .repartitionById(parts, F.col("part"))
        .sortWithinPartitions("part", "key", "digest", "kind", "url")
        .select("part", "key", "digest", "kind", "refers", "url", "payload")
    )

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, roll, own, refers, again = [], None, None, None, 0
        for batch in batches:
            for part, key, digest, kind, to, url, payload in zip(*(c.to_pylist() for c in batch.columns)):
                if roll is None or roll.part != part:
                    done += roll.close() if roll else ()
                    roll = _Roll(root, part, roll_bytes)
                if own != (key, digest):
                    own, refers, again = (key, digest), None, 0
                if kind == 0:
                    refers = to
                    continue
                done += roll.add(_page(key, url, payload, digest, refers, again))
                again += 1
        done += roll.close() if roll else ()
        if done:
            yield pa.RecordBatch.from_pylist([dict(zip(("file", "records", "bytes", "sha256"), x)) for x in done])

    both.mapInArrow(written, MANIFEST).write.mode("error").parquet(f"{root}/_manifest")
    return spark.read.schema(MANIFEST).parquet(f"{root}/_manifest")


def _members(data: bytes) -> Iterator[bytes]:
    while data:
        unpack = zlib.decompressobj(31)
        yield unpack.decompress(data)
        data = unpack.unused_data


RECORD = "key long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string"


def _parsed(record: bytes, payloads: bool) -> dict | None:
    head, _, rest = record.partition(b"\r\n\r\n")
    of = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    if of["WARC-Type"] not in ("response", "revisit"):
        return None
    block = rest[:int(of["Content-Length"])]
    if _base32(hashlib.sha1(block).digest()) != of["WARC-Block-Digest"]:
        raise ValueError(f"record {of['WARC-Record-ID']}: its block differs from its digest")
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(next(x for x in http.decode().split("\r\n") if x.startswith("Content-Length: "))[16:])
    digest = base64.b32decode(of["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    if of["WARC-Type"] == "response":
        length, digest = len(payload), hashlib.sha1(payload).hexdigest()
    number = lambda x: None if x is None else int(x)
    out = {"key": number(of.get("X-Key")), "url": of.get("WARC-Target-URI"), "record_type": of["WARC-Type"],
           "refers_to": number(of.get("X-Refers-To-Key")), "payload_bytes": length, "payload_digest": digest}
    return out | {"payload": payload if of["WARC-Type"] == "response" else None} if payloads else out


def read(spark: SparkSession, root: str, payloads: bool = True) -> DataFrame:
    """Records of the archives below ``root``: key, url, record_type, refers_to, payload_bytes
    and payload_digest (both of the full payload), and, if asked for, payload (null for
    revisits).  Block digests are checked."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{root}/_manifest")
    schema = RECORD + (", payload binary" if payloads else "")
    if manifest.isEmpty():
        return spark.createDataFrame([], schema)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(root)
    there = files.select(F.element_at(F.split("path", "/"), -1).alias("file"), F.col("length").alias("bytes"))
    if not manifest.select("file", "bytes").exceptAll(there).isEmpty() or not there.exceptAll(manifest.select("file", "bytes")).isEmpty():
        raise ValueError(f"the files in {root} are not those of its manifest")

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                found = [x for m in _members(data.as_py()) if (x := _parsed(m, payloads))]
                if found:
                    yield pa.RecordBatch.from_pylist(found, pa.schema(
                        [("key", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                         ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())][:6 + payloads]))

    return files.select("content").mapInArrow(parsed, schema)
