"""Deterministic sharded WARC archives.

Pages are range-sorted by id: ranges of near equal bytes, found from exact
sums, are the shards. A shard is written as a stream of records, each its
own gzip member, and rolls to a new file when the compressed size of the
current one would pass the limit. Headers and digests are made anew from the
payloads. A file is written under a temporary name and renamed when whole;
the manifest, one row per file, is written by Spark and renamed last, so an
archive either has a manifest that names whole files only or does not exist.
The same pages give the same files, byte by byte, on any cluster.

Of pages with equal payloads the one with the largest id is the response;
the others are revisits that refer to it. Which is which reaches the writer
as rows of its own, sorted in before the pages they concern, so payloads are
shuffled once.
"""

from __future__ import annotations

import base64
import hashlib
import os
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerostat.llm.common import small_batches, staged, unpressed
from aerostat.llm.copies import with_group_value
from aerostat.llm.files import filesystem
from aerostat.llm.ranges import byte_ranges, range_of
from aerostat.session import scratch_path

SHARD_BYTES = 8 << 20  # payload bytes of a shard, about, while there are no more than MOST_SHARDS
MOST_SHARDS = 1 << 14  # beyond, shards grow; they are streams, so that costs no memory
LEVEL = 6  # of the compression
DATE = "1970-01-01T00:00:00Z"  # of all records: pages have no time

# Format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RESPONSE, REVISIT = "response", "revisit"
END = b"\r\n\r\n"

MANIFEST = ("file string, shard int, roll int, records long, bytes long, sha256 string, first_id long, last_id long")
RECORDS = ("page_id long, url string, record_type string, payload_bytes long, payload_digest string, "
           "refers_to long, payload binary")


def base32(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def record_id(page_id: int | None, digest: bytes, nth: int) -> str:
    """Name of the n-th record of a page and payload; a revisit can tell the name of its response."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{'' if page_id is None else page_id}:{digest.hex()}:{nth}')}>"


def record(kind: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = [VERSION, f"WARC-Type: {kind}", *[f"{k}: {v}" for k, v in fields],
            f"WARC-Block-Digest: sha1:{base32(hashlib.sha1(block).digest())}", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + END + block + END


def page_record(kind: str, page_id: int | None, nth: int, url: str | None, payload: bytes, digest: bytes, date: str,
                refers_to: int | None) -> bytes:
    """A response, or a revisit without the payload; the HTTP head tells the payload's length in both."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}".encode() + END
    fields = [("WARC-Record-ID", record_id(page_id, digest, nth)), ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe="!#$&'()*+,/:;=?@[]-._~%")))
    if page_id is not None:
        fields.append(("X-Page-ID", str(page_id)))
    fields.append(("WARC-Payload-Digest", f"sha1:{base32(digest)}"))
    if kind == REVISIT:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to, digest, 0))]
        if refers_to is not None:
            fields.append(("X-Refers-To-Page-ID", str(refers_to)))
    fields.append(("Content-Type", "application/http; msgtype=response"))
    return record(kind, fields, http + payload if kind == RESPONSE else http)


def member(raw: bytes) -> bytes:
    """A gzip member; its head holds no time or name."""
    press = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return press.compress(raw) + press.flush()


class _Files:
    """Files of a shard, one after another."""

    def __init__(self, root: str, limit: int, date: str, attempt: str):
        self.fs, self.root = filesystem(root)
        self.limit, self.date, self.attempt = limit, date, attempt
        self.out, self.shard, self.roll = None, None, -1

    def start(self, shard: int) -> dict | None:
        """Go to a shard; what the last one leaves open is closed and returned."""
        done = self.close()
        self.shard, self.roll = shard, -1
        return done

    def add(self, raw: bytes, page_id: int | None) -> dict | None:
        """Append a record; a file that this closes is returned."""
        done = self.close() if self.out and self.size + len(raw) > self.limit else None
        if self.out is None:
            self.roll += 1
            self.name = f"{self.shard:06d}-{self.roll:06d}.warc.gz"
            self.temporary = f"{self.root}/.{self.name}.{self.attempt}"
            self.out, self.sum = self.fs.open_output_stream(self.temporary, compression=None), hashlib.sha256()
            self.size, self.records, self.first = 0, 0, page_id
            self._write(member(record("warcinfo", [
                ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'file:{self.name}')}>"), ("WARC-Date", self.date),
                ("WARC-Filename", self.name), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")))
        self._write(raw)
        self.records += 1
        self.last = page_id
        return done

    def _write(self, raw: bytes) -> None:
        self.out.write(raw)
        self.sum.update(raw)
        self.size += len(raw)

    def close(self) -> dict | None:
        if self.out is None:
            return None
        self.out.close()
        self.out = None
        self.fs.move(self.temporary, f"{self.root}/{self.name}")  # a repeated attempt puts the same bytes in its place
        return {"file": self.name, "shard": self.shard, "roll": self.roll, "records": self.records, "bytes": self.size,
                "sha256": self.sum.hexdigest(), "first_id": self.first, "last_id": self.last}


_SORTED = ("shard int, page_id long, is_page boolean, digest binary, url string, body binary, refers_to long")


def _deal(places: list, compress: bool):
    """Add the shard to each row and press the payloads."""
    names = [c.split()[0] for c in _SORTED.split(", ")]

    def run(batches):
        press = zstandard.ZstdCompressor(level=1).compress
        for b in batches:
            ids, digests = b.column("page_id").to_pylist(), b.column("digest").to_pylist()
            shard = pa.array([range_of(places, i, d) for i, d in zip(ids, digests)], pa.int32())
            body = b.column("body")
            if compress:
                body = pa.array([press(memoryview(t.as_buffer())) for t in body], pa.binary())
            yield pa.RecordBatch.from_arrays([shard, *[body if n == "body" else b.column(n) for n in names[1:]]], names)

    return run


def _write(root: str, limit: int, date: str):
    schema = pa.schema([("file", pa.string()), ("shard", pa.int32()), ("roll", pa.int32()), ("records", pa.int64()),
                        ("bytes", pa.int64()), ("sha256", pa.string()), ("first_id", pa.int64()), ("last_id", pa.int64())])

    def run(batches):
        # a name that no other attempt has, of this task or of one that runs beside it
        files = _Files(root, limit, date, f"{TaskContext.get().taskAttemptId()}-{uuid.uuid4().hex[:8]}")
        here, said, seen = None, {}, {}
        for b in batches:
            done = []
            for r in zip(*[b.column(n).to_pylist() for n in ("shard", "page_id", "is_page", "digest", "url", "refers_to")],
                         b.column("body")):
                shard, page_id, is_page, digest, url, refers_to, body = r
                if files.shard != shard:
                    done.append(files.start(shard))
                    here, said, seen = None, {}, {}
                if here != (page_id,):
                    here, said, seen = (page_id,), {}, {}
                if not is_page:
                    said[digest] = refers_to
                    continue
                payload = unpressed(body.as_buffer().to_pybytes())
                nth = seen[digest] = seen.get(digest, -1) + 1
                first = digest not in said or (said[digest] == page_id and not nth)
                raw = page_record(RESPONSE if first else REVISIT, page_id, nth, url, payload, hashlib.sha1(payload).digest(),
                                  date, None if first else said[digest])
                done.append(files.add(member(raw), page_id))
            if done := [d for d in done if d]:
                yield pa.RecordBatch.from_pylist(done, schema)
        if last := files.close():
            yield pa.RecordBatch.from_pylist([last], schema)

    return run


def _manifest_path(spark: SparkSession, root: str):
    """Hadoop file system and path of a manifest; one that is there raises."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/_manifest")
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if store.exists(path):
        raise OSError(f"{path} is there already")
    return store, path


def _commit(spark: SparkSession, files: DataFrame, root: str) -> None:
    """Write the files and their manifest under a temporary name, and rename it."""
    temporary = f"{root}/_manifest-{uuid.uuid4().hex}.tmp"
    files.write.parquet(temporary)
    store, path = _manifest_path(spark, root)
    if not store.rename(spark._jvm.org.apache.hadoop.fs.Path(temporary), path):
        raise OSError(f"cannot rename {temporary}")


def write_warc(pages: DataFrame, root: str | None = None, shard_bytes: int = SHARD_BYTES, file_bytes: int | None = None,
               least_bytes: int = 0, date: str = DATE, page_id: str = "page_id", url: str = "url", html: str = "html") -> str:
    """Write a record per page under ``root`` (a fresh shared folder by default), which is returned.

    Pages stand in the order of id, payload digest and address. Shards hold
    about ``shard_bytes`` of payload (or a 16,384th of all, if that is
    more), files up to ``file_bytes`` compressed (an eighth of a shard by
    default; a larger record is a file of its own). Payloads of fewer than
    ``least_bytes`` are never revisits.

    Null pages are empty payloads; null ids come first and count as the
    smallest; a null address is left out of the record, and characters that
    a header cannot hold are percent-encoded. Rows that repeat id and
    payload are one response, if theirs is the largest id, and revisits of
    it. An empty table writes a manifest without files. Other columns are
    ignored. A heavy id is cut by digest, so only rows that repeat id and
    payload share a shard for certain, as a stream. An archive that is there
    already is not overwritten (``OSError``).
    """
    spark = pages.sparkSession
    small_batches(spark)
    root = root or scratch_path(spark, "llm", "warc")
    _manifest_path(spark, root)
    fs, folder = filesystem(root)
    fs.create_dir(folder, recursive=True)
    body = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), body.alias("body"),
                        F.unhex(F.sha1(body)).alias("digest"))
    narrow = staged(rows.select(F.col("page_id").alias("id"), "digest", F.octet_length("body").cast("long").alias("size")), "warc_rows")
    total = narrow.agg(F.sum("size")).first()[0] or 0
    target = max(shard_bytes, -(-total // MOST_SHARDS))
    places = byte_ranges(narrow, target)
    # a largest id of null is one, too, so the value is a struct
    largest = with_group_value(narrow.where(F.col("size") >= least_bytes), "digest", F.struct(F.max("id").alias("id")), "largest")
    said = largest.where("largest IS NOT NULL").select(
        F.col("id").alias("page_id"), F.lit(False).alias("is_page"), "digest", F.lit(None).cast("string").alias("url"),
        F.lit(None).cast("binary").alias("body"), F.col("largest.id").alias("refers_to"))
    own = rows.select("page_id", F.lit(True).alias("is_page"), "digest", "url", "body", F.lit(None).cast("long").alias("refers_to"))
    shards = said.mapInArrow(_deal(places, False), _SORTED).unionByName(own.mapInArrow(_deal(places, True), _SORTED))
    in_order = shards.repartition(len(places) + 1, "shard").sortWithinPartitions("shard", "page_id", "is_page", "digest", "url")
    files = in_order.mapInArrow(_write(root, file_bytes or target // 8, date), MANIFEST)
    _commit(spark, files, root)
    return root


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """The files of an archive; one that was not finished has no manifest and raises."""
    return spark.read.schema(MANIFEST).parquet(f"{root}/_manifest")


def members(stream, found: "hashlib._Hash") -> Iterator[bytes]:
    """Uncompressed gzip members of a stream, one at a time; ``found`` is updated with all bytes."""
    unpress, parts = zlib.decompressobj(31), []
    while chunk := stream.read(1 << 16):
        found.update(chunk)
        while chunk:
            parts.append(unpress.decompress(chunk))
            chunk = b""
            if unpress.eof:
                yield b"".join(parts)
                chunk, unpress, parts = unpress.unused_data, zlib.decompressobj(31), []
    if parts:
        raise ValueError("a record is cut off")


def parsed(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Fields and block of a record; a wrong length or digest raises ``ValueError``."""
    head, _, rest = raw.partition(END)
    version, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[:-len(END)]
    if version != VERSION or not rest.endswith(END) or len(block) != int(fields["Content-Length"]):
        raise ValueError("not a whole WARC record")
    if fields["WARC-Block-Digest"] != f"sha1:{base32(hashlib.sha1(block).digest())}":
        raise ValueError(f"record {fields['WARC-Record-ID']} is damaged")
    return fields, block


def _page(fields: dict[str, str], block: bytes, payloads: bool) -> dict:
    head, _, payload = block.partition(END)
    length = int(head.decode().rpartition("Content-Length: ")[2])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == RESPONSE and (len(payload) != length or base32(hashlib.sha1(payload).digest()) != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} is damaged")
    number = lambda name: int(fields[name]) if name in fields else None
    return {"page_id": number("X-Page-ID"), "url": fields.get("WARC-Target-URI"), "record_type": kind, "payload_bytes": length,
            "payload_digest": digest, "refers_to": number("X-Refers-To-Page-ID"),
            "payload": payload if payloads and kind == RESPONSE else None}


def read_warc(spark: SparkSession, root: str, payloads: bool = True, most: int = 2 << 20) -> DataFrame:
    """The records of an archive's files, each read as a stream in one task and checked against the manifest.

    ``payload`` is null for revisits, and throughout without ``payloads``.
    A file that is missing, cut off or changed fails the read.
    """
    files = manifest(spark, root).select("file", "sha256", "records")
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])

    def run(batches):
        fs, folder = filesystem(root)
        for b in batches:
            for name, sha256, records in zip(*[c.to_pylist() for c in b.columns]):
                found, rows, held, n = hashlib.sha256(), [], 0, 0
                with fs.open_input_stream(os.path.join(folder, name), compression=None) as stream:
                    for raw in members(stream, found):
                        fields, block = parsed(raw)
                        if fields["WARC-Type"] == "warcinfo":
                            continue
                        rows.append(_page(fields, block, payloads))
                        held, n = held + len(block) * payloads + 256, n + 1
                        if held > most:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                if (found.hexdigest(), n) != (sha256, records):
                    raise ValueError(f"{name} is not the file of the manifest")
                yield pa.RecordBatch.from_pylist(rows, schema)

    return files.repartition(max(1, files.count())).mapInArrow(run, RECORDS)


WARC_SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (
  SELECT *, sha1(html) AS h, octet_length(encode(html)) AS payload_bytes,
         max(page_id) OVER (PARTITION BY html) AS largest, row_number() OVER (PARTITION BY html ORDER BY page_id DESC) AS nth
  FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
       list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + ((CAST('0x' || substr(h, 1 + 5 * CAST(i // 4 AS INT), 5) AS INT) >> CAST(15 - 5 * (i % 4) AS INT)) & 31), 1)),
         'string_agg', '') AS payload_digest,
       CASE WHEN nth = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN nth > 1 THEN largest END AS refers_to
FROM d
"""
