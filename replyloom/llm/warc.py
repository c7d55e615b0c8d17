"""Deterministic sharded WARC archives, written once and read back.

Records are dealt to shards by ranges of their key (equal-width buckets of keys, cut where the
running sum of payload bytes passes ``shard_bytes``, so that the same rows give the same
shards on every run), sorted within, and written as one gzip member each. A file is rolled when
its compressed size passes ``roll_bytes``. Of records with equal payloads of at least
``min_bytes`` bytes the one with the smallest key is stored, the others become revisits.

A task writes under names of its own attempt and renames each file when it is whole; the
content of a final name is the same whichever attempt wrote it. What counts is the manifest, a
table of files with their digests that Spark commits at the end: readers open only files that it
lists and check them. Files are reached through ``pyarrow.fs``, so the folder may be any store
that it knows.

Defined results: a null payload is the empty one; null keys come first, in the first shard;
rows that repeat the smallest key of a payload are all responses; an empty table gives an empty
manifest; a payload of any length is one record; header values lose control characters.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from itertools import groupby
from urllib.parse import quote

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from replyloom.llm.common import map_rows
from replyloom.session import materialize, new_path

SHARD_BYTES = 64 << 20
ROLL_BYTES = 16 << 20
BUCKETS = 4096
DATE = "2000-01-01T00:00:00Z"
#: What a URI may hold; anything else is escaped.
SAFE = "!#$%&'()*+,/:;=?@[]~-._"
NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:replyloom:warc")
MANIFEST = "file string, shard bigint, records bigint, bytes bigint, sha256 string"


def record_id(key: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, str(key))}>"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if re.match(r"\w+:/", path) else (fs.LocalFileSystem(), path)


def sharded(pages: DataFrame, key: str, url: str, payload: str, min_bytes: int, shard_bytes: int) -> tuple[DataFrame, int]:
    """All records, and a mark for each that is a revisit, with their shard; and the number of shards."""
    data = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = pages.select(
        F.col(key).cast("long").alias("key"),
        F.col(url).alias("url"),
        data.alias("payload"),
        F.sha1(data).alias("digest"),
        F.length(data).cast("long").alias("n_bytes"),
    )
    narrow = materialize(rows.select("key", "digest", "n_bytes"), "payloads")
    firsts = narrow.where(F.col("n_bytes") >= min_bytes).groupBy("digest").agg(
        F.min("key").alias("first"), F.count("*").alias("n")
    )
    ends = narrow.agg(F.min("key").alias("low"), F.max("key").alias("high")).first()
    low, high = ends["low"] or 0, ends["high"] or 0
    width = (high - low) // BUCKETS + 1
    bucket = F.coalesce(F.floor((F.col("key") - F.lit(low)) / F.lit(width)), F.lit(0)).cast("int")
    filled = narrow.groupBy(bucket.alias("bucket")).agg(F.sum(F.col("n_bytes") + 512).alias("bytes"))
    upto = F.sum("bytes").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    shards = materialize(filled, "buckets").select("bucket", F.floor(F.coalesce(upto, F.lit(0)) / shard_bytes).alias("shard"))
    # Payloads cross the network once, to their shard. What refers to an earlier record is found
    # from narrow rows and sent along as a mark that sorts right before the record.
    again = firsts.where("n > 1").select("digest", "first")
    marks = (
        narrow.join(again, "digest")
        .where("first < key")
        .select("key", "digest", F.col("first").alias("refers_to"))
        .distinct()
    )
    records = rows.select("key", "digest", "url", "payload", F.lit(None).cast("long").alias("refers_to"))
    either = records.unionByName(marks, allowMissingColumns=True).withColumn("bucket", bucket)
    # One row per bucket at most: a table of bounded size.
    count = (shards.agg(F.max("shard")).first()[0] or 0) + 1
    return either.join(F.broadcast(shards), "bucket").drop("bucket"), count


def with_references(rows: Iterator[dict]) -> Iterator[dict]:
    """Records with what the mark before them says."""
    mark = None
    for row in rows:
        if row["refers_to"] is not None:
            mark = row
        elif mark and (mark["key"], mark["digest"]) == (row["key"], row["digest"]):
            yield row | {"refers_to": mark["refers_to"]}
        else:
            yield row


def member(row: dict) -> bytes:
    """One record: WARC header, HTTP header and, unless it is a revisit, the payload."""
    payload, refers = row["payload"], row["refers_to"]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers is not None else http + payload
    headers = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(row['key'])}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {quote(row['url'] or '', safe=SAFE)}",
        f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}",
        f"WARC-Block-Digest: sha1:{base32_sha1(block)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
        f"X-Key: {'' if row['key'] is None else row['key']}",
    ]
    if refers is not None:
        headers += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {record_id(refers)}",
            f"X-Refers-To-Key: {refers}",
        ]
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)  # a gzip member without time or name
    return pack.compress("\r\n".join(headers).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + pack.flush()


def write(
    pages: DataFrame,
    folder: str,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    min_bytes: int = 0,
    shard_bytes: int = SHARD_BYTES,
    roll_bytes: int = ROLL_BYTES,
) -> DataFrame:
    """Write archives and their manifest under ``folder``; returns the manifest."""

    def archive(rows: Iterator[dict]) -> Iterator[tuple]:
        store, root = _open(folder)
        store.create_dir(root, recursive=True)
        for shard, records in groupby(rows, key=lambda row: row["shard"]):
            number, records = 0, with_references(records)
            row = next(records, None)
            while row is not None:
                name = f"shard-{shard:08d}-{number:05d}.warc.gz"
                temporary = f"{root}/.{name}.{uuid.uuid4().hex}"
                size = count = 0
                digest = hashlib.sha256()
                with store.open_output_stream(temporary, compression=None) as out:
                    while row is not None and size < roll_bytes:
                        data = member(row)
                        out.write(data)
                        digest.update(data)
                        size, count = size + len(data), count + 1
                        row = next(records, None)
                store.move(temporary, f"{root}/{name}")
                yield name, shard, count, size, digest.hexdigest()
                number += 1

    rows, shards = sharded(pages, key, url, payload, min_bytes, shard_bytes)
    order = rows.repartitionById(shards, F.col("shard").cast("int")).sortWithinPartitions("shard", F.col("key").asc_nulls_first(), "digest", F.col("refers_to").asc_nulls_last(), "url")
    map_rows(order, archive, MANIFEST).write.parquet(f"{folder}/manifest")
    return pages.sparkSession.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """``key, record_type, url, n_bytes, digest, refers_to, payload`` of every record of the
    files in the manifest. The payload of a revisit is null; a file or payload that differs
    from its digest fails the job."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")

    def parse(rows: Iterator[dict]) -> Iterator[tuple]:
        store, root = _open(folder)
        for row in rows:
            digest = hashlib.sha256()
            n = 0
            with store.open_input_stream(f"{root}/{row['file']}", compression=None) as source:
                for record in members(source, digest):
                    n += 1
                    yield parsed(record)
            if digest.hexdigest() != row["sha256"] or n != row["records"]:
                raise ValueError(f"{row['file']} differs from its manifest")

    schema = "key bigint, record_type string, url string, n_bytes bigint, digest string, refers_to bigint, payload binary"
    # One task per file; the window sees one row of each.
    number = (F.row_number().over(Window.orderBy("file")) - 1).alias("number")
    files = manifest.select("file", "records", "sha256", number)
    return map_rows(files.repartitionById(max(manifest.count(), 1), "number"), parse, schema)


def members(source, digest) -> Iterator[bytes]:
    """The gzip members of a stream, one whole record each."""
    unpack, parts = zlib.decompressobj(31), []
    while chunk := source.read(1 << 16):
        digest.update(chunk)
        while chunk:
            parts.append(unpack.decompress(chunk))
            chunk = unpack.unused_data
            if unpack.eof:
                yield b"".join(parts)
                unpack, parts = zlib.decompressobj(31), []
    if parts:
        raise ValueError("a record is cut off")


def parsed(record: bytes) -> tuple:
    head, _, rest = record.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(headers["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(http.rsplit(b"Content-Length: ", 1)[1])
    revisit = headers["WARC-Type"] == "revisit"
    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    if not revisit and (len(payload) != length or base32_sha1(payload) != digest):
        raise ValueError(f"{headers['WARC-Record-ID']} differs from its digest")
    refers = headers.get("X-Refers-To-Key")
    return (
        int(headers["X-Key"]) if headers["X-Key"] else None,
        headers["WARC-Type"],
        headers["WARC-Target-URI"],
        length,
        digest,
        int(refers) if refers else None,
        None if revisit else payload,
    )


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """Write ``pages`` to a new folder in the shared one, and what reading it back gives."""
    folder = new_path(pages.sparkSession, "warc")
    write(pages, folder, **options)
    return read(pages.sparkSession, folder)
