"""WARC archives: writing them in tasks, and a sequential reader.

Every record is one gzip member. The reader takes blocks of an archive, inflates them step by step, frames a record by
its Content-Length and checks its digest, so neither an archive nor a record has to fit in memory at once unless its
payload is asked for. Of records with equal payloads of at least ``REVISIT_BYTES`` bytes, the one with the smallest
page_id is a response, the others are revisits that hold no payload.

Archives are written by the tasks to the shared work folder under names no other attempt uses; a manifest, itself
a table, lists the archives of the attempts that counted, and only these are read. A lost executor
therefore costs its own archives and nothing else.

Defined results: null html is an empty payload; a null url is an empty target; line ends in a url are percent-encoded; rows
that repeat the page_id of the response and its payload are responses too; a null page_id is written as ``none``
and is a response only if no other row has its payload. A truncated or damaged archive raises an error.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airpanel.llm.batches import by_value, slices, stored
from airpanel.session import work_folder

by_value(__name__)

REVISIT_BYTES = 100
READ_BYTES = 1 << 20
GZIP_LEVEL = 3
_PAGE = "urn:page:"
_WHEN = "2024-01-01T00:00:00Z"  # records are stamped alike, so that reruns write the same bytes


def _folder(path: str) -> tuple[fs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path.replace("file:///", "/") if path.startswith("file:///") else path)
    return fs.LocalFileSystem(), path


def _id(page: int | None) -> str:
    return f"<{_PAGE}{'none' if page is None else page}>"


def record_bytes(page: int | None, url: str, payload: bytes, digest: str, response: int | None, revisit: bool) -> bytes:
    """One gzip member: the WARC header, an HTTP head that states the payload's length, and the payload of a response."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = head if revisit else head + payload
    target = url.replace("\r", "%0D").replace("\n", "%0A")
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_id(page)}",
        f"WARC-Date: {_WHEN}", f"WARC-Target-URI: {target}", "Content-Type: application/http;msgtype=response",
        f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}"]
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: {_id(response)}"]
    lines.append(f"Content-Length: {len(block)}")
    packer = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n") + packer.compress(
        block + b"\r\n\r\n") + packer.flush()


def _write(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    system, base = _folder(folder)
    out, path, records, size = None, "", 0, 0
    for batch in slices(batches, "html"):
        if out is None:
            path = f"{folder}/{uuid.uuid4().hex}.warc.gz"
            out = system.open_output_stream(f"{base}/{path.rsplit('/', 1)[1]}", compression=None)
        for row in batch.to_pylist():
            member = record_bytes(row["page_id"], row["url"], row["html"], row["digest"], row["refers_to"], row["revisit"])
            out.write(member)
            records, size = records + 1, size + len(member)
    if out is not None:
        out.close()
        yield pa.RecordBatch.from_pydict({"path": [path], "records": [records], "bytes": [size]})


def _payload(pages: DataFrame) -> Column:
    return F.coalesce(pages["html"].cast("string"), F.lit("")).cast("binary")


def with_revisits(pages: DataFrame) -> DataFrame:
    """page_id, url, html (binary), digest, revisit and refers_to of every page."""
    ready = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
        _payload(pages).alias("html")).withColumn("digest", F.sha2("html", 256))
    large = F.octet_length("html") >= REVISIT_BYTES
    # Shared digests are found from digests alone, and stored, so that Spark can split the join of a payload
    # that many pages share. The pages themselves move once.
    first = stored(ready.where(large).groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
                   .where("n > 1").select("digest", "first_id"), "warc-shared")
    again = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return ready.join(first, "digest", "left").select(
        "page_id", "url", "html", "digest", again.alias("revisit"), F.when(again, F.col("first_id")).alias("refers_to"))


def write_warc(pages: DataFrame, folder: str) -> DataFrame:
    """Write all pages to archives below ``folder``; returns the manifest (path, records, bytes), a stored table.

    The folder has to exist for every executor: a local path in local mode, else the URI of shared storage.
    """
    manifest = with_revisits(pages).mapInArrow(partial(_write, folder=folder), "path string, records long, bytes long")
    return stored(manifest, "warc-manifest")


class Damaged(ValueError):
    """The archive ends within a record, or a record contradicts its own header."""


def _inflated(source) -> Iterator[tuple[bytes, bool]]:
    """(bytes, whether a gzip member ends with them) of an archive, in order."""
    packed, inflate = b"", zlib.decompressobj(31)
    while True:
        packed = packed or source.read(READ_BYTES)
        if not packed:
            if inflate is not None:
                raise Damaged("the archive ends within a member")
            return
        inflate = inflate or zlib.decompressobj(31)
        try:
            plain = inflate.decompress(packed, READ_BYTES)
        except zlib.error as error:
            raise Damaged(str(error)) from error
        packed = inflate.unused_data if inflate.eof else inflate.unconsumed_tail
        yield plain, inflate.eof
        if inflate.eof:
            inflate = None
            if not packed:
                packed = source.read(READ_BYTES)
                if not packed:
                    return


def read_records(source, payloads: bool = False) -> Iterator[dict]:
    """The records of one archive, checked one by one as they pass."""
    head, fields, length, seen = b"", None, 0, 0
    block_digest = payload_digest = None
    http, payload, tail = b"", bytearray(), b""
    for plain, last in _inflated(source):
        if fields is None:
            head += plain
            cut = head.find(b"\r\n\r\n")
            if cut >= 0:
                lines = head[:cut].decode("utf-8", "surrogatepass").split("\r\n")
                if not lines[0].startswith("WARC/"):
                    raise Damaged("a member does not begin with a WARC header")
                fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
                length, seen = int(fields["content-length"]), 0
                block_digest, payload_digest, in_body = hashlib.sha256(), hashlib.sha256(), False
                plain, head, http, payload, tail = head[cut + 4:], b"", b"", bytearray(), b""
        if fields is not None:
            block, rest = plain[:length - seen], plain[length - seen:]
            seen, tail = seen + len(block), tail + rest
            block_digest.update(block)
            if not in_body:
                http += block
                cut = http.find(b"\r\n\r\n")
                if cut >= 0:
                    in_body, block, http = True, http[cut + 4:], http[:cut]
            if in_body:
                payload_digest.update(block)
                if payloads:
                    payload += block
        if last:
            if fields is None or seen != length or tail != b"\r\n\r\n" or not in_body:
                raise Damaged("a record is not as long as its header says")
            if fields["warc-block-digest"] != f"sha256:{block_digest.hexdigest()}":
                raise Damaged(f"digest of the block of {fields['warc-record-id']}")
            stated = fields["warc-payload-digest"].removeprefix("sha256:")
            if fields["warc-type"] == "response" and stated != payload_digest.hexdigest():
                raise Damaged(f"digest of the payload of {fields['warc-record-id']}")
            sizes = [x.partition(b": ")[2] for x in http.split(b"\r\n") if x.lower().startswith(b"content-length: ")]
            yield {
                "page_id": _page(fields["warc-record-id"]), "url": fields["warc-target-uri"],
                "payload_bytes": int(sizes[0]), "payload_digest": stated, "record_type": fields["warc-type"],
                "refers_to": _page(fields["warc-refers-to"]) if "warc-refers-to" in fields else None,
                "payload": bytes(payload) if payloads and fields["warc-type"] == "response" else None}
            fields = None


def _page(name: str) -> int | None:
    page = name.strip("<>").removeprefix(_PAGE)
    return None if page == "none" else int(page)


_RECORD = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                     ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])


def _read(batches: Iterator[pa.RecordBatch], payloads: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column("path").to_pylist():
            system, base = _folder(path)
            rows, size = [], 0
            with system.open_input_stream(base, compression=None) as source:
                for record in read_records(source, payloads):
                    rows.append(record)
                    size += len(record["payload"] or b"") + 200
                    if size > READ_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema=_RECORD)
                        rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=_RECORD)


def read_warc(archives: DataFrame, payloads: bool = False) -> DataFrame:
    """All records of the archives in the column ``path``; one task reads one archive after the other."""
    listed = archives.select("path")
    return listed.repartition(max(1, listed.sparkSession.sparkContext.defaultParallelism), F.xxhash64("path")).mapInArrow(
        partial(_read, payloads=payloads),
        "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary")


def archive_folder(spark: SparkSession) -> str:
    """A new folder for archives in the shared work folder."""
    folder = work_folder(spark, "warc")
    system, base = _folder(folder)
    system.create_dir(base, recursive=True)
    return folder
