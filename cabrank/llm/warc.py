"""Pages as WARC archives: written in order by many tasks, and read back.

Records are sorted by page id, then digest, over ranges, so that an id of many
pages spans several. Each task writes its range, one gzip member for each record,
and begins a new file when the compressed size passes a bound. Digests and headers
are made anew from the payload. Of records with equal payloads (of a given size at
least) the one with the smallest page id is a response, the others are revisits
that refer to it, by record id and URL, and carry no payload.

A file gets its name only when it is whole, and counts only once the manifest
lists it, so a lost or repeated task leaves nothing that a reader would see.
Record ids come from page id, URL and digest: the same page gives the same bytes.

NULL html is an empty payload; a record without a URL or page id lacks that
header. NULL ids sort first and are never referred to if another id has the
payload. Of rows equal in id and payload one is the response. An empty table
gives no files and no rows.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabrank.llm.common import staged, tasks_for
from cabrank.llm.storage import committed, open_folder
from cabrank.llm.tokens import rows_of
from cabrank.sinks.reports import shared_folder

FILE_BYTES = 16 << 20
DATE = "2024-01-01T00:00:00Z"
LEVEL = 6
READ_BYTES = 1 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, url: str | None, payload_digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {payload_digest} {url}')}>"


def record(kind: str, headers: list[tuple[str, object]], block: bytes) -> bytes:
    """One record as a gzip member of its own. Headers without a value are left out; line breaks in one are escaped."""
    lines = [("WARC-Type", kind), ("WARC-Date", DATE), *headers, ("Content-Length", len(block))]
    text = "".join(
        f"{name}: {str(value).replace('%', '%25').replace(chr(13), '%0D').replace(chr(10), '%0A') if name.endswith('Target-URI') else value}\r\n"
        for name, value in lines
        if value is not None
    )
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(b"WARC/1.1\r\n" + text.encode() + b"\r\n" + block + b"\r\n\r\n") + packer.flush()


def page_record(
    page_id: int | None, url: str | None, payload: bytes, response: bool, refers_to: int | None = None, refers_url: str | None = None
) -> bytes:
    own = digest(payload)
    head = HTTP % len(payload)
    shared: list[tuple[str, object]] = [
        ("WARC-Record-ID", record_id(page_id, url, own)),
        ("WARC-Target-URI", url),
        ("WARC-Payload-Digest", f"sha1:{own}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("X-Page-ID", page_id),
        ("X-Payload-Length", len(payload)),
    ]
    if response:
        block = head + payload
        return record("response", [*shared, ("WARC-Block-Digest", f"sha1:{digest(block)}")], block)
    more = [
        ("WARC-Profile", PROFILE),
        ("WARC-Refers-To", record_id(refers_to, refers_url, own)),
        ("WARC-Refers-To-Target-URI", refers_url),
        ("X-Refers-To-Page", refers_to),
        ("WARC-Block-Digest", f"sha1:{digest(head)}"),
    ]
    return record("revisit", [*shared, *more], head)


def marked_pages(pages: DataFrame, page_id: str, url: str, html: str, least: int) -> DataFrame:
    """Pages, and a marker in front of each whose payload occurs again: the smallest id that has it, and its URL.

    Markers are found on ids and digests alone, folded by digest in each task
    first; staged, they let the join deal a popular digest over several tasks.
    So payloads move only once, together with the markers, to be sorted. Payloads
    below ``least`` bytes get no marker.
    """
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    named = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), payload.alias("payload"))
    named = named.withColumn("sha1", F.sha1("payload"))
    digests = named.filter(F.octet_length("payload") >= least).select("page_id", "sha1", "url")
    known = F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url")))
    unknown = F.min(F.struct(F.lit(None).cast("long").alias("page_id"), "url"))
    firsts = digests.groupBy("sha1").agg(F.coalesce(known, unknown).alias("first"), F.count("*").alias("n")).filter("n > 1")
    firsts = firsts.select("sha1", F.col("first.page_id").alias("first"), F.col("first.url").alias("first_url"))
    markers = digests.drop("url").join(staged(firsts, "firsts"), "sha1").distinct()
    none = {"first": F.lit(None).cast("long"), "first_url": F.lit(None).cast("string"), "marker": F.lit(False)}
    return named.withColumns(none).unionByName(
        markers.withColumn("marker", F.lit(True)), allowMissingColumns=True
    )


def write_archives(
    pages: DataFrame,
    uri: str,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    least: int = 0,
    file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Write the archives below ``uri``; the manifest, staged: file, records, bytes, CRC-32."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        records = _records(batches)
        pending = next(records, None)
        number = 0
        while pending is not None:
            name = f"pages-{task:06d}-{number:05d}.warc.gz"
            size = count = check = 0
            with committed(uri, name) as stream:
                while pending is not None and size < file_bytes:
                    stream.write(pending)
                    size, count, check = size + len(pending), count + 1, zlib.crc32(pending, check)
                    pending = next(records, None)
            yield pa.RecordBatch.from_pydict({"file": [name], "records": [count], "bytes": [size], "crc32": [check]})
            number += 1

    ranged = marked_pages(pages, page_id, url, html, least).repartitionByRange("page_id", "sha1")
    ordered = ranged.sortWithinPartitions("page_id", "sha1", F.desc("marker"), "url")
    return staged(ordered.mapInArrow(write, "file string, records long, bytes long, crc32 long"), "manifest")


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[bytes]:
    """Packed records of sorted pages. Rows equal in id and payload follow each other; the first is the response."""
    marked, smallest, its_url, fresh = None, None, None, False
    for rows in rows_of(batches, "page_id", "url", "payload", "sha1", "first", "first_url", "marker", most=64):
        for page_id, url, payload, sha1, first, first_url, marker in rows:
            if marker:
                marked, smallest, its_url, fresh = (page_id, sha1), first, first_url, True
                continue
            revisit = (page_id, sha1) == marked and not (fresh and page_id == smallest)
            fresh = False
            yield page_record(page_id, url, payload, not revisit, *((smallest, its_url) if revisit else ()))


def parse(stream: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of an archive, read in pieces of bounded size."""
    unpacker = zlib.decompressobj(31)
    content = bytearray()
    while piece := stream.read(READ_BYTES):
        while piece:
            content += unpacker.decompress(piece)
            piece = unpacker.unused_data
            if unpacker.eof:
                head, _, rest = bytes(content).partition(b"\r\n\r\n")
                lines = [line.partition(": ") for line in head.decode().split("\r\n")[1:]]
                headers = {name: value for name, _, value in lines}
                yield headers, rest[: int(headers["Content-Length"])]
                unpacker, content = zlib.decompressobj(31), bytearray()


def read_archives(manifest: DataFrame, uri: str) -> DataFrame:
    """Per record of the listed archives: page id, size and digest of its payload, type and what it refers to.

    A response whose block does not have the digest that its header gives ends
    the job.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = open_folder(uri)
        for rows in rows_of(batches, "file", "records"):
            for name, expected in rows:
                out = []
                with system.open_input_stream(f"{folder}/{name}", compression=None) as stream:
                    for headers, block in parse(stream):
                        if headers["WARC-Block-Digest"] != f"sha1:{digest(block)}":
                            raise ValueError(f"{name}: a block does not have its digest")
                        out.append(_described(headers, block))
                if len(out) != expected:
                    raise ValueError(f"{name}: {len(out)} records, {expected} in the manifest")
                arrays = [pa.array(column, kind) for column, kind in zip(zip(*out, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names)

    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return manifest.repartition(tasks_for(manifest, manifest.count()), "file").mapInArrow(read, schema)


def _described(headers: dict[str, str], block: bytes) -> tuple:
    number = headers.get("X-Page-ID")
    page_id = None if number is None else int(number)
    if headers["WARC-Type"] == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        return page_id, len(payload), digest(payload), "response", None
    refers_to = headers.get("X-Refers-To-Page")
    own = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    return page_id, int(headers["X-Payload-Length"]), own, "revisit", None if refers_to is None else int(refers_to)


def archive_pages(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", least: int = 0) -> DataFrame:
    """Write all pages under the shared folder and read the archives back."""
    uri = shared_folder(pages.sparkSession, "archives")
    return read_archives(write_archives(pages, uri, page_id, url, html, least), uri)
