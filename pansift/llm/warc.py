"""WARC archives with dictionary-compressed records (.warc.zst).

Writer: a task gathers records up to ``ARCHIVE_BYTES``, builds a Zstandard
dictionary from them, and writes one file: a skippable frame that holds the
dictionary, then each record as a frame of its own, so any record can be read
alone.  A payload that another page has too is stored once; its other pages
become revisit records.  Files go to a shared folder under names that no
other attempt uses; the manifest, a table that Spark commits, lists those that
count, so files of lost tasks are never read.

Reader: tasks stream the archives of a manifest record by record.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pansift.llm._common import cut_lineage, prepare, scratch_path

#: Bytes of uncompressed records in an archive, about; a task holds them once.
ARCHIVE_BYTES = 32 << 20
#: Bytes of a dictionary, and of the records it is built from (evenly spread over the archive).
DICTIONARY_BYTES, SAMPLE_BYTES = 32 << 10, 3 << 20
#: The skippable frame of a dictionary, and the date of records whose crawl date is unknown.
DICTIONARY_FRAME = 0x184D2A5D
UNDATED = "1970-01-01T00:00:00Z"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_ID = "urn:pansift:page:"


# -- files ------------------------------------------------------------------------

def file_system(folder: str):
    """Arrow's file system and path for a folder as Spark names it."""
    from pyarrow import fs
    if re.match(r"file:/(?!/)", folder):
        folder = "file://" + folder[5:]
    return fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), os.path.abspath(folder))


# -- records ------------------------------------------------------------------------

def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _field(value: str) -> str:
    """A header value: control characters would end the line, so they are escaped."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record(page_id: int | None, url: str | None, payload: bytes | None, n_bytes: int, sha1: str,
           refers_to: int | None, date: str = UNDATED) -> bytes:
    """A response record (``payload`` given) or a revisit record (None)."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n".encode()
    block = http + (payload or b"")
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if payload is None else 'response'}",
            f"WARC-Record-ID: <{_ID}{'' if page_id is None else page_id}>", f"WARC-Date: {date}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_field(url)}")
    head.append(f"WARC-Payload-Digest: sha1:{sha1}")
    if payload is None:
        head += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: <{_ID}{'' if refers_to is None else refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """What ``record`` was given; raises if the record is damaged."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block, end = rest[: int(fields["Content-Length"])], rest[int(fields["Content-Length"]):]
    http, _, payload = block.partition(b"\r\n\r\n")
    n_bytes = int(re.search(rb"Content-Length: (\d+)", http)[1])
    sha1, page = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Record-ID"][len(_ID) + 1:-1]
    refers = fields.get("WARC-Refers-To", f"<{_ID}>")[len(_ID) + 1:-1]
    kind = fields["WARC-Type"]
    if lines[0] != "WARC/1.1" or end != b"\r\n\r\n" or kind == "response" and (len(payload) != n_bytes or digest(payload) != sha1):
        raise ValueError(f"damaged record {page}")
    return {"page_id": page or None, "url": fields.get("WARC-Target-URI"), "record_type": kind, "payload_bytes": n_bytes,
            "payload_digest": sha1, "refers_to": refers or None, "payload": payload if kind == "response" else None}


# -- archives ------------------------------------------------------------------------

def dictionary(records: list[bytes]):
    """A dictionary from records spread evenly over the archive; from few or
    uniform records their own bytes serve."""
    import zstandard
    total = sum(map(len, records))
    step = max(1, -(-total // SAMPLE_BYTES))
    chosen = [r[:128 << 10] for r in records[::step]]
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, max(1024, total // 32)), chosen, k=256, d=8)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"".join(chosen)[:DICTIONARY_BYTES], dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def archive(records: list[bytes]) -> bytes:
    import zstandard
    d = dictionary(records)
    raw = d.as_bytes()
    pack = zstandard.ZstdCompressor(level=3, dict_data=d, write_checksum=True)
    return b"".join([struct.pack("<II", DICTIONARY_FRAME, len(raw)), raw, *map(pack.compress, records)])


def read_archive(stream, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The records of an open archive, one at a time."""
    import zstandard
    magic, size = struct.unpack("<II", stream.read(8))
    if magic != DICTIONARY_FRAME:
        raise ValueError("no dictionary frame")
    unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(stream.read(size)))
    rest = stream.read(chunk)
    while rest:
        one, parts = unpack.decompressobj(), []
        while not one.eof:
            if not rest:
                raise ValueError("truncated archive")
            parts.append(one.decompress(rest))
            rest = one.unused_data if one.eof else stream.read(chunk)
        yield b"".join(parts)
        rest = rest or stream.read(chunk)


# -- tables ---------------------------------------------------------------------------

def assign_types(pages: DataFrame, least_bytes: int = 0, id_col: str = "page_id", url_col: str = "url",
                 html_col: str = "html") -> DataFrame:
    """``page_id, url, html, response_id``: of pages with equal payloads of at
    least ``least_bytes`` bytes, which page holds the response."""
    prepare(pages.sparkSession)
    html = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        html.alias("html"), F.unhex(F.sha2(F.encode(html, "utf-8"), 256)).alias("key"))
    first = (rows.groupBy("key").agg(F.min("page_id").alias("response_id")))
    alone = F.octet_length("html") < least_bytes
    return rows.join(first, "key").select(
        "page_id", "url", "html", F.when(alone, F.col("page_id")).otherwise(F.col("response_id")).alias("response_id"))


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES,
                   date: str = UNDATED, **columns: str) -> DataFrame:
    """Write a record per row of ``pages`` into archives in ``folder`` (a
    shared one) and return their manifest: ``path, records, bytes``.

    Null html is an empty payload; a null url leaves its header out; null ids
    are allowed and refer to the response like others; rows that repeat a
    response's id and payload are responses, too; other columns are not read;
    an empty table gives an empty manifest.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = file_system(folder)
        system.create_dir(base, recursive=True)

        def flush(records: list[bytes]) -> pa.RecordBatch:
            path = f"{base}/{uuid.uuid4().hex}.warc.zst"
            data = archive(records)
            with system.open_output_stream(path, compression=None) as out:
                out.write(data)
            return pa.RecordBatch.from_pylist([{"path": os.path.basename(path), "records": len(records), "bytes": len(data)}])

        held, size = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                for p in batch.slice(at, 500).to_pylist():
                    payload = p["html"].encode()
                    again = p["page_id"] != p["response_id"]
                    held.append(record(p["page_id"], p["url"], None if again else payload, len(payload), digest(payload),
                                       p["response_id"] if again else None, date))
                    size += len(held[-1])
                    if size >= archive_bytes:
                        yield flush(held)
                        held, size = [], 0
        if held:
            yield flush(held)

    return cut_lineage(assign_types(pages, least_bytes, **columns)
                       .mapInArrow(run, "path string, records long, bytes long"), "manifest")


def read_archives(manifest: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """Records of the archives in a manifest: ``page_id, url, record_type,
    payload_bytes, payload_digest, refers_to`` and, if wanted, ``payload``
    (null for revisits).  Every response's digest is checked."""
    columns = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to"] + ["payload"] * payloads

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, base = file_system(folder)
        for frame in frames:
            for name in frame["path"]:
                rows, size = [], 0
                with system.open_input_stream(f"{base}/{name}", compression=None) as stream:
                    for raw in read_archive(stream):
                        rows.append(parse(raw))
                        if not payloads:
                            del rows[-1]["payload"]
                        size += len(raw) if payloads else 300
                        if size > 16 << 20:
                            yield pd.DataFrame(rows, columns=columns)
                            rows, size = [], 0
                if rows:
                    yield pd.DataFrame(rows, columns=columns)

    schema = ("page_id string, url string, record_type string, payload_bytes long, payload_digest string, "
              "refers_to string" + ", payload binary" * payloads)
    ids = {c: F.col(c).cast("long") for c in ("page_id", "refers_to")}  # text on the way, since pandas' numbers hold no nulls
    parts = max(1, manifest.count())
    return manifest.select("path").repartition(parts, "path").mapInPandas(run, schema).withColumns(ids)


def archive_folder(spark: SparkSession) -> str:
    """A fresh folder for archives in the shared checkpoint folder."""
    return scratch_path(spark, "warc")
