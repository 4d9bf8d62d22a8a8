"""WARC archives: written with an index of offsets, read back by sorted and coalesced byte ranges."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, functions as F

from tallyfold.llm.common import map_batches, new_folder, settle, utf8

# An archive is closed once it has this many bytes.
ARCHIVE_BYTES = 256 << 20
# Records at most this far apart are read at once, up to so many bytes.
READ_GAP = 64 << 10
READ_BYTES = 4 << 20
# Unit in which records are dealt to reading tasks.
STRETCH = 32 << 20
_DATE = "2024-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_INDEX = "page_id {id}, url string, record_type string, refers_to {id}, payload_digest string, file string, offset long, length long"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _clean(value) -> str:
    """A header value on one line."""
    return " ".join(str(value).split()) if value is not None else ""


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC/1.1 record; ``refers_to`` makes it a revisit, which repeats the HTTP header but not the payload."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{page_id}>",
        f"WARC-Date: {_DATE}", f"WARC-Target-URI: {_clean(url)}", f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if revisit:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {_PROFILE}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """Record header, HTTP header and payload of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    header = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    block = rest[: int(header["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return header, dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:]), payload


def _packed(raw: bytes) -> bytes:
    """A gzip member of its own, so that a record can be read without those before it."""
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


def _place(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def write(
    pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html", least: int = 0
) -> DataFrame:
    """Write a record per row of ``pages`` to ``.warc.gz`` files in ``folder``; return the index of them.

    Of equal payloads of at least ``least`` bytes the one with the smallest id
    is a response, the others revisit it (repeated rows of that id are
    responses too; where no id is known, all are). A null html is an empty
    payload. Equal payloads are found from digests, with a map-side part; the
    join may have a hot digest, which adaptive execution divides.

    A task writes under a name of its own and puts it into the index only when
    closed; files of failed attempts are in no index.
    """
    pages = pages.select(
        F.col(page_id).alias("page_id"), F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(html).cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("sha1", F.unhex(F.sha1("payload")))
    first = pages.where(F.length("payload") >= least).groupBy("sha1").agg(F.min("page_id").alias("first"))
    # The digests are computed twice rather than written; the payload is shuffled once.
    typed = pages.join(first, "sha1", "left").select(
        "page_id", "url", "payload", F.when(F.col("page_id").eqNullSafe(F.col("first")), None).otherwise(F.col("first")).alias("refers_to")
    )
    spark = pages.sparkSession
    schema = _INDEX.format(id=dict(typed.dtypes)["page_id"])
    names = [x.split()[0] for x in schema.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _place(folder)
        fs.create_dir(root, recursive=True)
        out, name, at = None, "", 0
        pending: list[tuple] = []
        kind = None

        def close() -> pa.RecordBatch:
            out.close()
            kinds = [kind, pa.string(), pa.string(), kind, pa.string(), pa.string(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in pending], k) for i, k in enumerate(kinds)], names
            )

        for batch in batches:
            kind = batch.column(0).type
            ids, urls, refs = (batch.column(i).to_pylist() for i in (0, 1, 3))
            for i, u, payload, ref in zip(ids, urls, utf8(batch.column(2)), refs, strict=True):
                if out is None:
                    name, at, pending = f"{uuid.uuid4().hex}.warc.gz", 0, []
                    out = fs.open_output_stream(f"{root}/{name}", compression=None)
                digest = digest_of(payload)
                packed = _packed(record(i, u, payload, digest, ref))
                out.write(packed)
                pending.append((i, u, "response" if ref is None else "revisit", ref, digest, name, at, len(packed)))
                at += len(packed)
                if at >= ARCHIVE_BYTES:
                    yield close()
                    out = None
        if out is not None:
            yield close()

    return settle(map_batches(typed, work, schema))


def ranges(entries: Iterable[tuple[int, int]]) -> Iterator[tuple[int, int, list[int]]]:
    """Sorted ``(offset, length)`` as ``(start, end, entry numbers)`` of reads that cover them."""
    start = end = 0
    members: list[int] = []
    for k, (offset, length) in enumerate(entries):
        if members and (offset - end > READ_GAP or offset + length - start > READ_BYTES):
            yield start, end, members
            members = []
        if not members:
            start = end = offset
        members.append(k)
        end = max(end, offset + length)
    if members:
        yield start, end, members


def read(selected: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The records that the index rows ``selected`` name, as ``(page_id, url, record_type, refers_to, payload_digest, payload_bytes, payload)``.

    Everything but the ids is read from the archives; a revisit has a null
    payload and the size its header states; without ``payloads`` that column is null. A stretch of an archive is one
    group of rows, sorted by offset and read in coalesced ranges; records that
    are not selected are skipped. Raises where a payload differs from its digest.
    """
    kind = dict(selected.dtypes)["page_id"]
    schema = f"page_id {kind}, url string, record_type string, refers_to {kind}, payload_digest string, payload_bytes long, payload binary"
    names = [x.split()[0] for x in schema.split(", ")]
    keyed = selected.select("page_id", "refers_to", "file", "offset", "length").withColumn(
        "stretch", (F.col("offset") / STRETCH).cast("long")
    )
    # As many partitions as stretches: without a number, adaptive execution would join them by the size of the
    # index rows, and one task would read all archives.
    stretches = keyed.select("file", "stretch").distinct().count()
    ordered = keyed.repartition(max(1, stretches), "file", "stretch").sortWithinPartitions("file", "offset")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _place(folder)
        opened, source = None, None
        for batch in batches:
            rows = batch.to_pydict()
            kinds = [batch.column(0).type, pa.string(), pa.string(), batch.column(0).type, pa.string(), pa.int64(), pa.binary()]
            at = 0
            while at < batch.num_rows:
                name, to = rows["file"][at], at
                while to < batch.num_rows and rows["file"][to] == name:
                    to += 1
                if name != opened:
                    opened, source = name, fs.open_input_file(f"{root}/{name}")
                entries = list(zip(rows["offset"][at:to], rows["length"][at:to], strict=True))
                for start, end, members in ranges(entries):
                    source.seek(start)
                    chunk, out = source.read(end - start), []
                    for k in members:
                        offset, length = entries[k]
                        header, http, payload = parse(zlib.decompress(chunk[offset - start:offset - start + length], 31))
                        digest = header["WARC-Payload-Digest"].removeprefix("sha1:")
                        revisit = header["WARC-Type"] == "revisit"
                        if not revisit and digest_of(payload) != digest:
                            raise ValueError(f"{name} at {offset}: the payload differs from its digest")
                        stated = header["WARC-Record-ID"], header.get("WARC-Refers-To")
                        page, ref = rows["page_id"][at + k], rows["refers_to"][at + k]
                        if stated != (f"<urn:page:{page}>", f"<urn:page:{ref}>" if revisit else None):
                            raise ValueError(f"{name} at {offset}: the record is not the one in the index")
                        out.append((
                            page, header["WARC-Target-URI"], header["WARC-Type"], ref, digest, int(http["Content-Length"]),
                            None if revisit or not payloads else payload,
                        ))
                    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)], names)
                at = to

    return map_batches(ordered, work, schema)


def round_trip(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to)`` of every page, from archives written and read back.

    Repeated rows and null ids each have a record; null and empty html have an
    empty payload; a null or broken URL is stored as far as one header line
    allows; other columns are ignored; an empty table gives no archive.
    """
    folder = new_folder(pages.sparkSession, "warc")
    index = write(pages, folder, page_id, url, html)
    return read(index, folder, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
