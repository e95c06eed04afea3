"""WARC archives: an index first, then coalesced range reads.

Each task writes its rows as gzip members of one archive after another and returns, for every record, the
archive, offset, length, URL and digest; these rows are the index, a Parquet table.  An archive's name is
never reused, and the index holds only what finished tasks returned, so a lost task leaves at most a file
that nothing refers to.  Reading takes any selection of index rows, deals them out by bytes in the order of
archive and offset, joins ranges that lie near each other into one read, and parses the records.

Archives are read and written with Arrow's file systems, so their folder can be in any shared store.

Defined results: a null page is an empty payload, and so are repeated rows records of their own.  Of equal
payloads those of the largest page_id are responses (all of them if that row is repeated, or if no row has an
id) and the others revisit them; payloads under ``least`` bytes are all responses.  A null URL leaves its
header out; control characters and spaces of a URL are percent-encoded there.  Further columns are ignored; an
empty table gives an empty index and no records.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylode.llm.common import ready
from paylode.session import scratch_path, staged

DATE = "1970-01-01T00:00:00Z"
ROLL = 512 << 20         # bytes of an archive after which a task starts another
GAP = 64 << 10           # unselected bytes that a read may span
READ = 8 << 20           # bytes of one read
READ_PER_TASK = 16 << 20

INDEX = "archive string, offset long, length long, url string, digest string, page_id long, record_type string, refers_to long"
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
_END = b"\r\n\r\n"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _location(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder)


def _uri(url: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)


def _name(page_id: int | None, digest: str) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}:{digest}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, response_id: int | None, revisits: bool) -> bytes:
    """One record, before compression."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisits else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisits else 'response'}",
             f"WARC-Record-ID: {_name(page_id, digest)}", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_uri(url)}")
    lines += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response"]
    if revisits:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: {_name(response_id, digest)}"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + _END + block + _END


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(4, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _write(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _location(folder)
        archive, out, at = None, None, 0
        try:
            for batch in batches:
                rows = []
                for page_id, url, html, response_id, revisits in zip(
                        *(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "response_id", "revisits"))):
                    if out is None or at > ROLL:
                        if out is not None:
                            out.close()
                        archive, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = store.open_output_stream(f"{root}/{archive}", compression=None)
                        info = b"software: paylode\r\n"
                        head = (f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid4()}>\r\nWARC-Date: {DATE}"
                                f"\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(info)}").encode()
                        first = _member(head + _END + info + _END)
                        out.write(first)
                        at += len(first)
                    payload = (html or "").encode()
                    digest = base32_sha1(payload)
                    member = _member(record(page_id, url, payload, digest, response_id, revisits))
                    out.write(member)
                    rows.append((archive, at, len(member), url, digest, page_id,
                                 "revisit" if revisits else "response", response_id if revisits else None))
                    at += len(member)
                yield _batch(rows, (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64()),
                             ("archive", "offset", "length", "url", "digest", "page_id", "record_type", "refers_to"))
        finally:
            if out is not None:
                out.close()

    return write


def _batch(rows: list[tuple], kinds: tuple, names: tuple) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[] for _ in kinds]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=list(names))


def write(pages: DataFrame, folder: str | None = None, least: int = 0) -> tuple[DataFrame, str]:
    """Write a record per page; the index (already stored) and the archives' folder."""
    spark = ready(pages.sparkSession)
    folder = folder or scratch_path(spark, "warc")
    store, root = _location(folder)
    store.create_dir(root, recursive=True)
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", "html", F.sha1(payload.cast("binary")).alias("sha1"),
        F.octet_length(payload).alias("size"))
    groups = rows.where(F.col("size") >= least).groupBy("sha1", "size").agg(
        F.max("page_id").alias("response_id"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    rows = rows.join(groups, ["sha1", "size"], "left").withColumn(
        "revisits", F.col("response_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response_id")))
    index = rows.select("page_id", "url", "html", "response_id", "revisits").mapInArrow(_write(folder), INDEX)
    return staged(index, "warc-index"), folder


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """A record's headers, names in lower case, and its block."""
    head, _, rest = data.partition(_END)
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    headers = {name.lower(): value for name, value in fields.items()}
    return headers, rest[:int(headers["content-length"])]


def _page_of(name: str) -> int | None:
    number = name.split(":")[2]
    return int(number) if number else None


def ranges(spots: list[tuple[int, int]], gap: int, most: int) -> Iterator[tuple[int, int, int]]:
    """Sorted ``(offset, length)`` as reads: ``(first offset, bytes, number of spots)``."""
    start = end = count = 0
    for offset, length in spots:
        if count and (offset - end > gap or offset + length - start > most):
            yield start, end - start, count
            count = 0
        if not count:
            start, end = offset, offset
        end = max(end, offset + length)
        count += 1
    if count:
        yield start, end - start, count


def _read(folder: str):
    def record_row(member: bytes) -> tuple:
        headers, block = parse(zlib.decompress(member, 31))
        digest = headers["warc-payload-digest"].removeprefix("sha1:")
        http, _, payload = block.partition(_END)
        size = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
        revisit = headers["warc-type"] == "revisit"
        if not revisit and (len(payload) != size or base32_sha1(payload) != digest):
            raise ValueError(f"record {headers['warc-record-id']} is damaged")
        return (_page_of(headers["warc-record-id"]), headers.get("warc-target-uri"), size, digest, headers["warc-type"],
                _page_of(headers["warc-refers-to"]) if revisit else None, None if revisit else payload)

    kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
    names = ("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _location(folder)
        current, source = None, None
        try:
            for batch in batches:
                entries = list(zip(*(batch.column(c).to_pylist() for c in ("archive", "offset", "length"))))
                at = 0
                while at < len(entries):
                    archive = entries[at][0]
                    until = at
                    while until < len(entries) and entries[until][0] == archive:
                        until += 1
                    if archive != current:
                        if source is not None:
                            source.close()
                        current, source = archive, store.open_input_file(f"{root}/{archive}")
                    spots = [(offset, length) for _, offset, length in entries[at:until]]
                    done = 0
                    for start, size, count in ranges(spots, GAP, READ):
                        data = source.read_at(size, start)
                        yield _batch([record_row(data[o - start:o - start + n]) for o, n in spots[done:done + count]], kinds, names)
                        done += count
                    at = until
        finally:
            if source is not None:
                source.close()

    return read


def read(index: DataFrame, folder: str) -> DataFrame:
    """The records of the selected index rows: ``page_id, url, payload_bytes, payload_digest, record_type,
    refers_to, payload`` (null for a revisit).

    Sizes and digests are of the full payload; a response's are taken from what was read, and a record that
    disagrees with its header raises.
    """
    ready(index.sparkSession)
    total = index.agg(F.sum("length")).first()[0] or 0
    parts = max(1, -(-total // READ_PER_TASK))
    wanted = index.select("archive", "offset", "length")
    dealt = wanted.repartitionByRange(parts, "archive", "offset") if parts > 1 else wanted.coalesce(1)
    return dealt.sortWithinPartitions("archive", "offset").mapInArrow(_read(folder), RECORDS)
