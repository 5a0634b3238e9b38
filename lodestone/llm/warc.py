"""WARC archives with an index written first.

``write_archives`` writes gzip-per-record WARC files, each with a warcinfo record first, and returns the index: file, offset,
length, URL and digest of every record of a page. ``read_records`` takes any selection of index rows, sorts them by file and offset, reads neighbouring ranges in
one request and parses the records. Archives lie in the shared folder; they are opened through pyarrow's filesystems.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh_path, stored

#: Payloads from this size on are stored once.
REVISIT_BYTES = 1000
#: Ranges with at most this many bytes between them are read in one request of at most ``READ_BYTES``.
GAP_BYTES, READ_BYTES = 64 << 10, 8 << 20
#: A task starts another file after so many bytes.
FILE_BYTES = 1 << 30


def opened(folder: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (pa.fs.LocalFileSystem(), folder)


#: A read task's share of the archives, unless that makes more than so many tasks.
SLICE_BYTES, READ_TASKS = 4 << 20, 20_000


def record(name: str, page_id: int | None, url: str | None, payload: bytes | None, sha1: str, size: int, refers: tuple[int, str | None] | None = None) -> bytes:
    """One WARC/1.1 record. A response holds an HTTP message; a revisit (``payload`` None) has no block and names the
    page and URL it ``refers`` to. ``name`` is unlike any other record's."""
    one_line = lambda text: (text or "").translate({10: None, 13: None})
    fields = {
        "WARC-Type": "revisit" if payload is None else "response",
        "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>",
        "WARC-Date": "1970-01-01T00:00:00Z",
        "WARC-Target-URI": one_line(url),
        "WARC-Payload-Digest": f"sha1:{base64.b32encode(bytes.fromhex(sha1)).decode()}",
        "X-Page-Id": "" if page_id is None else str(page_id),
        "X-Payload-Length": str(size),
        "Content-Type": "application/http; msgtype=response",
    }
    block = b""
    if payload is None:
        fields["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        fields |= {"WARC-Refers-To-Target-URI": one_line(refers[1]), "WARC-Refers-To-Date": fields["WARC-Date"], "X-Refers-To-Page": str(refers[0])}
    else:
        block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode() + payload
    return framed(fields, block)


def framed(fields: dict[str, str], block: bytes) -> bytes:
    head = "\r\n".join(["WARC/1.1", *(f"{k}: {v}" for k, v in fields.items()), f"Content-Length: {len(block)}"])
    return head.encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def info(name: str) -> bytes:
    fields = {"WARC-Type": "warcinfo", "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>", "WARC-Date": "1970-01-01T00:00:00Z", "WARC-Filename": name, "Content-Type": "application/warc-fields"}
    return framed(fields, b"software: lodestone\r\nformat: WARC File Format 1.1\r\n")


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """(fields, payload): the payload is the body of a response's HTTP message."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k: v.strip() for k, _, v in (line.partition(":") for line in lines)}
    size = int(fields["Content-Length"])
    if rest[size : size + 4] != b"\r\n\r\n":
        raise ValueError("a WARC record is cut short")
    block = rest[:size]
    return fields, block.partition(b"\r\n\r\n")[2] if fields["WARC-Type"] == "response" else block


def _gzip(data: bytes) -> bytes:
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


_INDEX = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("digest", pa.string()), ("record_type", pa.string()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])
_INDEX_DDL = "page_id long, url string, digest string, record_type string, file string, offset long, length long"


def writer(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        # Each attempt has its own files; the index has those of the attempt whose rows were kept.
        stem, number = f"part-{task.partitionId():06d}-{uuid.uuid4().hex[:12]}", 0
        fs, root = opened(folder)
        out, name, at = None, "", 0
        try:
            for batch in batches:
                rows = []
                for low in range(0, batch.num_rows, 256):
                    part = batch.slice(low, 256)
                    names = ("page_id", "url", "html", "sha1", "size", "refers_to", "refers_url")
                    for i, u, text, digest, n, r, r_url in zip(*(part.column(c).to_pylist() for c in names), strict=True):
                        if out is None or at >= FILE_BYTES:
                            if out:
                                out.close()
                            name = f"{stem}-{number}.warc.gz"
                            out, number = fs.open_output_stream(f"{root}/{name}", compression=None), number + 1
                            packed = _gzip(info(name))
                            out.write(packed)
                            at = len(packed)
                        packed = _gzip(record(f"{name} {at}", i, u, text.encode() if text is not None else None, digest, n, (r, r_url)))
                        out.write(packed)
                        rows.append((i, u, digest, "revisit" if text is None else "response", name, at, len(packed)))
                        at += len(packed)
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _INDEX.types, strict=True)], schema=_INDEX)
        finally:
            if out:
                out.close()

    return run


def write_archives(pages: DataFrame, folder: str | None = None, least: int = REVISIT_BYTES) -> tuple[DataFrame, str]:
    """(index, folder) of archives with one record per row of ``pages``.

    Of equal payloads of ``least`` bytes or more the row with the largest page_id is a response and the others revisit
    it; smaller ones are responses. A null html is an empty payload, a null url an empty one; a row with a null
    page_id is always a response. Rows may share a page_id and not the html: each goes by its own. Repeated rows are
    written each; those of the largest page_id are all responses. An empty table gives an empty index; other columns are
    not read.
    """
    folder = folder or fresh_path(pages.sparkSession, "warc")
    fs, root = opened(folder)
    fs.create_dir(root, recursive=True)
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html")).withColumn("size", F.octet_length("html").cast("long"))
    rows = rows.withColumn("same", F.when(F.col("page_id").isNotNull() & (F.col("size") >= least), F.unhex(F.sha2("html", 256))))
    strong = rows.where("same IS NOT NULL").select("page_id", "url", "same")
    # The group's largest id; only groups with several ids have revisits, so what is joined back is small.
    top = strong.groupBy("same").agg(F.max(F.struct("page_id", "url")).alias("top"), F.min("page_id").alias("low")).where("top.page_id > low").drop("low")
    repeats = strong.drop("url").join(top, "same").where("page_id < top.page_id").select("page_id", "same", F.col("top.page_id").alias("refers_to"), F.col("top.url").alias("refers_url")).distinct()
    typed = rows.join(repeats, ["page_id", "same"], "left").select(
        "page_id", "url", F.sha1("html").alias("sha1"), "size", "refers_to", "refers_url", F.when(F.col("refers_to").isNull(), F.col("html")).alias("html")
    )
    return stored(typed.mapInArrow(writer(folder), _INDEX_DDL), "warc-index"), folder


_RECORD_DDL = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long"


def ranges(places: list[tuple[int, int]], gap: int = GAP_BYTES, most: int = READ_BYTES) -> list[tuple[int, int]]:
    """Sorted (offset, length) places merged into reads."""
    out: list[tuple[int, int]] = []
    for offset, length in places:
        if out and offset - (out[-1][0] + out[-1][1]) <= gap and offset + length - out[-1][0] <= most:
            out[-1] = (out[-1][0], max(out[-1][1], offset + length - out[-1][0]))
        else:
            out.append((offset, length))
    return out


def reader(folder: str, with_payload: bool):
    names = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to"] + ["payload"] * with_payload
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()][: len(names)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = opened(folder)
        name, source = None, None
        for batch in batches:
            places = list(zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length")), strict=True))
            at = 0
            while at < len(places):
                end = at
                while end < len(places) and places[end][0] == places[at][0]:
                    end += 1
                if places[at][0] != name:
                    if source:
                        source.close()
                    name = places[at][0]
                    source = fs.open_input_file(f"{root}/{name}")
                own = [p[1:] for p in places[at:end]]
                k, rows = 0, []
                for start, size in ranges(own):
                    block = source.read_at(size, start)
                    while k < len(own) and own[k][0] + own[k][1] <= start + size and own[k][0] >= start:
                        offset, length = own[k]
                        fields, payload = parse(zlib.decompress(block[offset - start : offset - start + length], 31))
                        declared = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                        page = int(fields["X-Page-Id"]) if fields["X-Page-Id"] else None
                        if fields["WARC-Type"] == "response":
                            found = hashlib.sha1(payload).hexdigest()
                            if found != declared:
                                raise ValueError(f"{name} at {offset}: the payload's digest is {found}, not {declared}")
                            row = (page, fields["WARC-Target-URI"], "response", len(payload), found, None, payload)
                        else:
                            row = (page, fields["WARC-Target-URI"], "revisit", int(fields["X-Payload-Length"]), declared, int(fields["X-Refers-To-Page"]), None)
                        rows.append(row[: len(names)])
                        k += 1
                for low in range(0, len(rows), 2000):
                    some = rows[low : low + 2000]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some, strict=True), types, strict=True)], names=names)
                at = end
        if source:
            source.close()

    return run


def read_records(index: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """The records of the index rows given, read by coalesced byte ranges in file order.

    Responses are checked against their digest. A revisit's size, digest and referred page are those of its record;
    its payload is null (join ``refers_to`` to the response). Tasks take neighbouring ranges of about ``SLICE_BYTES`` of
    archive each; their number is given, since Spark would join them by the index's bytes, which are few. Rows given twice
    are read twice; an empty index gives no records.
    """
    places = index.select("file", "offset", "length")
    total = places.agg(F.sum("length")).first()[0] or 0
    tasks = min(READ_TASKS, max(1, -(-total // SLICE_BYTES)))
    ordered = places.repartitionByRange(tasks, "file", "offset").sortWithinPartitions("file", "offset")
    return ordered.mapInArrow(reader(folder, with_payload), _RECORD_DDL + (", payload binary" if with_payload else ""))
