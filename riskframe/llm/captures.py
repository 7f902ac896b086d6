"""WARC archives with a two-level capture index.

Archives: one gzip member per record, so that a record is read with one range read. Of pages with the same
payload (at least ``least_bytes`` long) the one with the smallest id is written as ``response``, the others as
``revisit`` records without payload that name it.

Index: captures sorted by reversed-host URL key, in compressed blocks of ``BLOCK`` lines. An index file is its
blocks, its sparse directory (first key, place and size of each block) and a footer that says where the
directory is. The upper level is one first key per index file. A lookup binary-searches the first keys of the
files, then the file's directory, range-reads the block, and range-reads the records.

Defined results: a null page is an empty payload, a null URL has an empty key; a page without an id is always
a response and nothing refers to it; rows that repeat an id with the same payload are all responses if the id is
the smallest, else all revisits; an empty table writes nothing and reads back as no rows.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import struct
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm.common import new_folder, rows_of, saved, small_join
from riskframe.llm.token_frames import place

BLOCK, FILE_CAPTURES, LEAST_BYTES = 256, 100_000, 0
DATE = "2000-01-01T00:00:00Z"
# fixed value: the profile name of the WARC standard
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
_FOOTER = "<QQ8s"
_MAGIC = b"CDXBLOCK"


def url_key(url: str | None) -> str:
    """Sort key of a URL: host labels reversed and comma-joined, then path and query; fragment and scheme are left out."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host = (parts.hostname or "").lower()
        port = f":{parts.port}" if parts.port not in (None, 80, 443) else ""
    except ValueError:  # not a URL: sorted as it is written
        return re.sub(r"[\x00-\x20]", lambda m: quote(m[0]), url.strip())
    tail = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    return re.sub(r"[\x00-\x20]", lambda m: quote(m[0]), ",".join(reversed(host.split("."))) + port + ")" + tail)


def _urn(page: int | None, digest: str, url: str | None) -> str:
    name = f"page:{page}" if page is not None else f"{digest} {url}"
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"


def record(page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One gzip member with the WARC record of a page."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    body = http if refers_to is not None else http + payload
    lines = ["WARC/1.0", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_urn(page, digest, url)}", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20]", lambda m: quote(m[0]), url))
    lines.append(f"WARC-Payload-Digest: sha1:{digest}")
    if page is not None:
        lines.append(f"Page-ID: {page}")
    if refers_to is not None:
        lines += [f"WARC-Refers-To: {_urn(refers_to, digest, url)}", f"WARC-Profile: {PROFILE}", f"Refers-To-Page-ID: {refers_to}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    head = "\r\n".join(lines).encode("utf-8", "surrogatepass")
    return packer.compress(head + b"\r\n\r\n" + body + b"\r\n\r\n") + packer.flush()


def parse(member: bytes) -> tuple[dict[str, str], int, bytes]:
    """Header, payload length and payload (empty for a revisit) of a record; digests are verified."""
    head, _, rest = zlib.decompress(member, 31).partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])
    body = rest[: int(fields["Content-Length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    length = int(re.search(rb"Content-Length: (\d+)", http)[1])
    if fields["WARC-Type"] == "response" and (len(payload) != length or digest_of(payload) != fields["WARC-Payload-Digest"][5:]):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    return fields, length, payload


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _task_file(system, path: str, kind: str) -> tuple[str, str]:
    from pyspark import TaskContext

    system.create_dir(path, recursive=True)
    name = f"part-{TaskContext.get().partitionId():06d}.{kind}"
    return name, f"{path}/.{name}.{uuid.uuid4().hex}"


_CAPTURE = "key string, page_id bigint, file string, offset bigint, length bigint"


def write_archives(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Write one archive per task into ``folder``; gives the saved captures (key, page_id, file, offset, length)."""
    payload = F.coalesce(F.col(html).cast("string"), F.lit(""))
    rows = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), payload.alias("html"))
    rows = rows.withColumn("sha", F.when(F.octet_length("html") >= least_bytes, F.sha1("html")))
    same = rows.filter(F.col("sha").isNotNull()).groupBy("sha").agg(F.min("page_id").alias("first"), F.count("page_id").alias("n"))
    same = saved(same.filter(F.col("n") > 1).select("sha", "first"), "same")
    marked = small_join(rows, same, "sha", "left").select("page_id", "url", "html", F.when(F.col("first") < F.col("page_id"), F.col("first")).alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = place(folder)
        name, draft = _task_file(system, path, "warc.gz")
        at, out = 0, []
        with system.open_output_stream(draft) as stream:
            for batch in batches:
                for page, link, text, refers in rows_of(batch, "page_id", "url", "html", "refers_to"):
                    body = text.encode("utf-8", "surrogatepass")
                    member = record(page, link, body, digest_of(body), refers)
                    stream.write(member)
                    out.append((url_key(link), page, name, at, len(member)))
                    at += len(member)
        if out:
            system.move(draft, f"{path}/{name}")
            yield _captures(out)
        else:
            system.delete_file(draft)

    return saved(marked.mapInArrow(run, _CAPTURE), "captures")


def _captures(rows: list) -> pa.RecordBatch:
    types = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    names = ["key", "page_id", "file", "offset", "length"]
    columns = list(zip(*rows, strict=True)) if rows else [()] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def write_index(captures: DataFrame, folder: str, block: int = BLOCK, file_captures: int = FILE_CAPTURES) -> DataFrame:
    """Sort the captures by key into index files; gives the saved upper level (first, index), one row per file."""
    files = max(1, -(-captures.count() // file_captures))
    order = ["key", "page_id", "file", "offset"]  # the later columns split a key with very many captures

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = place(folder)
        name, draft = _task_file(system, path, "index")
        directory, lines, first, at = [], [], None, 0
        with system.open_output_stream(draft) as stream:

            def flush() -> None:
                nonlocal at, lines
                if lines:
                    packed = zlib.compress("\n".join(json.dumps(line) for line in lines).encode())
                    stream.write(packed)
                    directory.append((lines[0][0], at, len(packed)))
                    at, lines = at + len(packed), []

            for batch in batches:
                for row in rows_of(batch, "key", "page_id", "file", "offset", "length"):
                    first = row[0] if first is None else first
                    lines.append(row)
                    if len(lines) >= block:
                        flush()
            flush()
            packed = zlib.compress(json.dumps(directory).encode())
            stream.write(packed + struct.pack(_FOOTER, at, len(packed), _MAGIC))
        if first is None:
            system.delete_file(draft)
            return
        system.move(draft, f"{path}/{name}")
        yield pa.RecordBatch.from_arrays([pa.array([first]), pa.array([name])], names=["first", "index"])

    ordered = captures.repartitionByRange(files, *order).sortWithinPartitions(*order)
    return saved(ordered.mapInArrow(run, "first string, index string"), "upper")


class IndexFile:
    """Binary search in one index file: reads the directory once, and blocks on demand."""

    def __init__(self, stream):
        self.stream = stream
        stream.seek(stream.size() - struct.calcsize(_FOOTER))
        at, length, magic = struct.unpack(_FOOTER, stream.read(struct.calcsize(_FOOTER)))
        if magic != _MAGIC:
            raise ValueError("not an index file")
        stream.seek(at)
        self.directory = json.loads(zlib.decompress(stream.read(length)))
        self.firsts = [entry[0] for entry in self.directory]

    def block(self, number: int) -> list[list]:
        _, at, length = self.directory[number]
        self.stream.seek(at)
        return [json.loads(line) for line in zlib.decompress(self.stream.read(length)).decode().split("\n")]

    def find(self, key: str) -> list[list]:
        """The captures of a key; it may begin in the block before the first one that starts with it."""
        low, high = max(0, bisect_left(self.firsts, key) - 1), bisect_right(self.firsts, key)
        return [line for number in range(low, high) for line in self.block(number) if line[0] == key]


def scan_index(upper: DataFrame, folder: str) -> DataFrame:
    """All captures, read from the blocks of the index files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = place(folder)
        for batch in batches:
            for (name,) in rows_of(batch, "index"):
                with system.open_input_file(f"{path}/{name}") as stream:
                    index = IndexFile(stream)
                    for number in range(len(index.directory)):
                        yield _captures(index.block(number))

    return upper.select("index").repartition(max(1, upper.count()), "index").mapInArrow(run, _CAPTURE)


def lookup(upper: DataFrame, folder: str, urls: DataFrame, url: str = "url") -> DataFrame:
    """The captures of the given URLs, found by binary search in the upper level, the directory and the block."""
    listed = sorted(upper.collect(), key=lambda r: (r["first"], r["index"]))  # one row per FILE_CAPTURES captures
    sent = upper.sparkSession.sparkContext.broadcast(([r["first"] for r in listed], [r["index"] for r in listed]))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts, names = sent.value
        for batch in batches:
            keys = [url_key(u) for (u,) in rows_of(batch, "url")]
            rows = [(n, k) for k in keys for n in names[max(0, bisect_left(firsts, k) - 1) : bisect_right(firsts, k)]]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in (0, 1)], names=["index", "key"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = place(folder)
        for batch in batches:
            for name, keys in rows_of(batch, "index", "keys"):
                with system.open_input_file(f"{path}/{name}") as stream:
                    index = IndexFile(stream)
                    for key in keys:
                        yield _captures(index.find(key))

    asked = urls.select(F.col(url).cast("string").alias("url")).distinct().mapInArrow(route, "index string, key string")
    return asked.groupBy("index").agg(F.collect_set("key").alias("keys")).mapInArrow(run, _CAPTURE)  # the keys asked of one file


_READ = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, url string, payload binary"


def read_records(captures: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The records of the captures by range reads, archive by archive in order of place."""
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                        ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()), ("payload", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = place(folder)
        name, stream = None, None
        for batch in batches:
            out = []
            for file, at, length in rows_of(batch, "file", "offset", "length"):
                if file != name:
                    if stream:
                        stream.close()
                    name, stream = file, system.open_input_file(f"{path}/{file}")
                stream.seek(at)
                fields, size, payload = parse(stream.read(length))
                number = lambda field, fields=fields: int(fields[field]) if field in fields else None
                out.append((number("Page-ID"), size, fields["WARC-Payload-Digest"][5:], fields["WARC-Type"], number("Refers-To-Page-ID"),
                            fields.get("WARC-Target-URI"), payload if payloads and fields["WARC-Type"] == "response" else None))
            columns = list(zip(*out, strict=True)) if out else [()] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
        if stream:
            stream.close()

    placed = captures.select("file", "offset", "length").repartition("file").sortWithinPartitions("file", "offset")
    return placed.mapInArrow(run, _READ)


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Archive all pages, index them, and read every record back through the index."""
    archives, index = new_folder(spark, "warc"), new_folder(spark, "index")
    upper = write_index(write_archives(pages, archives), index)
    return read_records(scan_index(upper, index), archives, payloads=False)
