"""WARC archives (operator 12): records as gzip members, a two-level capture index, range reads.

``write`` puts every page into an archive: a gzip member a record, several files a task,
each under a name of its own, so a repeated task leaves no half-written file among those that
the index names.  Of pages with equal payloads one is a response and the others refer to it.

The index is sorted by the reversed host and path of the URL, then by page.  A task writes the
captures of a range into a shard: compressed blocks of ``BLOCK`` lines, then a sparse directory
with the first key of each block.  ``find`` looks pages up: binary search over the shards (a
row a shard is all that is broadcast), over a shard's directory, and in a block, which is
read by its range.  ``read`` reads the records' ranges, those that adjoin at once, and checks
each payload against its digest.

Files are opened by URI (``pyarrow.fs``), in the folder that driver and executors share.

Defined results: a null html is an empty payload, and texts of any length are one record; of
equal payloads of at least ``least`` bytes the page with the largest id is the response, then
that with the greatest URL, and of rows equal in both one; a null id is smaller than any, and a
revisit of a page without an id refers to null; a null URL is empty, and control
characters and spaces in URLs are percent-encoded; repeated rows are a record each; an empty
table gives an archive without records.  Only the columns named are read; others may have any name.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm import scratch, words

#: Lines of a block of the index, bytes of a file of records, bytes read at once.
BLOCK, FILE, SPAN = 3000, 1 << 28, 1 << 22
#: The time of capture; the tables have none.
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NONE = -(1 << 63)
_CONTROL = re.compile(r"[\x00-\x20\x7f]")
_TRAILER = struct.Struct(">QQ")
_CAPTURE = "key string, page_id long, file string, offset long, length long"


@dataclass(frozen=True)
class Archive:
    """A folder of records and index shards; ``shards`` has the first key, the file and its size of each shard, in order."""

    folder: str
    shards: tuple[tuple[bytes, int, str, int], ...]


def _at(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def clean(url: str | None) -> str:
    return _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url or "")


def url_key(url: str | None) -> str:
    """The host's labels from the last to the first, then path and query: ``org,example,www)/a?b``."""
    rest = clean(url).partition("://")[2] or clean(url)
    host, path = re.match(r"([^/?#]*)([^#]*)", rest).groups()
    host = host.rpartition("@")[2].partition(":")[0].lower().rstrip(".")
    return f"{','.join(reversed(host.split('.')))}){path or '/'}"


def _base32(sha1: str) -> str:
    return base64.b32encode(bytes.fromhex(sha1)).decode()


def digest(payload: bytes) -> str:
    """The bare base32 of the SHA-1."""
    return _base32(hashlib.sha1(payload).hexdigest())


def _name(page_id: int | None) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def member(page_id: int | None, url: str | None, sha1: str, size: int, payload: bytes = b"", refers_to: tuple | None = None) -> bytes:
    """A record as a gzip member: a response with its payload, or a revisit of the page (id, URL) in ``refers_to``."""
    head = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", _name(page_id)), ("WARC-Date", DATE), ("WARC-Target-URI", clean(url)), ("WARC-Payload-Digest", f"sha1:{sha1}")]
    if refers_to is not None:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _name(refers_to[0])), ("WARC-Refers-To-Target-URI", clean(refers_to[1]))]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(http) + len(payload)))]
    return _packed("WARC/1.1\r\n".encode() + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + http + payload + b"\r\n\r\n")


def _info() -> bytes:
    """The record that a file begins with."""
    info = b"format: WARC File Format 1.1\r\n"
    head = f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid4()}>\r\nWARC-Date: {DATE}\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(info)}\r\n\r\n"
    return _packed(head.encode() + info + b"\r\n\r\n")


def _packed(data: bytes) -> bytes:
    made = zlib.compressobj(6, zlib.DEFLATED, 31)
    return made.compress(data) + made.flush()


def _unpacked(data: bytes) -> bytes:
    return zlib.decompressobj(31).decompress(data)


def parse(data: bytes) -> dict:
    """The record in a gzip member; its lengths and, of a response, its digest are checked."""
    head, _, rest = _unpacked(data).partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines)}
    size = int(fields["content-length"])
    if not version.startswith("WARC/") or rest[size:] != b"\r\n\r\n":
        raise ValueError("not a whole record")
    http, _, payload = rest[:size].partition(b"\r\n\r\n")
    sha1, kind = fields["warc-payload-digest"].removeprefix("sha1:"), fields["warc-type"]
    if kind == "response" and digest(payload) != sha1:
        raise ValueError(f"payload of {fields['warc-record-id']} doesn't have its digest")
    page = lambda name: int(v) if (v := fields.get(name, "").strip("<>").rpartition(":")[2]) else None
    length = int(re.search(rb"(?i)content-length: *(\d+)", http)[1])
    return {"page_id": page("warc-record-id"), "url": fields["warc-target-uri"], "payload_bytes": length, "payload_digest": sha1, "record_type": kind, "refers_to": page("warc-refers-to") if kind == "revisit" else None, "payload": payload}


# --- writing -----------------------------------------------------------------------------


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Responses, made before it is known which of them are revisits: less is shuffled."""
    for batch in words.sliced(batches, 2):
        page, url, html = (c.to_pylist() for c in batch.columns)
        payloads = [(x or "").encode() for x in html]
        sha1 = [hashlib.sha1(x).hexdigest() for x in payloads]
        made = [member(p, u, _base32(d), len(x), x) for p, u, d, x in zip(page, url, sha1, payloads, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sha1, pa.string()), pa.array(map(len, payloads), pa.int64()), pa.array(made, pa.binary())], names=["page_id", "url", "sha1", "size", "member"])


def _judged(pages: DataFrame, least: int) -> DataFrame:
    """Members of all pages; where several share a payload, with ``first``, the page that is its response, and ``copy``, which is 0 in that page's row."""
    keys = pages.where(F.coalesce(F.octet_length("html"), F.lit(0)) >= least).select("page_id", "url", F.sha1(F.coalesce("html", F.lit("")).cast("binary")).alias("sha1"))
    equal = keys.groupBy("sha1", "page_id", "url").agg(F.count(F.lit(1)).alias("rows"))
    shared = equal.groupBy("sha1").agg(F.max(F.struct("page_id", "url", "rows")).alias("first"), F.sum("rows").alias("n")).where("n > 1")
    shared = scratch.save(shared.select("sha1", "first"))
    made = pages.mapInArrow(_members, "page_id long, url string, sha1 string, size long, member binary")
    own = F.col("page_id").eqNullSafe(F.col("first.page_id")) & F.col("url").eqNullSafe(F.col("first.url"))
    rows = made.join(shared, "sha1", "left").withColumn("copy", F.when(F.col("first").isNull() | own, 0).otherwise(1))
    if shared.where("first.rows > 1").isEmpty():
        return rows
    # of rows equal in all columns one stays and is repeated, with numbers
    several = F.coalesce((F.col("copy") == 0) & (F.col("first.rows") > 1), F.lit(False))
    repeated = rows.where(several).dropDuplicates(["sha1"]).withColumn("copy", F.explode(F.expr("sequence(0, cast(first.rows as int) - 1)")))
    return rows.where(~several).unionByName(repeated)


def _write(batches: Iterator[pa.RecordBatch], folder: str, file_bytes: int) -> Iterator[pa.RecordBatch]:
    """Writes records; a row of the index for each."""
    store, root = _at(folder)
    store.create_dir(root, recursive=True)
    out, name, at = None, "", 0
    try:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                if out is None or at >= file_bytes:
                    if out is not None:
                        out.close()
                    name = f"records-{uuid.uuid4().hex}.warc.gz"
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                    at = out.write(_info())
                data = r["member"] if r["copy"] == 0 else member(r["page_id"], r["url"], _base32(r["sha1"]), r["size"], refers_to=(r["first"]["page_id"], r["first"]["url"]))
                out.write(data)
                rows.append((url_key(r["url"]), r["page_id"], name, at, len(data)))
                at += len(data)
            yield _rows(rows)
    finally:
        if out is not None:
            out.close()


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=["key", "page_id", "file", "offset", "length"])


def _order(page_id: int | None) -> int:
    return _NONE if page_id is None else page_id


def _line(row: dict) -> str:
    return f"{row['key']} {'-' if row['page_id'] is None else row['page_id']} {row['file']} {row['offset']} {row['length']}\n"


def _fields(line: str) -> tuple:
    key, page, file, offset, length = line.split(" ")
    return key, None if page == "-" else int(page), file, int(offset), int(length)


def _write_shard(batches: Iterator[pa.RecordBatch], folder: str, block: int) -> Iterator[pa.RecordBatch]:
    """Blocks of sorted lines, then the directory and where it stands; a row for the shard."""
    store, root = _at(folder)
    name, directory, at, out = f"index-{uuid.uuid4().hex}.cdx.gz", [], 0, None
    held: list[dict] = []

    def put() -> None:
        nonlocal at
        data = _packed("".join(map(_line, held)).encode())
        directory.append(f"{held[0]['key']} {_order(held[0]['page_id'])} {at} {len(data)}\n")
        out.write(data)
        at += len(data)
        held.clear()

    try:
        for batch in batches:
            out = out or store.open_output_stream(f"{root}/{name}", compression=None)
            for row in batch.to_pylist():
                held.append(row)
                if len(held) == block:
                    put()
        if out is None:
            return
        if held:
            put()
        data = _packed("".join(directory).encode())
        out.write(data + _TRAILER.pack(at, len(data)))
    finally:
        if out is not None:
            out.close()
    if directory:
        key, page, *_ = directory[0].split(" ")
        yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([int(page)], pa.int64()), pa.array([name]), pa.array([at + len(data) + _TRAILER.size], pa.int64())], names=["key", "page", "file", "size"])


def write(pages: DataFrame, least: int = 0, block: int = BLOCK, file_bytes: int = FILE) -> Archive:
    """Writes pages (page_id, url, html) into a new archive with its index."""
    folder = scratch.new_path(pages.sparkSession)
    pages = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    captures = scratch.save(_judged(pages, least).select("page_id", "url", "sha1", "size", "member", "first", "copy").mapInArrow(lambda it: _write(it, folder, file_bytes), _CAPTURE))
    ordered = captures.repartitionByRange("key", "page_id").sortWithinPartitions("key", "page_id")
    shards = scratch.save(ordered.mapInArrow(lambda it: _write_shard(it, folder, block), "key string, page long, file string, size long"))
    rows = [(r["key"].encode(), r["page"], r["file"], r["size"]) for r in shards.collect()]  # at most a row a partition
    return Archive(folder, tuple(sorted(rows)))


# --- reading -----------------------------------------------------------------------------


class _Shard:
    """A shard's directory, and the block read last."""

    def __init__(self, store: fs.FileSystem, root: str, name: str, size: int) -> None:
        self.file = store.open_input_file(f"{root}/{name}")
        at, n = _TRAILER.unpack(self.file.read_at(_TRAILER.size, size - _TRAILER.size))
        lines = [line.rsplit(" ", 3) for line in _unpacked(self.file.read_at(n, at)).decode().splitlines()]
        self.firsts = [(key.encode(), int(page)) for key, page, _, _ in lines]
        self.ranges = [(int(offset), int(length)) for *_, offset, length in lines]
        self.number = -1

    def captures(self, key: tuple[bytes, int]) -> Iterator[tuple]:
        """All captures of a key and page, which may stand in several blocks."""
        for number in range(max(0, bisect_left(self.firsts, key) - 1), bisect_right(self.firsts, key)):
            if number != self.number:
                offset, length = self.ranges[number]
                self.rows = [_fields(line) for line in _unpacked(self.file.read_at(length, offset)).decode().splitlines()]
                self.keys, self.number = [(r[0].encode(), _order(r[1])) for r in self.rows], number
            yield from self.rows[bisect_left(self.keys, key) : bisect_right(self.keys, key)]


def _find(batches: Iterator[pa.RecordBatch], archive: Archive) -> Iterator[pa.RecordBatch]:
    store, root = _at(archive.folder)
    firsts = [(key, page) for key, page, _, _ in archive.shards]
    number, shard, last = -1, None, None
    for batch in batches:
        found = []
        for text, page_id in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            key = (text.encode(), _order(page_id))
            at = bisect_right(firsts, key) - 1
            if key == last or at < 0:
                continue
            if at != number:
                number, shard = at, _Shard(store, root, *archive.shards[at][2:])
            found += shard.captures(key)
            last = key
        yield _rows(found)


def find(archive: Archive, pages: DataFrame) -> DataFrame:
    """Where the captures of pages (url, page_id) stand: key, page_id, file, offset, length; each capture once."""
    asked = pages.select(F.col("url").cast("string"), F.col("page_id").cast("long")).mapInArrow(_keys, "key string, page_id long")
    # as many tasks as shuffles have, as a row stands for a block and more
    ordered = asked.repartitionByRange(scratch.partitions(pages.sparkSession), "key", "page_id").sortWithinPartitions("key", "page_id")
    return ordered.mapInArrow(lambda it: _find(it, archive), _CAPTURE)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([url_key(u) for u in batch.column(0).to_pylist()], pa.string()), batch.column(1)], names=["key", "page_id"])


def _read(batches: Iterator[pa.RecordBatch], folder: str, text: bool) -> Iterator[pa.RecordBatch]:
    """Reads records by their ranges, which come by file and offset; those that adjoin are read at once."""
    store, root = _at(folder)
    name, file = None, None
    for batch in batches:
        places = list(zip(*(c.to_pylist() for c in batch.columns), strict=True))
        cuts, size = [0], 0
        for k, (a, b) in enumerate(pairwise(places)):
            size += a[2]
            if b[0] != a[0] or b[1] != a[1] + a[2] or size >= SPAN:
                cuts.append(k + 1)
                size = 0
        for lo, hi in pairwise([*cuts, len(places)]):
            if places[lo][0] != name:
                name = places[lo][0]
                file = store.open_input_file(f"{root}/{name}")
            begin, end = places[lo][1], places[hi - 1][1] + places[hi - 1][2]
            data = file.read_at(end - begin, begin)
            records = [parse(data[offset - begin : offset - begin + length]) for _, offset, length in places[lo:hi]]
            kinds = {"page_id": pa.int64(), "url": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64()} | ({"payload": pa.binary()} if text else {})
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in records], kind) for k, kind in kinds.items()], names=list(kinds))


def read(archive: Archive, places: DataFrame, payload: bool = False) -> DataFrame:
    """The records that stand at ``places``."""
    ordered = places.select("file", "offset", "length").repartitionByRange(scratch.partitions(places.sparkSession), "file", "offset").sortWithinPartitions("file", "offset")
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long" + (", payload binary" if payload else "")
    return ordered.mapInArrow(lambda it: _read(it, archive.folder, payload), schema)
