"""WARC archives of pages, and a two-level index of their captures.

Pages are sorted by their key (the URL with its host reversed) and id. Each task writes one
archive, every record a gzip member of its own, and beside it an index: lines in the same
order, in compressed blocks, then a sparse directory with the first key of each block. A root
file lists the first key of each index. A lookup binary-searches the root, then the
directory, then one block, and reads just the record's range of bytes. Root and directories
are searched in place and not loaded.

Of pages with equal payloads of at least ``shared_bytes`` bytes, the one with the largest id
is written whole; the others become revisit records that name it. Reading resolves them
through the index. Equal payloads are recognised by SHA-1.

A task writes under names of its own and reports them in its result, so attempts that are
lost or repeated leave files that nobody reads.

Defined cases: a NULL html is an empty payload, a NULL URL an empty one; control characters
are dropped from URLs and spaces escaped; a NULL id counts as smaller than any other; rows
with the id of the response and its payload are responses too; an empty table gives
no archive and an empty result; other columns aren't archived.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import struct
import uuid
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallylake.llm.shared_files import create, open_file
from tallylake.workspace import scratch_path, stage

#: A block of the index ends at so many lines, or so many bytes of its records.
BLOCK_LINES = 256
BLOCK_BYTES = 1 << 22
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_TAIL = struct.Struct("<QQ")  # number of entries, place of their offsets


# Keys


def clean_uri(url: Column) -> Column:
    return F.regexp_replace(F.replace(F.coalesce(url, F.lit("")), F.lit(" "), F.lit("%20")), r"[\x00-\x1F\x7F]", "")


def key_of(uri: Column) -> Column:
    """``http://b.example.org/x`` as ``org,example,b)/x``; without port, user, scheme and capitals in the host."""
    start = r"^[A-Za-z][A-Za-z0-9+.\-]*://"
    host = F.lower(F.regexp_extract(uri, start + r"(?:[^/?#@]*@)?([^/?#:]*)", 1))
    rest = F.regexp_replace(uri, start + r"[^/?#]*", "")
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest)


# Records


def _record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def _page(page_id: int | None) -> str:
    return "" if page_id is None else str(page_id)


def make_record(page_id, uri: str, payload: bytes, digest: str, refers_to=None, refers_uri: str | None = None, date: str = "1970-01-01T00:00:00Z") -> bytes:
    """One record as a gzip member; with ``refers_uri`` a revisit, which leaves out the payload."""
    kind = "response" if refers_uri is None else "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if kind == "response" else http
    head = {
        "WARC-Type": kind,
        "WARC-Record-ID": _record_id(page_id),
        "WARC-Date": date,
        "WARC-Target-URI": uri,
        "WARC-Payload-Digest": "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode(),
        "X-Page-ID": _page(page_id),
    }
    if kind == "revisit":
        head |= {"WARC-Profile": PROFILE, "WARC-Refers-To": _record_id(refers_to), "WARC-Refers-To-Target-URI": refers_uri, "X-Refers-To-Page-ID": _page(refers_to)}
    head |= {"Content-Type": "application/http; msgtype=response", "Content-Length": str(len(block))}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return gzip.compress(f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n", 1, mtime=0)


@dataclass(frozen=True)
class Record:
    headers: dict[str, str]
    payload: bytes

    @property
    def page_id(self) -> int | None:
        return int(self.headers["X-Page-ID"]) if self.headers["X-Page-ID"] else None

    @property
    def refers_to(self) -> int | None:
        page = self.headers.get("X-Refers-To-Page-ID")
        return int(page) if page else None


def parse_record(member: bytes) -> Record:
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if version != "WARC/1.1":
        raise ValueError("no WARC record")
    headers = dict(x.split(": ", 1) for x in lines)
    size = int(headers["Content-Length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError("a WARC record of another length")
    return Record(headers, rest[:size].partition(b"\r\n\r\n")[2])


# Sorted entries that are searched in their file


def write_entries(out, entries: list[list]) -> None:
    """Entries as JSON, their offsets, and a tail; the file may hold other things before."""
    offsets = []
    for e in entries:
        offsets.append(out.tell())
        out.write(json.dumps(e).encode())
    start = out.tell()
    out.write(struct.pack(f"<{len(offsets)}Q", *offsets) + _TAIL.pack(len(offsets), start))


class Entries:
    """Entries of a file; each starts with its place in the order."""

    def __init__(self, path: str):
        self.file = open_file(path)
        self.n, self.start = _TAIL.unpack(self.file.read_at(_TAIL.size, self.file.size() - _TAIL.size))
        self.entry = lru_cache(1024)(self._entry)

    def _entry(self, i: int) -> list:
        own = self.file.read_at(16, self.start + 8 * i)
        a = struct.unpack_from("<Q", own)[0]
        b = struct.unpack_from("<Q", own, 8)[0] if i + 1 < self.n else self.start
        return json.loads(self.file.read_at(b - a, a))

    def first_at(self, place: list) -> int:
        """The last entry that begins before ``place``; an equal line can't stand earlier."""
        return max(0, bisect_left(range(self.n), place, key=lambda i: self.entry(i)[0]) - 1)


def place_of(key: str, page_id: int | None) -> list:
    return [key, page_id is not None, page_id or 0]


class Index:
    """Lookups of captures. ``lines`` are [place, type, digest, offset, length]."""

    def __init__(self, root: str):
        self.root = Entries(root)
        self.shard = lru_cache(16)(lambda path: Entries(path))
        self.lines = lru_cache(16)(self._lines)
        self.archive = lru_cache(16)(open_file)

    def _lines(self, path: str, offset: int, length: int) -> list[list]:
        return [json.loads(x) for x in zlib.decompress(self.shard(path).file.read_at(length, offset)).splitlines()]

    def blocks(self, path: str) -> Iterator[list[list]]:
        own = self.shard(path)
        for b in range(own.n):
            yield self.lines(path, *own.entry(b)[1:])

    def find(self, key: str, page_id: int | None) -> Iterator[tuple[str, list]]:
        """Archive and line of every capture with this key and id."""
        place = place_of(key, page_id)
        for s in range(self.root.first_at(place), self.root.n):
            first, path, archive = self.root.entry(s)
            if first > place:
                return
            own = self.shard(path)
            for b in range(own.first_at(place), own.n):
                if own.entry(b)[0] > place:
                    return
                lines = self.lines(path, *own.entry(b)[1:])
                for line in lines[bisect_left(lines, place, key=lambda x: x[0]) :]:
                    if line[0] != place:
                        return
                    yield archive, line

    def read(self, archive: str, line: list) -> Record:
        return parse_record(self.archive(archive).read_at(line[4], line[3]))


# Writing


@dataclass(frozen=True)
class Archive:
    """``files`` has a row per archive (shard, archive, index, first); ``root`` is the path of the top of the index."""

    files: DataFrame
    root: str | None


class _Writer:
    def __init__(self, folder: str):
        name = f"pages-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        self.paths = [f"{folder}/{name}.warc.gz", f"{folder}/{name}.index"]
        self.archive, self.index = (create(folder, p.rpartition("/")[2]) for p in self.paths)
        self.directory, self.block, self.held = [], [], 0

    def add(self, key, page_id, uri, payload, digest, refers_to, refers_uri, date):
        member = make_record(page_id, uri, payload, digest, refers_to, refers_uri, date)
        kind = "response" if refers_uri is None else "revisit"
        self.block.append([place_of(key, page_id), kind, digest, self.archive.tell(), len(member)])
        self.archive.write(member)
        self.held += len(member)
        if len(self.block) >= BLOCK_LINES or self.held >= BLOCK_BYTES:
            self.flush()

    def flush(self):
        if self.block:
            packed = zlib.compress("\n".join(map(json.dumps, self.block)).encode(), 6)
            self.directory.append([self.block[0][0], self.index.tell(), len(packed)])
            self.index.write(packed)
        self.block, self.held = [], 0

    def close(self) -> pa.RecordBatch:
        self.flush()
        write_entries(self.index, self.directory)
        self.archive.close()
        self.index.close()
        row = {"shard": TaskContext.get().partitionId(), "archive": self.paths[0], "index": self.paths[1], "first": json.dumps(self.directory[0][0])}
        return pa.RecordBatch.from_pylist([row])


def _write(folder: str, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = None
        for batch in batches:
            for row in zip(*batch.columns, strict=True):
                writer = writer or _Writer(folder)
                writer.add(*(x.as_py() for x in row), date)
        if writer:
            yield writer.close()

    return run


def _write_root(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = [[json.loads(r["first"]), r["index"], r["archive"]] for batch in batches for r in batch.to_pylist()]
        if entries:
            name = f"root-{uuid.uuid4().hex}"
            out = create(folder, name)
            write_entries(out, entries)
            out.close()
            yield pa.RecordBatch.from_pylist([{"path": f"{folder}/{name}"}])

    return run


def write_archive(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", shared_bytes: int = 1000, date: str = "1970-01-01T00:00:00Z", folder: str | None = None) -> Archive:
    """A record per row, and the index over them."""
    folder = folder or scratch_path(pages.sparkSession, "warc")
    payload = F.coalesce(F.col(html_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), clean_uri(F.col(url_col)).alias("uri"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    large = F.octet_length("payload") >= shared_bytes
    copies = rows.filter(large).groupBy("digest").agg(F.count("*").alias("n"), F.max(F.struct("page_id", "uri")).alias("whole"))
    copies = stage(copies.filter("n > 1").select(F.col("digest").alias("of"), "whole"), "warc-copies")
    joined = rows.join(copies, large & (F.col("digest") == F.col("of")), "left")
    revisits = F.col("of").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("whole.page_id"))
    records = joined.select(
        key_of(F.col("uri")).alias("key"),
        "page_id",
        "uri",
        "payload",
        "digest",
        F.when(revisits, F.col("whole.page_id")).alias("refers_to"),
        F.when(revisits, F.col("whole.uri")).alias("refers_uri"),
    )
    order = [F.asc("key"), F.asc_nulls_first("page_id")]
    records = records.repartitionByRange(*order).sortWithinPartitions(*order)
    files = stage(records.mapInArrow(_write(folder, date), "shard long, archive string, index string, first string"), "warc-files")
    root = files.orderBy("shard").coalesce(1).mapInArrow(_write_root(folder), "path string").collect()
    return Archive(files, root[0]["path"] if root else None)


# Reading

def _capture(record: Record) -> tuple:
    kind, n = record.headers["WARC-Type"], len(record.payload)
    digest = hashlib.sha1(record.payload).hexdigest()
    own = (n, digest) if kind == "response" else (None, None)
    said = base64.b32decode(record.headers["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    return (record.page_id, *own, kind, record.refers_to, record.headers.get("WARC-Refers-To-Target-URI"), said)


def _read(root: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(root)
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "refers_uri", "said_digest"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()]
        for batch in batches:
            for archive, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for lines in index.blocks(path):
                    start, end = lines[0][3], lines[-1][3] + lines[-1][4]  # the block's records lie side by side
                    span = index.archive(archive).read_at(end - start, start)
                    rows = [_capture(parse_record(span[x[3] - start : x[3] - start + x[4]])) for x in lines]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return run


def read_archive(archive: Archive) -> DataFrame:
    """Every record as it stands in the archives; sizes and digests of the payloads that are there, and the digest a record states."""
    spark = archive.files.sparkSession
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, refers_uri string, said_digest string"
    if archive.root is None:
        return spark.createDataFrame([], schema)
    tasks = max(1, min(10_000, archive.files.count()))
    return archive.files.select("archive", "index").repartition(tasks).mapInArrow(_read(archive.root), schema)


def _look_up(root: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, last, found = Index(root), None, (None, None)
        for batch in batches:
            sizes, digests = [], []
            for wanted in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                if last != wanted:  # wanted captures are sorted, so copies of one payload stand together
                    key, page, digest = wanted
                    hits = (index.read(a, line) for a, line in index.find(key, page) if line[1:3] == ["response", digest])
                    payload = next((r.payload for r in hits), None)
                    found = (None, None) if payload is None else (len(payload), hashlib.sha1(payload).hexdigest())
                    last = wanted
                sizes.append(found[0])
                digests.append(found[1])
            columns = [*batch.columns, pa.array(sizes, pa.int64()), pa.array(digests, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "payload_bytes", "payload_digest"])

    return run


def look_up(archive: Archive, wanted: DataFrame) -> DataFrame:
    """``wanted`` (key, id, payload digest, then other columns) with size and digest of that response's payload, NULL if there is none.

    One page may have been captured under its URL with several payloads; the digest tells them apart.
    """
    names = wanted.columns
    schema = ", ".join(f"{n} {t}" for n, t in wanted.dtypes) + ", payload_bytes long, payload_digest string"
    ordered = wanted.repartitionByRange(*names).sortWithinPartitions(*names)
    return ordered.mapInArrow(_look_up(archive.root), schema)


def write_and_read(pages: DataFrame, id_col: str = "page_id", **options) -> DataFrame:
    """Archive the pages and read the archives back: size and digest of every page's whole payload, and what record holds it."""
    archive = write_archive(pages, id_col, **options)
    captures = stage(read_archive(archive), "warc-captures")
    result = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    if archive.root is None:
        return captures.select(*result).withColumnRenamed("page_id", id_col)
    revisits = captures.filter("record_type = 'revisit'")
    wanted = revisits.select(key_of(F.col("refers_uri")).alias("key"), "refers_to", "said_digest", "page_id", "record_type")
    resolved = look_up(archive, wanted).select(*result)
    return captures.filter("record_type = 'response'").select(*result).unionByName(resolved).withColumnRenamed("page_id", id_col)
