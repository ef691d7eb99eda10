"""Web archives: WARC records, and a two-level capture index to read them back.

Writing.  Every page is a record whose payload is the page in UTF-8.  Of the pages with equal payloads of at least ``LEAST`` bytes, the one with the smallest
id is written as a response and the others as revisits that refer to it; shorter payloads are always responses.  A task writes its records, each a gzip member
of its own, into archives of about ``ARCHIVE_BYTES``.

Indexing.  Captures are sorted by key: the URL with its host reversed (``org,example)/path``), then the record id.  Each range of the sort is an index file: its
captures in compressed blocks of ``BLOCK``, then a sparse directory with the first key of each block.  The first level is one row per index file (first key and
path); there are as many as range partitions, whatever the number of captures.

Reading.  A key finds its index file by binary search among the first keys, its block by binary search in that file's directory, its capture
in the decompressed block; then only the record's bytes are read.  Keys are dealt to tasks by index file.

A file gets a name of its own in every attempt, and only files named in a finished task's rows are ever read, so lost executors leave unused files and nothing else.
Null page: empty payload.  Null URL: an empty key.  Null ids: the record gets a generated id and comes back with a null one; it never is the response that others refer to, and
if no page with its payload has an id, each is a response.  Repeated ids are read back each.
"""

from __future__ import annotations

import bisect
import gzip
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.scratch import new_folder, opened, stored

LEAST = 100
BLOCK = 256
ARCHIVE_BYTES = 256 << 20
DATE = "2024-01-01T00:00:00Z"
INDEX_ROWS = 50_000  # captures of an index file, about
READ_ROWS = 8192  # captures that a task reads, about
BROADCAST_DIGESTS = 100_000  # repeated payloads of which a broadcast side may have so many


def url_key(url: str | None) -> str:
    """The URL with its host's labels reversed and without its scheme; ``b.example.org/x`` becomes ``org,example,b)/x``."""
    rest = (url or "").split("://", 1)[-1]
    cut = min((k for k in (rest.find(c) for c in "/?#") if k >= 0), default=len(rest))
    return ",".join(reversed(rest[:cut].lower().split("."))) + ")" + rest[cut:] if rest else ""


def capture_key(url: str | None, record_id: int) -> tuple[str, int]:
    return url_key(url), record_id


# Records


def record_bytes(kind: str, url: str | None, record_id: int | None, payload: bytes, refers_to: int | None) -> bytes:
    digest = hashlib.sha256(payload).hexdigest()
    headers = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:{f'uuid:{uuid.uuid4()}' if record_id is None else f'page:{record_id}'}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {json.dumps(url or '')[1:-1]}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Payload-Length: {len(payload)}",
    ]
    if refers_to is not None:
        headers += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    body = b"" if kind == "revisit" else payload
    headers += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}"]
    return "\r\n".join(headers).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    length = int(headers["Content-Length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError("a record's length does not hold")
    return headers, rest[:length]


def number_in(urn: str) -> int | None:
    """The page's id; None of a record with a generated id."""
    return int(urn.rsplit(":", 1)[1].rstrip(">")) if urn.startswith("<urn:page:") else None


def read_record(member: bytes) -> tuple[int | None, int, str, str, int | None]:
    """Id, payload length and digest, type and referred id of a compressed record, whose payload is checked."""
    headers, payload = parse_record(gzip.decompress(member))
    size, digest = int(headers["WARC-Payload-Length"]), headers["WARC-Payload-Digest"].removeprefix("sha256:")
    refers = headers.get("WARC-Refers-To")
    if refers is None and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"the payload of {headers['WARC-Record-ID']} is damaged")
    return number_in(headers["WARC-Record-ID"]), size, digest, headers["WARC-Type"], number_in(refers) if refers else None


def typed(pages: DataFrame) -> DataFrame:
    """(id, url, html, refers_to) of (id, url, html): refers_to is null for responses, else the smallest known id with that payload.  Pages without an id refer like others.

    Only the first page of each payload that occurs more than once is joined back, by the digest; pages with other payloads find no partner.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    marked = pages.withColumn("digest", F.when(F.octet_length(payload) >= LEAST, F.sha2(payload, 256)))
    first = marked.filter("digest IS NOT NULL").groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("copies"))
    repeated = stored(first.filter("copies > 1").select(F.col("digest").alias("d"), "first"))
    repeated = F.broadcast(repeated) if repeated.count() <= BROADCAST_DIGESTS else repeated
    joined = marked.join(repeated, F.col("digest") == F.col("d"), "left")
    return joined.select("id", "url", "html", F.when(~F.col("first").eqNullSafe(F.col("id")), F.col("first")).alias("refers_to"))


NO_ID = "\x00"  # before the key of a capture without a page id
ENTRY = "key string, id long, archive string, offset long, length long"


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes (id, url, html, refers_to) as records and returns the captures: key, id, archive, offset and length of each record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = opened(folder)
        stream, name, at = None, "", 0
        for whole in batches:
            for start in range(0, whole.num_rows, 128):
                rows = []
                for row in whole.slice(start, 128).to_pylist():
                    if stream is None or at >= archive_bytes:
                        if stream is not None:
                            stream.close()
                        name, at = f"{base}/{uuid.uuid4().hex}.warc.gz", 0
                        stream = system.open_output_stream(name, compression=None)
                    payload = (row["html"] or "").encode("utf-8", "surrogatepass")
                    kind = "response" if row["refers_to"] is None else "revisit"
                    data = gzip.compress(record_bytes(kind, row["url"], row["id"], payload, row["refers_to"]), 6, mtime=0)
                    stream.write(data)
                    key, number = url_key(row["url"]), row["id"]
                    if number is None:  # the capture is found by its place
                        key, number = f"{NO_ID}{key}", int.from_bytes(hashlib.sha256(f"{name}:{at}".encode()).digest()[:7], "big")
                    rows.append((key, number, name, at, len(data)))
                    at += len(data)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), ENTRY_TYPES, strict=True)], ENTRY_NAMES)
        if stream is not None:
            stream.close()

    ENTRY_NAMES = [f.split()[0] for f in ENTRY.split(", ")]
    ENTRY_TYPES = [pa.string() if f.endswith("string") else pa.int64() for f in ENTRY.split(", ")]
    return stored(pages.select("id", "url", "html", "refers_to").mapInArrow(run, ENTRY))


# Index


def write_index(captures: DataFrame, folder: str, rows: int = INDEX_ROWS) -> DataFrame:
    """Writes the sorted captures as index files and returns the first level: (key, id, file) with the first capture of each file."""
    files = max(1, -(-captures.count() // rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = opened(folder)
        stream, name, at, directory, block = None, f"{base}/{uuid.uuid4().hex}.idx", 0, [], []

        def flush() -> None:
            nonlocal at, block
            data = zlib.compress(json.dumps(block).encode(), 6)
            stream.write(data)
            directory.append((block[0][0], block[0][1], at, len(data)))
            at, block = at + len(data), []

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                stream = stream or system.open_output_stream(name, compression=None)
                block.append(row)
                if len(block) == BLOCK:
                    flush()
        if stream is None:
            return
        if block:
            flush()
        data = zlib.compress(json.dumps(directory).encode(), 6)
        stream.write(data + len(data).to_bytes(8, "big"))
        stream.close()
        yield pa.RecordBatch.from_arrays([pa.array([directory[0][0]]), pa.array([directory[0][1]], pa.int64()), pa.array([name])], ["key", "id", "file"])

    order = ["key", "id", "archive", "offset"]
    ranged = captures.repartitionByRange(files, *order).sortWithinPartitions(*order)
    return stored(ranged.select("key", "id", "archive", "offset", "length").mapInArrow(run, "key string, id long, file string"))


@dataclass
class IndexFile:
    """An index file of which only the directory and the wanted blocks are read."""

    system: fs.FileSystem
    path: str

    def __post_init__(self) -> None:
        self.source = self.system.open_input_file(self.path)
        size = self.source.size()
        length = int.from_bytes(self.source.read_at(8, size - 8), "big")
        self.directory = json.loads(zlib.decompress(self.source.read_at(length, size - 8 - length)))
        self.firsts = [(key, id_) for key, id_, _, _ in self.directory]
        self.loaded: tuple[int, list] = (-1, [])

    def block(self, k: int) -> list:
        if self.loaded[0] != k:
            _, _, at, length = self.directory[k]
            self.loaded = k, json.loads(zlib.decompress(self.source.read_at(length, at)))
        return self.loaded[1]

    def find(self, key: str, id_: int) -> Iterator[tuple[str, int, int]]:
        """(archive, offset, length) of the captures with this key and id; equal ones may run over several blocks."""
        k = max(0, bisect.bisect_left(self.firsts, (key, id_)) - 1)
        while k < len(self.directory) and tuple(self.firsts[k]) <= (key, id_):
            rows = self.block(k)
            at = bisect.bisect_left(rows, [key, id_])
            while at < len(rows) and rows[at][:2] == [key, id_]:
                yield rows[at][2], rows[at][3], rows[at][4]
                at += 1
            k += 1

    def close(self) -> None:
        self.source.close()


READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def look_up(keys: DataFrame, level: DataFrame, folder: str) -> DataFrame:
    """The records of the captures (key, id), read by the index.  ``level`` is the first level; it has a row per index file.

    Returns page_id, payload_bytes, payload_digest, record_type and refers_to.  A payload that does not have the length and digest of its record fails the job.
    """
    spark = keys.sparkSession
    order = ["key", "id"]
    files = [tuple(r) for r in level.orderBy(*order).collect()]  # one row per range partition
    shared = spark.sparkContext.broadcast(files)

    def which(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts = [f[:2] for f in shared.value]
        for batch in batches:
            wanted = list(zip(batch.column("key").to_pylist(), batch.column("id").to_pylist(), strict=True))
            # Equal captures may start in the file before: every file from there on whose first key is not above is asked.
            lows = [max(0, bisect.bisect_left(firsts, w) - 1) for w in wanted]
            highs = [bisect.bisect_right(firsts, w) for w in wanted]
            rows = [(n, f) for n, (low, high) in enumerate(zip(lows, highs, strict=True)) for f in range(low, max(high, low + 1)) if f < len(firsts)]
            take = pa.array([n for n, _ in rows], pa.int64())
            yield pa.RecordBatch.from_arrays([*(c.take(take) for c in batch.columns), pa.array([f for _, f in rows], pa.int64())], ["key", "id", "file"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = opened(folder)
        index, types = (-1, None), [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        for whole in batches:
            for start in range(0, whole.num_rows, 512):
                places = []
                for key, id_, file in zip(*(c.to_pylist() for c in whole.slice(start, 512).columns), strict=True):
                    if index[0] != file:
                        if index[1]:
                            index[1].close()
                        index = file, IndexFile(system, shared.value[file][2])
                    places += index[1].find(key, id_)
                rows = []
                for path, at in groupby(sorted(places), key=lambda p: p[0]):
                    with system.open_input_file(path) as archive:
                        rows += [read_record(archive.read_at(length, offset)) for _, offset, length in at]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], [f.split()[0] for f in READ.split(", ")])

    placed = keys.distinct().select(*order).mapInArrow(which, "key string, id long, file long")
    tasks = max(1, len(files), -(-keys.count() // READ_ROWS))  # several tasks may read one index file, each its own blocks
    dealt = placed.repartitionByRange(tasks, "file", *order).sortWithinPartitions("file", *order)
    return dealt.mapInArrow(read, READ)


def archive_and_read(pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Writes every page to archives, indexes them, and reads all records back by the index."""
    folder = new_folder(pages.sparkSession)
    rows = pages.select(F.col(id).cast("long").alias("id"), F.col(url).cast("string").alias("url"), F.col(html).cast("string").alias("html"))
    captures = write_archives(typed(rows), folder)
    level = write_index(captures, folder)
    return look_up(captures.select("key", "id"), level, folder)
