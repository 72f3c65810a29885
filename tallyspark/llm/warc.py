"""WARC archives of pages in Zstandard form: one frame per record, a dictionary in front.

An archive begins with a skippable frame that holds a Zstandard dictionary; each
record after it is a frame of its own, so a reader can start at any record.  Archives
are written by the tasks into the shared folder under fresh names; only names that a
finished task has reported are listed and read, so a lost or repeated task leaves
nothing behind that counts.  Archives are read by Spark's binary source, hence from any
store that Spark reads.

Payloads that occur more than once are stored once: the record of the largest page id
is the response, the others are revisits that refer to it.

Defined results: a null html is an empty payload; a null url is written as
``urn:none``; a null page id is written as ``none`` and comes back null.  Pages that
repeat an id and a payload are responses each if that id is the largest.  An archive
without pages is not written.  A malformed frame, header or length stops the job, or is
reported in ``error`` with ``on_error="report"``.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.session import materialized, scratch_path

# Fixed values of the archive format.
DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Compressed bytes after which a task begins its next archive.
ARCHIVE_BYTES = 32 << 20
#: Payload bytes from which a task trains the dictionary of an archive, and the size of that dictionary.
SAMPLE_BYTES = 2 << 20
DICTIONARY_BYTES = 64 << 10

PAGE = "page_id long, url string, payload binary, payload_digest string, refers_to long"
RECORD = (
    "record_type string, page_id long, url string, payload_bytes long, payload_digest string, refers_to long, "
    "payload binary, error string"
)


class WarcError(ValueError):
    """A frame or record that does not follow the format."""


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(page_id: int | None) -> str:
    return "<urn:page:none>" if page_id is None else f"<urn:page:{page_id}>"


def _page_of(urn: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+|none)>", urn or "")
    if not found:
        raise WarcError(f"record id {urn!r}")
    return None if found[1] == "none" else int(found[1])


def record_bytes(page_id: int | None, url: str | None, payload: bytes, payload_digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One record; a revisit has the HTTP head but no payload."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    lines = [
        VERSION,
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_urn(page_id)}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~._-') if url is not None else 'urn:none'}",
        f"WARC-Payload-Digest: sha1:{payload_digest}",
        "Content-Type: application/http; msgtype=response",
    ]
    if revisit:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {_urn(refers_to)}"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(data: bytes, first: str) -> tuple[dict[str, str], int]:
    end = data.find(b"\r\n\r\n")
    if end < 0:
        raise WarcError("headers do not end")
    start, *lines = data[:end].decode("utf-8").split("\r\n")
    if not start.startswith(first):
        raise WarcError(f"starts with {start[:40]!r}")
    out: dict[str, str] = {}
    for line in lines:
        name, colon, value = line.partition(":")
        if not colon or name.lower() in out:
            raise WarcError(f"header line {line[:60]!r}")
        out[name.lower()] = value.strip()
    return out, end + 4


def _length(headers: dict[str, str]) -> int:
    if not re.fullmatch(r"\d+", headers.get("content-length", "")):
        raise WarcError(f"content length {headers.get('content-length')!r}")
    return int(headers["content-length"])


def parse_record(data: bytes) -> dict:
    """Validated fields of one record."""
    headers, start = _headers(data, VERSION)
    kind = headers.get("warc-type")
    if kind not in ("response", "revisit"):
        raise WarcError(f"record type {kind!r}")
    length = _length(headers)
    if len(data) != start + length + 4 or data[-4:] != b"\r\n\r\n":
        raise WarcError(f"block of {len(data) - start - 4} bytes, {length} announced")
    block = data[start:-4]
    http, body = _headers(block, "HTTP/1.")
    payload, announced = block[body:], _length(http)
    name = headers.get("warc-payload-digest", "").removeprefix("sha1:")
    if kind == "response":
        if len(payload) != announced:
            raise WarcError(f"payload of {len(payload)} bytes, {announced} announced")
        if digest(payload) != name:
            raise WarcError("payload digest differs")
    elif payload or "warc-refers-to" not in headers or headers.get("warc-profile") != REVISIT_PROFILE:
        raise WarcError("revisit with a payload, another profile or nothing to refer to")
    url = headers.get("warc-target-uri")
    return {
        "record_type": kind,
        "page_id": _page_of(headers.get("warc-record-id")),
        "url": None if url == "urn:none" else url,
        "payload_bytes": announced,
        "payload_digest": name,
        "refers_to": _page_of(headers["warc-refers-to"]) if kind == "revisit" else None,
        "payload": payload if kind == "response" else None,
        "error": None,
    }


def dictionary_frame(dictionary: zstandard.ZstdCompressionDict) -> bytes:
    data = zstandard.ZstdCompressor(level=19).compress(dictionary.as_bytes())
    return struct.pack("<II", DICTIONARY_MAGIC, len(data)) + data


def train_dictionary(samples: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """A dictionary from the first records of an archive; None where they are too few to learn from."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples)
    except zstandard.ZstdError:
        return None


def frames(data: bytes) -> Iterator[bytes]:
    """The records of an archive: the dictionary is loaded, then one frame is decoded at a time."""
    view, at = memoryview(data), 0
    dictionary = None
    if len(data) >= 8 and struct.unpack_from("<I", data)[0] == DICTIONARY_MAGIC:
        size = struct.unpack_from("<I", data, 4)[0]
        at = 8 + size
        if at > len(data):
            raise WarcError("the dictionary frame is cut off")
        content = bytes(view[8:at])
        if content[:4] == FRAME_MAGIC:
            content = zstandard.ZstdDecompressor().decompress(content)
        dictionary = zstandard.ZstdCompressionDict(content)
    reader = zstandard.ZstdDecompressor(dict_data=dictionary) if dictionary else zstandard.ZstdDecompressor()
    while at < len(data):
        if at + 8 <= len(data) and 0x184D2A50 <= struct.unpack_from("<I", data, at)[0] <= 0x184D2A5F:
            at += 8 + struct.unpack_from("<I", data, at + 4)[0]
            continue
        one = reader.decompressobj()
        parts, step = [], 64 << 10
        while not one.eof:
            if at >= len(data):
                raise WarcError("a frame is cut off")
            piece = view[at : at + step]
            try:
                parts.append(one.decompress(piece))
            except zstandard.ZstdError as failed:
                raise WarcError(f"a frame cannot be decoded: {failed}") from failed
            at += len(piece) - len(one.unused_data) if one.eof else len(piece)
        yield b"".join(parts)


class _Archives:
    """Writes the records of one task into archives of bounded size."""

    def __init__(self, folder: str, archive_bytes: int):
        from pyarrow import fs

        self.files, self.folder = fs.FileSystem.from_uri(folder)
        self.archive_bytes = archive_bytes
        self.waiting: list[bytes] = []
        self.waiting_bytes = 0
        self.out = None
        self.done: list[tuple[str, int, int]] = []

    def add(self, record: bytes) -> None:
        if self.out is None:
            self.waiting.append(record)
            self.waiting_bytes += len(record)
            if self.waiting_bytes >= SAMPLE_BYTES:
                self.begin()
        else:
            self.put(record)
        if self.out is not None and self.bytes >= self.archive_bytes:
            self.close()

    def begin(self) -> None:
        self.name = f"pages-{uuid.uuid4().hex}.warc.zst"
        self.out = self.files.open_output_stream(f"{self.folder}/{self.name}", compression=None)
        self.bytes = self.records = 0
        dictionary = train_dictionary(self.waiting)
        if dictionary:
            self.write(dictionary_frame(dictionary))
        self.coder = zstandard.ZstdCompressor(level=6, dict_data=dictionary, write_content_size=True, write_checksum=True)
        waiting, self.waiting, self.waiting_bytes = self.waiting, [], 0
        for record in waiting:
            self.put(record)

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.bytes += len(data)

    def put(self, record: bytes) -> None:
        self.write(self.coder.compress(record))
        self.records += 1

    def close(self) -> None:
        if self.waiting:
            self.begin()
        if self.out is not None:
            self.out.close()
            self.done.append((self.name, self.records, self.bytes))
            self.out = None


def with_revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Pages with payload, digest and, for repeats of a payload of at least ``least_bytes``, the page it refers to.

    Only digests and ids are shuffled to find repeats; a digest that fills a third of the table is
    a few rows per task by then.
    """
    pages = pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8").alias("payload")
    ).withColumn("sha", F.unhex(F.sha1("payload")))
    repeated = (
        pages.filter(F.length("payload") >= least_bytes)
        .groupBy(F.col("sha").alias("repeated_sha"))
        .agg(F.count("*").alias("n"), F.max("page_id").alias("response_id"))
        .filter((F.col("n") > 1) & F.col("response_id").isNotNull())
        .drop("n")
    )
    repeated = materialized(repeated, "warc-repeated")
    joined = pages.join(repeated, F.col("sha") == F.col("repeated_sha"), "left")
    refers = F.when(F.col("page_id").isNull() | (F.col("page_id") != F.col("response_id")), F.col("response_id"))
    return joined.select("page_id", "url", "payload", F.lower(F.hex("sha")).alias("payload_digest"), refers.alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write every page as a record and return the finished archives: ``path``, ``records``, ``bytes``."""
    spark = pages.sparkSession
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(folder)
    place = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(place)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(place)
    target = place.toUri().toString()
    target = target.replace("file:/", "file:///", 1) if re.match("file:/[^/]", target) else target

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archives = _Archives(target, archive_bytes)
        for batch in batches:
            for page_id, url, payload, sha, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                name = base64.b32encode(bytes.fromhex(sha)).decode()
                archives.add(record_bytes(page_id, url, payload, name, refers_to, refers_to is not None))
        archives.close()
        names, records, sizes = zip(*archives.done) if archives.done else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array([f"{target}/{n}" for n in names], pa.string()), pa.array(records, pa.int64()), pa.array(sizes, pa.int64())],
            names=["path", "records", "bytes"],
        )

    written = with_revisits(pages, least_bytes).mapInArrow(write, "path string, records long, bytes long")
    return materialized(written, "warc-archives")


def read_archives(spark: SparkSession, paths: str | list[str], on_error: str = "raise", with_payload: bool = True) -> DataFrame:
    """One row per record of the archives at ``paths`` (files, folders or patterns that Spark can read)."""

    def make(batch_bytes: int = 8 << 20):
        schema = pa.schema(
            [("record_type", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64())]
            + [("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()), ("error", pa.string())]
        )

        def records(content: bytes) -> Iterator[dict]:
            try:
                for data in frames(content):
                    try:
                        yield parse_record(data)
                    except (WarcError, UnicodeDecodeError) as failed:
                        if on_error != "report":
                            raise
                        yield {"error": str(failed)}
            except WarcError as failed:
                if on_error != "report":
                    raise
                yield {"error": str(failed)}

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for content in batch.column(0):
                    rows, size = [], 0
                    for row in records(content.as_py()):
                        size += len(row.get("payload") or b"") + 200
                        if not with_payload:
                            row.pop("payload", None)
                        rows.append(row)
                        if size >= batch_bytes:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, size = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema)

        return run

    if not paths:
        return spark.createDataFrame([], RECORD)
    return spark.read.format("binaryFile").load(paths).select("content").mapInArrow(make(), RECORD)


def round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write all pages as archives into the shared folder and read the records back."""
    spark = pages.sparkSession
    folder = scratch_path(spark, "warc")
    listed = write_archives(pages, folder, least_bytes)
    # The names of finished archives: one for each 16 MB of compressed records and one for each task.
    names = [r["path"].rsplit("/", 1)[1] for r in listed.select("path").collect()]
    if not names:
        return read_archives(spark, [])
    paths = folder if _all_listed(spark, folder, names) else [f"{folder}/{n}" for n in names]
    return read_archives(spark, paths, with_payload=False)


def _all_listed(spark: SparkSession, folder: str, names: list[str]) -> bool:
    """Whether the folder holds the finished archives and nothing else."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)
    return {f.getPath().getName() for f in files} == set(names)
