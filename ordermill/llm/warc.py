"""WARC archives compressed with Zstandard: one frame per record, the dictionary in a leading skippable frame.

Writing: payloads that occur more than once are stored once, by the row with the largest key; the other
rows become revisit records that refer to it. Every task writes archives of its own under names that no
other attempt uses, and returns what it wrote; archives of lost attempts are in no manifest and so never read.

Reading: an archive is a stream. The reader takes the dictionary from the first frame, decodes one frame
after the other, holds one record at a time, and checks headers, lengths and digests.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.common import written

# Fixed values of the format.
DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE_LOW, SKIPPABLE_HIGH = 0x184D2A50, 0x184D2A5F
FRAME_MAGIC = 0xFD2FB528
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")

DICTIONARY_BYTES = 16 << 10
DICTIONARY_SAMPLES = 128
LEAST_SAMPLES = 16
READ_BYTES = 64 << 10

MANIFEST = "archive string, n_records long, n_bytes long"
RECORDS = (
    "archive string, offset long, record_id string, record_type string, url string, key string, "
    "payload_bytes long, payload_digest string, refers_to string, payload binary"
)
CONTROL = re.compile(r"[\x00-\x20\x7f]")


class ArchiveError(ValueError):
    """An archive that does not hold what its headers say."""


class Record(NamedTuple):
    record_id: str
    record_type: str
    url: str
    key: str | None
    payload_bytes: int
    payload_digest: str
    refers_to: str | None
    payload: bytes | None  # None for a revisit, whose payload is elsewhere


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data, usedforsecurity=False).digest()).decode("ascii")


def record_id(key: str, url: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{key} {url}')}>"


def header_value(value: str) -> str:
    """Control characters and spaces would end a header line or value; they are percent-encoded."""
    return CONTROL.sub(lambda found: f"%{ord(found[0]):02X}", value)


def build_record(key: str | None, url: str | None, payload: bytes, refers_to: str | None, date: str) -> bytes:
    url, name = header_value(url or ""), key or ""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode("utf-8") + (payload if refers_to is None else b"")
    lines = [
        VERSION.decode("ascii"),
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(name, url)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {url}",
        f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}",
        f"WARC-Block-Digest: sha1:{base32_sha1(block)}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if key is not None:
        lines.append(f"X-Record-Key: {key}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"X-Refers-To-Key: {refers_to}"]
    return "\r\n".join(lines).encode("utf-8") + b"\r\n\r\n" + block + b"\r\n\r\n"


def split_headers(data: bytes, at: int, what: str) -> tuple[str, dict[str, str], int]:
    """First line, fields by lower-case name, and where the body begins."""
    end = data.find(b"\r\n\r\n", at)
    if end < 0:
        raise ArchiveError(f"{what} headers do not end")
    first, *lines = data[at:end].decode("utf-8").split("\r\n")
    fields = {}
    for line in lines:
        name, colon, value = line.partition(":")
        if not colon or not name.strip():
            raise ArchiveError(f"not a {what} header: {line[:80]!r}")
        fields[name.strip().lower()] = value.strip()
    return first, fields, end + 4


def length_of(fields: dict[str, str], what: str) -> int:
    value = fields.get("content-length", "")
    if not value.isascii() or not value.isdigit():
        raise ArchiveError(f"{what} Content-Length is {value!r}")
    return int(value)


def parse_record(data: bytes) -> Record:
    """The record in a decoded frame; raises if the frame is anything but one sound record."""
    first, fields, start = split_headers(data, 0, "record")
    if first.encode("utf-8") != VERSION:
        raise ArchiveError(f"record begins with {first[:40]!r}")
    for name in REQUIRED:
        if name.lower() not in fields:
            raise ArchiveError(f"record has no {name}")
    length = length_of(fields, "record")
    if len(data) != start + length + 4 or data[start + length :] != b"\r\n\r\n":
        raise ArchiveError(f"record of {len(data)} bytes has {start} bytes of headers and says {length}")
    block = data[start : start + length]
    if fields.get("warc-block-digest") != f"sha1:{base32_sha1(block)}":
        raise ArchiveError("block differs from its digest")
    _, http, body = split_headers(block, 0, "HTTP")
    payload_bytes, digest = length_of(http, "HTTP"), fields.get("warc-payload-digest", "").removeprefix("sha1:")
    kind = fields["warc-type"]
    payload: bytes | None = block[body:]
    if kind == "response":
        if len(payload) != payload_bytes or digest != base32_sha1(payload):
            raise ArchiveError("payload differs from its length or digest")
    elif kind == "revisit":
        if payload or "x-refers-to-key" not in fields or fields.get("warc-profile") != PROFILE:
            raise ArchiveError("revisit has a payload, or does not say what it refers to")
        payload = None
    else:
        raise ArchiveError(f"record type {kind[:40]!r}")
    return Record(
        fields["warc-record-id"],
        kind,
        fields.get("warc-target-uri", ""),
        fields.get("x-record-key"),
        payload_bytes,
        digest,
        fields.get("x-refers-to-key"),
        payload,
    )


def train_dictionary(records: list[bytes]) -> bytes:
    """A dictionary from evenly spaced records of one archive, or none if it has too few of them."""
    samples = records[:: max(1, len(records) // DICTIONARY_SAMPLES)][:DICTIONARY_SAMPLES]
    if len(samples) < LEAST_SAMPLES or sum(map(len, samples)) < 2 * DICTIONARY_BYTES:
        return b""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=256, d=8).as_bytes()
    except zstandard.ZstdError:  # samples too alike or too short to learn from
        return b""


def archive_bytes(records: list[bytes]) -> bytes:
    dictionary = train_dictionary(records)
    out = []
    if dictionary:
        out.append(struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary)
    options = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
    compressor = zstandard.ZstdCompressor(level=3, write_checksum=True, write_content_size=True, **options)
    out += [compressor.compress(record) for record in records]
    return b"".join(out)


def read_frames(stream) -> Iterator[tuple[int, bytes]]:
    """Offset and content of every frame of an open archive, after the dictionary frame if there is one."""
    head = stream.read(8)
    offset, decompressor, pending = 0, zstandard.ZstdDecompressor(), bytes(head)
    if len(head) == 8 and SKIPPABLE_LOW <= struct.unpack("<I", head[:4])[0] <= SKIPPABLE_HIGH:
        magic, length = struct.unpack("<II", head)
        dictionary = stream.read(length)
        if magic != DICTIONARY_MAGIC or len(dictionary) != length:
            raise ArchiveError("the leading skippable frame is no whole dictionary")
        if dictionary[:4] == struct.pack("<I", FRAME_MAGIC):  # it may be compressed itself
            dictionary = decompressor.decompress(dictionary)
        decompressor = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
        offset, pending = 8 + length, b""
    while True:
        pending = pending or bytes(stream.read(READ_BYTES))
        if not pending:
            return
        frame, parts, used = decompressor.decompressobj(), [], 0
        while not frame.eof:
            if not pending and not (pending := bytes(stream.read(READ_BYTES))):
                raise ArchiveError("the last frame is cut off")
            try:
                parts.append(frame.decompress(pending))
            except zstandard.ZstdError as problem:
                raise ArchiveError(f"not a sound frame: {problem}") from problem
            rest = bytes(frame.unused_data) if frame.eof else b""
            used += len(pending) - len(rest)
            pending = rest
        yield offset, b"".join(parts)
        offset += used


def open_uri(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", uri))


def write_archives(
    df: DataFrame,
    folder: str,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
    least_bytes: int = 0,
    roll_bytes: int = 16 << 20,
    date: str = "1970-01-01T00:00:00Z",
) -> DataFrame:
    """Write a record per row under ``folder``; returns the manifest (``archive``, ``n_records``, ``n_bytes``).

    Payload is ``html`` in UTF-8, empty for null. Among payloads that are equal and have at least
    ``least_bytes``, the one with the largest key is the response and the others revisit it; rows that tie
    for that key are all responses, as are rows without any key to refer to. A null url is empty, a null
    key is left out. An archive is closed once its records have ``roll_bytes``; a longer one has an archive
    of its own. An empty table gives an empty manifest. Only the three columns are read.
    """
    payload = F.coalesce(F.col(f"`{html}`").cast("string"), F.lit("")).cast("binary")
    rows = df.select(
        F.col(f"`{key}`").alias("key"), F.col(f"`{url}`").cast("string").alias("url"), payload.alias("payload")
    ).withColumn("digest", F.sha1("payload"))
    # Digests only are shuffled here, reduced to one row per task and digest first.
    last = written(rows.groupBy("digest").agg(F.max("key").alias("last_key")), "warc-digests")
    refers = (F.octet_length("payload") >= least_bytes) & (
        F.col("key").isNull() | (F.col("key") < F.col("last_key"))
    )
    records = rows.join(last, "digest", "left").select(
        F.col("key").cast("string").alias("key"),
        "url",
        "payload",
        F.when(refers, F.col("last_key")).cast("string").alias("refers_to"),
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        name = f"{folder}/part-{context.partitionId():06d}-{context.taskAttemptId()}"
        made: list[bytes] = []
        size = number = 0

        def close() -> pa.RecordBatch:
            nonlocal made, size, number
            content = archive_bytes(made)
            uri = f"{name}-{number:05d}.warc.zst"
            filesystem, path = open_uri(uri)
            filesystem.create_dir(path.rpartition("/")[0], recursive=True)
            with filesystem.open_output_stream(path, compression=None) as out:
                out.write(content)
            row = {"archive": [uri], "n_records": [len(made)], "n_bytes": [len(content)]}
            made, size, number = [], 0, number + 1
            return pa.RecordBatch.from_pydict(row)

        for batch in batches:
            for item in zip(*(batch.column(name) for name in ("key", "url", "payload", "refers_to"))):
                made.append(build_record(*(value.as_py() for value in item), date))
                size += len(made[-1])
                if size >= roll_bytes:
                    yield close()
        if made:
            yield close()

    # Written, so that a second look at the manifest does not write the archives again.
    return written(records.mapInArrow(write, MANIFEST), "warc-manifest")


def read_archives(manifest: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records of the archives that ``manifest`` names, with ``payload`` null for revisits.

    Raises on the first record whose frame, headers, lengths or digests are not sound, naming archive and
    offset. ``with_payload=False`` checks all the same and only leaves the payloads out. An empty manifest
    gives no records.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [
                ("archive", pa.string()),
                ("offset", pa.int64()),
                *[(name, pa.string()) for name in ("record_id", "record_type", "url", "key")],
                ("payload_bytes", pa.int64()),
                ("payload_digest", pa.string()),
                ("refers_to", pa.string()),
                ("payload", pa.binary()),
            ]
        )
        for uri in (uri for batch in batches for uri in batch.column("archive").to_pylist()):
            filesystem, path = open_uri(uri)
            rows, size, offset = [], 0, 0
            with filesystem.open_input_stream(path, compression=None) as stream:
                try:
                    for offset, data in read_frames(stream):
                        record = parse_record(data)
                        if not with_payload:
                            record = record._replace(payload=None)
                        rows.append({"archive": uri, "offset": offset, **record._asdict()})
                        size += len(record.payload or b"") + 500
                        if size > 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, size = [], 0
                except (ArchiveError, UnicodeDecodeError) as problem:
                    raise ArchiveError(f"{uri} at {offset}: {problem}") from problem
            yield pa.RecordBatch.from_pylist(rows, schema)

    # The manifest is small; its archives are spread over the tasks by name.
    tasks = manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")
    return manifest.repartition(int(tasks), "archive").mapInArrow(read, RECORDS)


def resolved(records: DataFrame) -> DataFrame:
    """The records as they are; a revisit whose response is not among them, with its key and digest, raises.

    A response may be in any archive of the set, so this needs all of its records. They are written without
    their payloads first, and the archives are read once.
    """
    narrow = written(records.drop("payload"), "warc-records")
    responses = narrow.where("record_type = 'response'").select(
        F.col("key").alias("refers_to"), "payload_digest", F.lit(True).alias("found")
    )
    joined = narrow.join(responses.distinct(), ["refers_to", "payload_digest"], "left")
    lost = F.concat(F.lit("no response "), "refers_to", F.lit(" for the revisit "), F.coalesce("key", F.lit("without key")))
    sound = F.when((F.col("record_type") == "revisit") & F.col("found").isNull(), F.raise_error(lost).cast("boolean"))
    return joined.where(F.coalesce(sound, F.lit(True))).select(*narrow.columns)
