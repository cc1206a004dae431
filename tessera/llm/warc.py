"""WARC archives compressed with Zstandard: a dictionary frame, then a frame for each record.

An archive starts with a skippable frame (magic 0x184D2A5D) that holds the
dictionary of all frames after it; each of those is one record. The reader
loads the dictionary, decodes a frame at a time, and checks the version line,
the headers that the standard asks for, both lengths and the payload's digest.

Archives go to the shared folder of the cluster. A task names its files after
its own attempt, and only the files that the manifest lists are read, so a task
that ran twice or died leaves no record in the result.

Defined cases: a null payload is an empty one; a null page_id or url stays null;
of rows that repeat a page_id with one payload, all that have the largest id are
responses; a payload of any length is one record; an empty table gives no archive and no rows; other columns, whatever
their names, are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import struct
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.shared import fresh_path, materialize

#: Payload bytes after which a task begins another archive.
ARCHIVE_BYTES = 32 << 20
#: Records whose payloads make an archive's dictionary, bytes taken of each, and the dictionary's size.
DICT_RECORDS, DICT_SAMPLE_BYTES, DICT_BYTES = 64, 16 << 10, 32 << 10
LEVEL = 3
_DICT_MAGIC = 0x184D2A5D
_VERSION = b"WARC/1.1"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NEEDED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")
_UNSAFE = re.compile("[\x00-\x20%\x7f]")
MANIFEST = "path string, n_records long, n_bytes long"
RECORDS = "archive string, record_id string, record_type string, target_uri string, refers_to string, payload_bytes long, payload_digest string"


class BadArchive(ValueError):
    """A frame, header, length or digest is not what the format asks for."""


def _header_value(s: str) -> str:
    return _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", s)


def record(kind: str, record_id: str, uri: str | None, payload: bytes, digest: str, refers_to: str | None, date: str) -> bytes:
    """A record's bytes; a revisit has the response's HTTP headers without its payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    lines = [f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {date}", "Content-Type: application/http;msgtype=response"]
    if uri is not None:
        lines.append(f"WARC-Target-URI: {_header_value(uri)}")
    lines.append(f"WARC-Payload-Digest: sha1:{digest}")
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <{refers_to}>", f"WARC-Profile: {_PROFILE}"]
    lines.append(f"Content-Length: {len(block)}")
    return _VERSION + b"\r\n" + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """A record's headers and payload, checked; the payload of a revisit is None."""
    head, sep, rest = raw.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not sep or lines[0] not in (b"WARC/1.1", b"WARC/1.0"):
        raise BadArchive("no WARC version line")
    headers: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.decode("utf-8").partition(":")
        if not colon:
            raise BadArchive(f"not a header: {name[:80]}")
        headers[name.strip()] = value.strip()
    if missing := [h for h in _NEEDED if h not in headers]:
        raise BadArchive(f"missing {', '.join(missing)}")
    length = int(headers["Content-Length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise BadArchive(f"Content-Length is {length}, the block has {len(rest) - 4}")
    http, _, payload = rest[:length].partition(b"\r\n\r\n")
    told = re.search(rb"(?im)^content-length:[ ]*(\d+)", http)
    size = int(told[1]) if told else len(payload)
    digest = headers.get("WARC-Payload-Digest", "").removeprefix("sha1:")
    if headers["WARC-Type"] != "revisit":
        if size != len(payload):
            raise BadArchive(f"the payload has {len(payload)} bytes of {size}")
        if digest and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise BadArchive("the payload does not have its digest")
    return {
        "record_id": headers["WARC-Record-ID"].strip("<>"),
        "record_type": headers["WARC-Type"],
        "target_uri": unquote(headers["WARC-Target-URI"]) if "WARC-Target-URI" in headers else None,
        "refers_to": headers["WARC-Refers-To"].strip("<>") if "WARC-Refers-To" in headers else None,
        "payload_bytes": size,
        "payload_digest": digest,
        "payload": None if headers["WARC-Type"] == "revisit" else payload,
    }


def make_dictionary(payloads: list[bytes]):  # noqa: ANN201
    """A dictionary trained on the payloads, or of their bytes where they are too few to train on."""
    import zstandard

    samples = [p[:DICT_SAMPLE_BYTES] for p in payloads if len(p) >= 8]
    try:
        if len(samples) < 8:
            raise zstandard.ZstdError("few samples")
        return zstandard.train_dictionary(DICT_BYTES, samples, k=256, d=8)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"".join(samples)[:DICT_BYTES] or b"<!DOCTYPE html>", dict_type=zstandard.DICT_TYPE_RAWCONTENT)


class ArchiveWriter:
    """Writes one archive to an open stream."""

    def __init__(self, out, dictionary):  # noqa: ANN001
        import zstandard

        data = dictionary.as_bytes()
        out.write(struct.pack("<II", _DICT_MAGIC, len(data)) + data)
        self.out, self.n, self.bytes = out, 0, 8 + len(data)
        self.packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_content_size=True, write_checksum=True)

    def add(self, raw: bytes) -> None:
        frame = self.packer.compress(raw)
        self.out.write(frame)
        self.n += 1
        self.bytes += len(frame)


def read_stream(stream) -> Iterator[bytes]:  # noqa: ANN001
    """The bytes of each record of an archive, a frame at a time."""
    import zstandard

    head = stream.read(8)
    if len(head) < 8 or struct.unpack("<II", head)[0] != _DICT_MAGIC:
        raise BadArchive("no dictionary frame")
    size = struct.unpack("<II", head)[1]
    data = stream.read(size)
    if len(data) != size:
        raise BadArchive("the dictionary frame is cut short")
    if data[:4] == b"\x28\xb5\x2f\xfd":  # the dictionary may itself be compressed
        data = zstandard.ZstdDecompressor().decompress(data)
    unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data))
    left = b""
    while True:
        frame = unpacker.decompressobj()
        whole = io.BytesIO()
        fed = False
        while not frame.eof:
            piece = left or stream.read(1 << 20)
            left = b""
            if not piece:
                if fed:
                    raise BadArchive("the last frame is cut short")
                return
            fed = True
            try:
                whole.write(frame.decompress(piece))
            except zstandard.ZstdError as e:
                raise BadArchive(str(e)) from e
        left = frame.unused_data
        yield whole.getvalue()


def write_archives(records: DataFrame, out: str, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write records (record_id, url, payload, digest_hex, refers_to) below ``out``; the manifest of the archives.

    refers_to is null for a response and the id of that response for a revisit.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt = TaskContext.get()
        where, root = fs.FileSystem.from_uri(out)
        where.create_dir(root, recursive=True)
        done: list[tuple[str, int, int]] = []
        pending: list[tuple] = []
        state: dict = {"held": 0}

        def close() -> None:
            if not pending:
                return
            name = f"{attempt.partitionId():06d}-{attempt.taskAttemptId()}-{len(done):04d}.warc.zst"
            with where.open_output_stream(f"{root}/{name}") as stream:
                archive = ArchiveWriter(stream, make_dictionary([r[2] for r in pending[:DICT_RECORDS]]))
                for record_id, url, payload, digest, refers_to in pending:
                    kind = "response" if refers_to is None else "revisit"
                    archive.add(record(kind, record_id, url, payload, base64.b32encode(bytes.fromhex(digest)).decode(), refers_to, date))
            done.append((f"{out}/{name}", archive.n, archive.bytes))
            pending.clear()
            state["held"] = 0

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("record_id", "url", "payload", "digest_hex", "refers_to")), strict=True):
                pending.append(row)
                state["held"] += len(row[2])
                if state["held"] >= ARCHIVE_BYTES:
                    close()
        close()
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64()), pa.array([d[2] for d in done], pa.int64())], names=["path", "n_records", "n_bytes"])

    rows = records.select("record_id", "url", "payload", "digest_hex", "refers_to")
    return materialize(rows.mapInArrow(run, MANIFEST), "warc-manifest")


def read_archives(manifest: DataFrame, with_payload: bool = False) -> DataFrame:
    """The records of the manifest's archives, each read as a stream by one task."""
    n = max(1, manifest.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["record_id", "record_type", "target_uri", "refers_to", "payload_bytes", "payload_digest"] + ["payload"] * with_payload
        kinds = [pa.string()] * 4 + [pa.int64(), pa.string()] + [pa.binary()] * with_payload

        def batch_of(path: str, rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([path] * len(rows), pa.string()), *(pa.array([r[c] for r in rows], k) for c, k in zip(names, kinds, strict=True))], names=["archive", *names])

        for batch in batches:
            for path in batch.column("path").to_pylist():
                where, place = fs.FileSystem.from_uri(path)
                with where.open_input_stream(place) as stream:
                    rows, held = [], 0
                    for raw in read_stream(stream):
                        rows.append(parse(raw))
                        held += len(raw) if with_payload else 256
                        if held >= 4 << 20:
                            yield batch_of(path, rows)
                            rows, held = [], 0
                    if rows:
                        yield batch_of(path, rows)

    return manifest.select("path").repartition(min(n, 100_000), "path").mapInArrow(run, RECORDS + ", payload binary" * with_payload)


def with_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Records of pages; of equal payloads of at least min_bytes, the one of the largest page_id is the response.

    Only digests are grouped, with partial sums before the shuffle; payloads
    move once, to meet the digests that more than one page has.
    """
    rows = pages.select("page_id", "url", F.encode(F.coalesce("html", F.lit("")), "utf-8").alias("payload"))
    rows = rows.withColumn("digest_hex", F.sha1("payload"))
    again = (
        rows.filter(F.octet_length("payload") >= min_bytes)
        .groupBy("digest_hex")
        .agg(F.max("page_id").alias("keep"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select("digest_hex", "keep")
    )
    revisit = (F.octet_length("payload") >= min_bytes) & F.col("keep").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keep"))
    urn = lambda c: F.concat(F.lit("urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("none")))
    return rows.join(again, "digest_hex", "left").select(urn("page_id").alias("record_id"), "url", "payload", "digest_hex", F.when(revisit, urn("keep")).alias("refers_to"))


def page_of(urn: str):  # noqa: ANN201
    """The page_id in a record's id; null for a page without one."""
    return F.expr(f"try_cast(substring({urn}, {len('urn:page:') + 1}) AS bigint)")


def pages_round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write all pages to archives, read them back: page_id, payload_bytes, payload_digest, record_type, refers_to, target_uri."""
    out = fresh_path(pages.sparkSession, "warc")
    found = read_archives(write_archives(with_revisits(pages, min_bytes), out))
    return found.select(page_of("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page_of("refers_to").alias("refers_to"), F.col("target_uri").alias("url"))
