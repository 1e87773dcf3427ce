"""WARC archives in seekable Zstandard bundles."""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import open_shared, slices, write_shared
from tidemark.plans.storage import store

# Fixed values of the seekable format: a skippable frame with one entry for each frame, and a footer.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
ENTRY, FOOTER = "<II", "<IBI"
# Fixed value: the profile of a revisit whose payload equals an earlier one.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAME = "urn:page:"
INDEX = "record_id string, path string, frame int, frame_start long, frame_size long, record_start long, record_size long"
READ = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def _name(page_id: int | None) -> str:
    return f"<{NAME}{'none' if page_id is None else page_id}>"


def _number(name: str) -> int | None:
    text = name.strip("<>").removeprefix(NAME)
    return None if text == "none" else int(text)


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """One record: HTTP headers and the payload, or for a revisit the headers alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_name(page_id)}", f"WARC-Date: {date}"]
    if url is not None:  # a header is one line
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f%]", lambda m: m[0] if m[0] == "%" else f"%{ord(m[0]):02X}", url))
    lines.append(f"WARC-Payload-Digest: sha1:{digest}")
    if revisit:
        lines += [f"WARC-Refers-To: {_name(refers_to)}", f"WARC-Profile: {PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[int | None, str | None, int, str, str, int | None, bytes | None]:
    """The row of a record; a response's payload is held against its digest."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or digest_of(payload) != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    refers = fields.get("WARC-Refers-To")
    url = fields.get("WARC-Target-URI")
    return _number(fields["WARC-Record-ID"]), url, size, digest, kind, _number(refers) if refers else None, payload if kind == "response" else None


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def split_records(frame: bytes) -> Iterator[bytes]:
    """The records of a frame, by their own lengths."""
    at = 0
    while at < len(frame):
        end = frame.index(b"\r\n\r\n", at) + 4
        end += int(re.search(rb"\r\nContent-Length: (\d+)", frame[at:end])[1]) + 4
        yield frame[at:end]
        at = end


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0, frame_bytes: int = 1 << 18, file_bytes: int = 1 << 26, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write every row of ``pages`` (page_id, url, html) as a WARC record into ``folder``; return the index of the records.

    A null html is an empty payload, a null url leaves the header out, control characters and blanks in a url are
    percent-encoded in the header. Of records with equal payloads of at least ``least_bytes`` bytes, those with the smallest page_id
    are responses and the others revisit it; repeated rows with that page_id are all responses. A null page_id comes after all
    others. Frames close at ``frame_bytes`` of records and files at ``file_bytes``; a longer record has a frame of its own. The
    index has each record's identifier, its file, the frame's place in it and the record's place in the decompressed frame.
    Each attempt of a task writes files of its own name, and the index lists those of the attempt that counted; so a lost
    executor leaves at most unlisted files. ``folder`` is shared by all executors. Rows that share a page_id, or have none, share a
    record identifier, and ``fetch`` returns all of them. Payloads of any length are written whole; other columns are not read. An
    empty table gives no file and an empty index.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, press = TaskContext.get(), zstandard.ZstdCompressor(level=3)
        frames: list[bytes] = []
        entries: list[tuple[int, int]] = []
        rows: list[tuple] = []
        parts: list[bytes] = []
        names: list[tuple[str, int, int]] = []
        size = at = number = 0

        def close_frame() -> None:
            nonlocal size, at, parts, names
            packed = press.compress(b"".join(parts))
            rows.extend((name, path(), len(entries), at, len(packed), start, length) for name, start, length in names)
            frames.append(packed)
            entries.append((len(packed), size))
            at, size, parts, names = at + len(packed), 0, [], []

        def path() -> str:
            return f"{folder}/{task.partitionId():06d}-{task.taskAttemptId()}-{number:05d}.warc.zst"

        def close_file() -> pa.RecordBatch:
            nonlocal frames, entries, rows, at, number
            table = b"".join(struct.pack(ENTRY, *e) for e in entries) + struct.pack(FOOTER, len(entries), 0, SEEKABLE)
            write_shared(path(), [*frames, struct.pack("<II", SKIPPABLE, len(table)), table])
            listed = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=index)
            listed = listed.cast(pa.schema([(n, pa.string() if n in ("record_id", "path") else pa.int32() if n == "frame" else pa.int64()) for n in index]))
            frames, entries, rows, at, number = [], [], [], 0, number + 1
            return listed

        for batch in slices(batches, 64):
            for page_id, url, html, first, revisit in zip(*[batch[c].to_pylist() for c in ("page_id", "url", "html", "first", "revisit")]):
                payload = (html or "").encode()
                record = record_bytes(page_id, url, payload, digest_of(payload), first, revisit, date)
                if size and size + len(record) > frame_bytes:
                    close_frame()
                names.append((_name(page_id), size, len(record)))
                parts.append(record)
                size += len(record)
                if at + size >= file_bytes:
                    close_frame()
                    yield close_file()
        if size:
            close_frame()
        if frames:
            yield close_file()

    index = [part.split()[0] for part in INDEX.split(", ")]
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html")
    ).withColumn("digest", F.unhex(F.sha1("html")))
    shared = rows.where(F.octet_length("html") >= least_bytes).groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    shared = store(shared.where("n > 1 and first is not null").select("digest", "first"), folder + "-groups", "shared")
    marked = rows.join(shared, "digest", "left").withColumn("revisit", F.coalesce(~F.col("page_id").eqNullSafe(F.col("first")) & F.col("first").isNotNull(), F.lit(False)))
    return marked.select("page_id", "url", "html", "first", "revisit").sortWithinPartitions("page_id").mapInArrow(run, INDEX)


def frames_of(paths: DataFrame) -> DataFrame:
    """path, start and size of every frame of the archives in ``paths`` (path), read from their seek tables."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch["path"].to_pylist():
                with open_shared(path) as file:
                    end = file.size()
                    file.seek(end - struct.calcsize(FOOTER))
                    count, _, magic = struct.unpack(FOOTER, file.read(struct.calcsize(FOOTER)))
                    if magic != SEEKABLE:
                        raise ValueError(f"no seek table in {path}")
                    file.seek(end - struct.calcsize(FOOTER) - count * struct.calcsize(ENTRY))
                    sizes = [size for size, _ in struct.iter_unpack(ENTRY, file.read(count * struct.calcsize(ENTRY)))]
                starts = [0, *accumulate(sizes)]
                yield pa.RecordBatch.from_arrays([pa.array([path] * count), pa.array(starts[:-1], pa.int64()), pa.array(sizes, pa.int64())], names=["path", "start", "size"])

    return paths.select("path").distinct().mapInArrow(run, "path string, start long, size long")


def read_archives(frames: DataFrame, with_payload: bool = True, task_bytes: int = 1 << 22) -> DataFrame:
    """A row for each record of the listed frames (path, start, size). A revisit's payload is null, its length and digest are given.

    Frames are dealt out so that a task reads some ``task_bytes`` of them; rows of the list alone are too small to be spread by size.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start, size in zip(*[batch[c].to_pylist() for c in ("path", "start", "size")]):
                with open_shared(path) as file:
                    file.seek(start)
                    frame = zstandard.ZstdDecompressor().decompress(file.read(size))
                rows = [parse_record(record)[: len(kinds)] for record in split_records(frame)]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds.values())], names=list(kinds))

    kinds = {"page_id": pa.int64(), "url": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64()}
    kinds |= {"payload": pa.binary()} if with_payload else {}
    schema = READ if with_payload else READ.removesuffix(", payload binary")
    tasks = -(-(frames.agg(F.sum("size")).first()[0] or 0) // task_bytes)
    return frames.repartition(max(1, tasks), "path", "start").mapInArrow(run, schema)


def fetch(index: DataFrame, record_ids: DataFrame) -> DataFrame:
    """The records named in ``record_ids`` (record_id), each read by a seek to its frame and its place therein."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start, size, at, length in zip(*[batch[c].to_pylist() for c in ("path", "frame_start", "frame_size", "record_start", "record_size")]):
                with open_shared(path) as file:
                    file.seek(start)
                    frame = zstandard.ZstdDecompressor().decompress(file.read(size))
                row = parse_record(frame[at : at + length])
                yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names=[p.split()[0] for p in READ.split(", ")])

    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    return index.join(record_ids.select("record_id").distinct(), "record_id", "left_semi").mapInArrow(run, READ)
