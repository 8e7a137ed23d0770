"""WARC records in seekable Zstandard bundles.

A bundle is one file of independent Zstandard frames, each holding a group of WARC records,
closed by a seek table in a skippable frame (the public "seekable format": an entry of
compressed and uncompressed size per frame, then a footer with the number of frames). A
reader finds the table from the end of the file and decompresses only the frame it needs.
The index maps every record id to its bundle, frame, and offset and length inside the frame.

Bundles are written by tasks through Arrow's file systems to the shared folder, each under
a name of its own attempt; the index that Spark commits names only bundles of attempts that
ended well, so a lost executor leaves at most files that nothing refers to.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written
from tidemark.session import scratch_path

FRAME_BYTES = 256 * 1024  # a frame is closed once it holds as much
BUNDLE_BYTES = 32 * 1024 * 1024  # so is a bundle, compressed
LEVEL = 3
RUN = 32  # frames that a reading task takes, on average
#: Payloads of this many bytes or more are stored once.
REVISIT_BYTES = 1_000

# Fixed values of the seekable format.
_SKIPPABLE, _SEEKABLE = 0x184D2A5E, 0x8F92EAB1
_FOOTER, _ENTRY = "<IBI", "<II"

_INDEX = (
    "page_id long, url string, record_type string, refers_to long, bundle string, frame int, "
    "frame_start long, frame_bytes long, offset long, length long"
)


def marked_revisits(pages: DataFrame, least_bytes: int = REVISIT_BYTES) -> DataFrame:
    """``page_id, url, payload, digest, refers_to``: which page holds the payload of each.

    Of pages with equal payloads of ``least_bytes`` or more the one with the largest
    ``page_id`` holds it, and ``refers_to`` of the others names it; elsewhere it is null.
    Rows that repeat the largest ``page_id`` all hold it. A null ``page_id`` neither
    refers nor is referred to. A null ``html`` counts as empty.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    each = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        payload.alias("payload"),
        F.sha1(payload.cast("binary")).alias("digest"),
    )
    large = each.where((F.octet_length("payload") >= least_bytes) & F.col("page_id").isNotNull())
    holders = large.groupBy("digest", F.octet_length("payload").alias("size")).agg(
        F.max("page_id").alias("holder"), F.min("page_id").alias("least")
    )
    shared = holders.where("holder > least").select(F.col("digest").alias("d"), "size", "holder")
    joined = each.join(shared, (F.col("digest") == F.col("d")) & (F.octet_length("payload") == F.col("size")), "left")
    return joined.withColumn("refers_to", F.when(F.col("page_id") < F.col("holder"), F.col("holder"))).drop(
        "d", "size", "holder"
    )


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record, a resource with its payload or a revisit without."""
    named = base64.b32encode(bytes.fromhex(digest)).decode()
    kind = "response" if refers_to is None else "revisit"
    body = payload if refers_to is None else b""
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
        ("WARC-Target-URI", re.sub(r"[\r\n]+", " ", url or "")),
        ("WARC-Payload-Digest", f"sha1:{named}"),
        ("X-Payload-Length", str(len(payload))),
        ("Content-Type", "text/html; charset=utf-8"),
    ]
    if refers_to is not None:
        fields += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", f"<urn:page:{refers_to}>"),
        ]
    fields.append(("Content-Length", str(len(body))))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + body + b"\r\n\r\n"


def parsed_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """The header fields and the body of one record."""
    end = data.index(b"\r\n\r\n")
    lines = data[:end].decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"not a record: {lines[0][:40]!r}")
    head = dict(line.split(": ", 1) for line in lines[1:])
    body = data[end + 4 : -4]
    if len(body) != int(head["Content-Length"]) or data[-4:] != b"\r\n\r\n":
        raise ValueError(f"record {head['WARC-Record-ID']} is cut off")
    return head, body


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """The skippable frame that closes a bundle, from compressed and uncompressed sizes."""
    entries = b"".join(struct.pack(_ENTRY, *f) for f in frames)
    body = entries + struct.pack(_FOOTER, len(frames), 0, _SEEKABLE)
    return struct.pack("<II", _SKIPPABLE, len(body)) + body


def read_seek_table(source, size: int) -> list[tuple[int, int, int]]:
    """Start, compressed and uncompressed size of every frame, from the end of an open file."""
    footer, entry = struct.calcsize(_FOOTER), struct.calcsize(_ENTRY)
    source.seek(size - footer)
    frames, _, magic = struct.unpack(_FOOTER, source.read(footer))
    if magic != _SEEKABLE:
        raise ValueError("no seek table")
    source.seek(size - footer - frames * entry)
    table, at = [], 0
    for packed, plain in struct.iter_unpack(_ENTRY, source.read(frames * entry)):
        table.append((at, packed, plain))
        at += packed
    return table


def _store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path in it; a path without a scheme is local."""
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))


class _Bundle:
    """One bundle while it is written: at most a frame of records is held in memory."""

    def __init__(self, folder: str):
        store, inner = _store(folder)
        store.create_dir(inner, recursive=True)
        name = f"bundle-{uuid.uuid4().hex}.warc.zst"
        self.path = f"{folder.rstrip('/')}/{name}"
        # No further compression, which the ending of the name would otherwise call for.
        self.sink = store.open_output_stream(f"{inner.rstrip('/')}/{name}", compression=None)
        self.frames: list[tuple[int, int]] = []
        self.at = 0
        self.held: list[bytes] = []
        self.size = 0
        self.rows: list[dict] = []
        self.open_rows: list[dict] = []

    def add(self, data: bytes, row: dict) -> None:
        self.open_rows.append(row | {"bundle": self.path, "offset": self.size, "length": len(data)})
        self.held.append(data)
        self.size += len(data)
        if self.size >= FRAME_BYTES:
            self.flush()

    def flush(self) -> None:
        if not self.held:
            return
        packed = zstandard.ZstdCompressor(level=LEVEL).compress(b"".join(self.held))
        self.sink.write(packed)
        place = {"frame": len(self.frames), "frame_start": self.at, "frame_bytes": len(packed)}
        self.rows += [row | place for row in self.open_rows]
        self.frames.append((len(packed), self.size))
        self.at += len(packed)
        self.held, self.size, self.open_rows = [], 0, []

    def close(self) -> list[dict]:
        self.flush()
        self.sink.write(seek_table(self.frames))
        self.sink.close()
        return self.rows


def write_bundles(marked: DataFrame, folder: str) -> DataFrame:
    """Write every row of :func:`marked_revisits` as a record; returns the written index.

    Every task writes bundles of its own, one after the other. The index has a row per
    record, ``page_id, url, record_type, refers_to, bundle, frame, frame_start,
    frame_bytes, offset, length``, offset and length inside the uncompressed frame.
    """
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}
    schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in _INDEX.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle = None
        for batch in batches:
            columns = [batch.column(n) for n in ("page_id", "url", "payload", "digest", "refers_to")]
            for cells in zip(*columns, strict=True):
                page, url, payload, digest, refers = (c.as_py() for c in cells)
                data = record(page, url, payload.encode(), digest, refers)
                kind = "response" if refers is None else "revisit"
                bundle = bundle or _Bundle(folder)
                bundle.add(data, {"page_id": page, "url": url, "record_type": kind, "refers_to": refers})
                if bundle.at >= BUNDLE_BYTES:
                    yield pa.RecordBatch.from_pylist(bundle.close(), schema=schema)
                    bundle = None
        if bundle:
            yield pa.RecordBatch.from_pylist(bundle.close(), schema=schema)

    return written(marked.mapInArrow(run, _INDEX), "warc-index")


def read_bundles(index: DataFrame) -> DataFrame:
    """Read the archives back: a row per record found in the bundles that ``index`` names.

    ``page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload``. Frames
    are found by each bundle's own seek table and decompressed one at a time; a stored
    payload is hashed again and must match its header. A revisit has a null payload; its
    bytes and digest are those of the payload it refers to.
    """
    frames = index.groupBy("bundle", "frame").agg(F.array_sort(F.collect_list(F.struct("offset", "length"))).alias("records"))
    # The index is tiny beside what it stands for, so the number of tasks is set by the frames:
    # their size is bounded, and runs of neighbours stay together and in order.
    tasks = max(1, -(-frames.count() // RUN))
    dealt = frames.repartition(tasks, "bundle", F.floor(F.col("frame") / RUN)).sortWithinPartitions("bundle", "frame")
    out = pa.schema(
        [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
         ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, source, table = None, None, []
        for batch in batches:
            for path, frame, records in zip(*(batch.column(c).to_pylist() for c in ("bundle", "frame", "records")), strict=True):
                if path != name:
                    if source:
                        source.close()
                    store, inner = _store(path)
                    source, name = store.open_input_file(inner), path
                    table = read_seek_table(source, source.size())
                start, packed, plain = table[frame]
                source.seek(start)
                data = zstandard.ZstdDecompressor().decompress(source.read(packed), max_output_size=plain)
                yield pa.RecordBatch.from_pylist([_row(data[r["offset"] : r["offset"] + r["length"]]) for r in records], schema=out)
        if source:
            source.close()

    return dealt.mapInArrow(
        run,
        "page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
        "refers_to long, payload binary",
    )


def _row(data: bytes) -> dict:
    head, body = parsed_record(data)
    digest = base64.b32decode(head["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    stored = head["WARC-Type"] == "response"
    if stored and (hashlib.sha1(body).hexdigest() != digest or len(body) != int(head["X-Payload-Length"])):
        raise ValueError(f"record {head['WARC-Record-ID']} does not match its digest")

    def number(name: str) -> int | None:
        text = head.get(name, "").removeprefix("<urn:page:").removesuffix(">")
        return int(text) if text else None

    return {
        "page_id": number("WARC-Record-ID"),
        "url": head["WARC-Target-URI"],
        "payload_bytes": int(head["X-Payload-Length"]),
        "payload_digest": digest,
        "record_type": head["WARC-Type"],
        "refers_to": number("WARC-Refers-To"),
        "payload": body if stored else None,
    }


def archived(pages: DataFrame, folder: str | None = None, least_bytes: int = REVISIT_BYTES) -> DataFrame:
    """Write ``pages`` to bundles below ``folder`` and return what is read back from them.

    ``folder`` defaults to a new one in the shared folder. Extra columns are ignored, and an
    empty table gives no bundles and no rows.
    """
    folder = folder or scratch_path(pages.sparkSession, "warc")
    return read_bundles(write_bundles(marked_revisits(pages, least_bytes), folder))
