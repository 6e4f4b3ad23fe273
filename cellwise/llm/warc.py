"""WARC archives of pages, one Zstandard frame per record, with a dictionary in each file.

A file starts with a skippable frame that holds a dictionary built from the file's own
records; each record follows as a frame of its own, compressed with it. Spark's text
writer writes the frames (so its commit protocol guards the files, on any filesystem);
the line separator it puts after each one is an empty skippable frame, which decoders pass
over. Equal payloads are stored once: later ones become revisit records.
"""
from __future__ import annotations

import hashlib
import io
import re
from collections.abc import Iterator
from datetime import datetime, timezone
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import list_file_sizes, rename_path
from .common import map_arrow, materialise, slices

# fixed values of the formats
DICTIONARY_FRAME = b"\x5d\x2a\x4d\x18"              # a skippable frame with a dictionary
SEPARATOR = b"\x50\x2a\x4d\x18\x00\x00\x00\x00"     # an empty skippable frame; all bytes are ASCII, as the text writer needs
ZSTD_FRAME = b"\x28\xb5\x2f\xfd"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
WARC_FIELDS = "id string, type string, uri string, payload_bytes long, payload_digest string, refers_to string"

ID_URN, NO_ID = "urn:page:", "urn:no-page"


def record_uri(page_id: str | None) -> str:
    return NO_ID if page_id is None else ID_URN + quote(page_id, safe="")


def _page_id(uri: str) -> str | None:
    return None if uri == NO_ID else unquote(uri[len(ID_URN):])


def warc_record(page_id: str | None, url: str | None, payload: bytes, digest: str, refers_to: str | None, date: str) -> bytes:
    """A response record, or a revisit one that refers to another page's: its block ends with the HTTP header."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{record_uri(page_id)}>",
            f"WARC-Date: {date}", f"WARC-Payload-Digest: sha256:{digest}"]
    if url is not None:         # white space and control characters do not belong into a header
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f-\x9f]", lambda m: quote(m[0]), url))
    if refers_to is not None:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <{record_uri(refers_to)}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def build_dictionary(records: list[bytes], size: int, train_bytes: int) -> zstandard.ZstdCompressionDict:
    """A dictionary of at most ``size`` bytes, from records evenly spread over the file, about
    ``train_bytes`` in all. Too few records to train on: the start of the first ones is the dictionary."""
    held = sum(map(len, records))
    step = max(1, -(-held // train_bytes))
    sample = [r[:1 << 17] for r in records[::step]]
    if len(sample) >= 16 and sum(map(len, sample)) >= 8 * size:
        try:
            return zstandard.train_dictionary(size, sample, k=512, d=8)
        except zstandard.ZstdError:         # e.g. samples without anything in common
            pass
    return zstandard.ZstdCompressionDict(b"".join(r[:2048] for r in sample[:8])[:size], dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def archive_frames(records: list[bytes], dict_bytes: int, train_bytes: int, level: int) -> Iterator[bytes]:
    """The frames of one file: the dictionary's, then each record's."""
    made = build_dictionary(records, dict_bytes, train_bytes)
    stored = zstandard.ZstdCompressor(level=19).compress(made.as_bytes())
    yield DICTIONARY_FRAME + len(stored).to_bytes(4, "little") + stored
    packer = zstandard.ZstdCompressor(level=level, dict_data=made, write_checksum=True)
    for r in records:
        yield packer.compress(r)


def _payload(col) -> F.Column:
    return F.coalesce(F.col(col).cast("binary"), F.lit(b""))


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                   min_revisit_bytes: int = 100, file_bytes: int = 64 << 20, file_records: int = 1 << 14,
                   dict_bytes: int = 1 << 16, train_bytes: int = 4 << 20, level: int = 3, date: str | None = None) -> None:
    """Write one WARC record per row to ``path`` as ``*.warc.zst`` files.

    Payloads are UTF-8 bytes, NULL ones empty. Of rows with equal payloads (by SHA-256 and
    length) of at least ``min_revisit_bytes`` bytes, those with the smallest id are responses
    and the others revisit it; all smaller ones are responses. NULL ids come after all
    others: such rows are responses where no row of the group has an id. Rows that repeat an
    id are records of their own, with the same record id. A NULL url has no target header.

    A task gathers ``file_bytes`` of records (or ``file_records`` less one) at a time and
    ends the file; a longer record is not cut. A file's dictionary has ``dict_bytes`` at
    most and is trained on about ``train_bytes`` of its records, 128 kB of each at most: the
    one bounded sample here, which sizes depend on and contents do not. Payloads are not
    shuffled unless the table of repeated digests is beyond Spark's broadcast threshold.
    An empty table gives no file.
    """
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    rows = pages.select(F.col(id_col).alias("page"), F.col(url_col).cast("string").alias("url"), _payload(payload_col).alias("payload"))
    rows = rows.withColumn("digest", F.unhex(F.sha2("payload", 256))).withColumn("size", F.octet_length("payload"))
    firsts = materialise(rows.filter(F.col("size") >= min_revisit_bytes).groupBy("digest", "size")
                         .agg(F.min("page").alias("first"), F.count("*").alias("copies")).filter("copies > 1")
                         .select(F.col("digest").alias("_digest"), F.col("size").alias("_size"), "first"), "warc-firsts")
    # rows that cannot revisit anything have keys of their own, so that they do not meet in one task
    alone = F.xxhash64("page", "url", "digest").cast("string").cast("binary")
    key = F.when(F.col("size") >= min_revisit_bytes, F.col("digest")).otherwise(alone)
    keyed = rows.withColumn("key", key)
    marked = keyed.join(firsts, (F.col("key") == F.col("_digest")) & (F.col("size") == F.col("_size")), "left").select(
        F.col("page").cast("string").alias("id"), "url", "payload", F.lower(F.hex("digest")).alias("digest"),
        F.when(~F.col("page").eqNullSafe(F.col("first")), F.col("first")).cast("string").alias("refers_to"))

    def run(batches):
        def out(frames):
            return pa.RecordBatch.from_arrays([pa.array(frames, pa.binary())], names=["frame"])

        def file(records, last):
            frames = []
            for f in archive_frames(records, dict_bytes, train_bytes, level):
                frames.append(f)
                if len(frames) == 512:
                    yield out(frames)
                    frames = []
            if not last:                    # empty frames, so that Spark's writer goes on to the next file
                frames += [b""] * (file_records - 1 - len(records))
            if frames:
                yield out(frames)

        held, size = [], 0
        for b in slices(batches, 64):
            for page, url, payload, digest, refers in zip(*[c.to_pylist() for c in b.columns]):
                if held and (size >= file_bytes or len(held) == file_records - 1):
                    yield from file(held, False)
                    held, size = [], 0
                held.append(warc_record(page, url, payload, digest, refers, date))
                size += len(held[-1])
        if held:
            yield from file(held, True)

    (map_arrow(marked, run, "frame binary").select(F.col("frame").cast("string").alias("value"))
     .write.option("lineSep", SEPARATOR.decode()).option("maxRecordsPerFile", file_records).text(path))
    for name, size in list_file_sizes(pages.sparkSession, path):
        if name.endswith(".txt"):
            rename_path(pages.sparkSession, name, name.removesuffix(".txt") + ".warc.zst")


class _Stream:
    """Lines and byte runs of a decompressed archive, a piece at a time."""

    def __init__(self, content: bytes):
        at, made = 0, None
        if content[:4] == DICTIONARY_FRAME:
            at = 8 + int.from_bytes(content[4:8], "little")
            stored = content[8:at]
            made = zstandard.ZstdCompressionDict(
                zstandard.ZstdDecompressor().decompress(stored) if stored[:4] == ZSTD_FRAME else stored)
        tool = zstandard.ZstdDecompressor(dict_data=made) if made else zstandard.ZstdDecompressor()
        self.source = tool.stream_reader(io.BytesIO(memoryview(content)[at:]), read_across_frames=True)
        self.held, self.at = b"", 0

    def _more(self) -> bool:
        got = self.source.read(1 << 20)
        self.held, self.at = self.held[self.at:] + got, 0
        return bool(got)

    def head(self) -> list[str] | None:
        """Lines up to the empty one; None at the end of the archive."""
        while (end := self.held.find(b"\r\n\r\n", self.at)) < 0:
            if not self._more():
                if self.at < len(self.held):
                    raise ValueError("the archive ends within a record")
                return None
        lines, self.at = self.held[self.at:end].decode().split("\r\n"), end + 4
        return lines

    def take(self, n: int) -> bytes:
        pieces = []
        while n > 0:
            piece = self.held[self.at:self.at + n]
            pieces.append(piece)
            n, self.at = n - len(piece), self.at + len(piece)
            if n > 0 and not self._more():
                raise ValueError("the archive ends within a record")
        return b"".join(pieces)


def _fields(lines: list[str]) -> dict[str, str]:
    return {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


def read_records(content: bytes) -> Iterator[tuple[str | None, str, str | None, bytes, int, str, str | None]]:
    """``id, type, uri, payload, payload_bytes, payload_digest, refers_to`` of each record. The digest of a
    response is that of the payload read, and must be the one in its header."""
    stream = _Stream(content)
    while (lines := stream.head()) is not None:
        fields = _fields(lines)
        block = stream.take(int(fields["content-length"]))
        if stream.take(4) != b"\r\n\r\n":
            raise ValueError("a record does not end where its length says")
        head, _, payload = block.partition(b"\r\n\r\n")
        size, digest = int(_fields(head.decode().split("\r\n"))["content-length"]), fields["warc-payload-digest"].removeprefix("sha256:")
        kind, refers = fields["warc-type"], fields.get("warc-refers-to")
        if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
            raise ValueError(f"payload of {fields['warc-record-id']} is not what was archived")
        yield (_page_id(fields["warc-record-id"][1:-1]), kind, fields.get("warc-target-uri"), payload, size, digest,
               None if refers is None else _page_id(refers[1:-1]))


def read_archives(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """The records of all ``*.warc.zst`` files below ``path``: ``id, type, uri, payload_bytes,
    payload_digest, refers_to`` and, if asked for, ``payload`` (empty for revisits). A file is
    read by one task, which its writer's ``file_bytes`` bounds, and decompressed in pieces.
    Damaged files raise."""
    def run(batches):
        for b in slices(batches, 1):
            rows, held = [], 0
            for r in read_records(b.column(0)[0].as_py()):
                rows.append(r)
                held += len(r[3]) if payloads else 0
                if len(rows) == 1024 or held > 8 << 20:
                    yield out(rows)
                    rows, held = [], 0
            if rows:
                yield out(rows)

    def out(rows):
        page, kind, uri, payload, size, digest, refers = zip(*rows)
        columns = [pa.array(page, pa.string()), pa.array(kind), pa.array(uri, pa.string()), pa.array(size, pa.int64()),
                   pa.array(digest), pa.array(refers, pa.string())] + ([pa.array(payload, pa.binary())] if payloads else [])
        names = [f.split()[0] for f in WARC_FIELDS.split(", ")] + ["payload"] * payloads
        return pa.RecordBatch.from_arrays(columns, names=names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(path).select("content")
    return map_arrow(files, run, WARC_FIELDS + (", payload binary" if payloads else ""))
