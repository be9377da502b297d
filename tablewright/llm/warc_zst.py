"""Dictionary-compressed WARC archives.

Every task writes its pages into archives of about ``archive_bytes`` of
payload.  An archive holds its records back, builds a Zstandard dictionary
from all of them, and writes: a skippable frame (magic 0x184D2A5D) with the
dictionary, then each record as a frame of its own, compressed with that
dictionary, first a warcinfo record.  Any record can thus be read alone once
the leading frame is known, and an archive explains itself.

A page whose payload equals that of a page with a smaller id becomes a
``revisit`` record without a block that refers to it; payloads under
``min_revisit_bytes`` are always written out.

Scale: nothing wide is shuffled.  Payload digests and the smallest id of each
are one narrow aggregate; only digests of several pages are joined back,
broadcast below a counted bound.  Archives go to the shared folder, through
Arrow's file systems for schemes other than ``file``.  A task that is run
again writes archives of new names; those that count are the ones listed in
the manifest, which Spark commits.

Edge cases: null html is an empty payload; a null page id is never referred to
and gets a record id from its payload and URL; of rows that share the smallest id the first by
URL is the response, of equal rows one; an empty table writes no archive.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.session import delete_at_exit, join_bounded

from .common import narrow, numbered, scratch, stage

SKIPPABLE = 0x184D2A5D
LEVEL = 3
MANIFEST = "path string, records long, payload_bytes long, archive_bytes long"
RECORD = "page_id long, url string, record_type string, payload_digest string, payload_bytes long, " \
         "refers_to long, verified boolean, path string"


def _place(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(fields: list[tuple[str, str]], block: bytes = b"") -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def page_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None,
                date: str = "1970-01-01T00:00:00Z") -> bytes:
    """A ``response``-like record of a page, or a revisit of page ``refers_to``."""
    digest = _digest(payload)
    name = f"urn:page:{page_id}" if page_id is not None else f"urn:unnamed:{digest}:{hashlib.sha1((url or '').encode()).hexdigest()}"
    safe = "".join(c for c in url or "" if c >= " ").strip()
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", f"<{name}>"),
              ("WARC-Date", date), *([("WARC-Target-URI", safe)] if safe else []),
              ("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Payload-Length", str(len(payload)))]
    if refers_to is None:
        http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + f"Content-Length: {len(payload)}\r\n\r\n".encode()
        return _record([*fields, ("Content-Type", "application/http;msgtype=response")], http + payload)
    return _record([*fields, ("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile",
                    "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")])


def pack(records: list[bytes], dictionary_bytes: int = 64 << 10) -> bytes:
    """The archive of these records: dictionary frame, then one frame a record."""
    try:
        shared = zstandard.train_dictionary(dictionary_bytes, records, d=8, k=256, level=LEVEL)
    except zstandard.ZstdError:  # too few or too small records to learn from: their bytes serve as they are
        shared = zstandard.ZstdCompressionDict(b"".join(records)[-dictionary_bytes:], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    raw = shared.as_bytes()
    zip_ = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared, write_content_size=True)
    return struct.pack("<II", SKIPPABLE, len(raw)) + raw + b"".join(zip_.compress(r) for r in records)


def unpack(file: io.RawIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (lower-case names) and block of every record of an archive, in order."""
    magic, size = struct.unpack("<II", file.read(8))
    if magic != SKIPPABLE:
        raise ValueError("archive has no leading dictionary frame")
    raw = file.read(size)
    kind = zstandard.DICT_TYPE_FULLDICT if raw[:4] == b"\x37\xa4\x30\xec" else zstandard.DICT_TYPE_RAWCONTENT
    unzip = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw, dict_type=kind))
    text = io.BufferedReader(unzip.stream_reader(file, read_across_frames=True), 1 << 20)
    while line := text.readline():
        if line.strip() != b"WARC/1.1":
            raise ValueError(f"no record begins with {line[:40]!r}")
        fields: dict[str, str] = {}
        while (line := text.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode().partition(":")
            fields[name.lower()] = value.strip()
        block = text.read(int(fields["content-length"]))
        if text.read(4) != b"\r\n\r\n":
            raise ValueError("a record does not end after its block")
        yield fields, block


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = 16 << 20, min_revisit_bytes: int = 0,
                   dictionary_bytes: int = 64 << 10, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html") -> DataFrame:
    """Write one record a page below ``folder``; returns the staged manifest, a row an archive."""
    rows = narrow(pages, {"page_id": id_col, "url": url_col, "html": html_col}).select(
        F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("sha", F.unhex(F.sha1(F.col("html").cast("binary"))))
    url = F.coalesce("url", F.lit("")).alias("url")
    firsts = (rows.where((F.octet_length("html") >= min_revisit_bytes) & F.col("page_id").isNotNull())
              .groupBy("sha", "page_id", url).agg(F.count("*").alias("times"))
              .groupBy("sha").agg(F.sum("times").alias("n"), F.min(F.struct("page_id", "url", "times")).alias("key"))
              .where("n > 1").select(F.col("sha").alias("_sha"), F.col("key.page_id").alias("first"), F.col("key.url").alias("first_url"),
                                     F.col("key.times").alias("times")))
    firsts = stage(firsts, "equal-payloads")
    rows = join_bounded(rows, firsts, rows["sha"] == F.col("_sha"), "left")
    # equal rows of the smallest id: an ordinal says which one is the response
    own = (F.col("page_id") == F.col("first")) & (F.coalesce("url", F.lit("")) == F.col("first_url"))
    rows = rows.withColumn("row_key", F.when(own & (F.col("times") > 1), F.xxhash64("sha", "page_id")))
    rows = rows.select("page_id", "url", "html", "first", "row_key", F.coalesce(own, F.lit(False)).alias("own"))
    rows = numbered(rows, firsts.where("times > 1").select(F.xxhash64("_sha", "first").alias("row_key")))
    rows = rows.select("page_id", "url", "html", F.when(
        F.col("page_id").isNotNull() & F.col("first").isNotNull() & ~(F.col("own") & (F.col("ordinal") == 0)), F.col("first")).alias("refers_to"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _place(folder)
        fs.create_dir(base, recursive=True)
        held, size = [], 0

        def flush():
            name = f"{uuid.uuid4().hex}.warc.zst"
            info = _record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"),
                            ("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Filename", name),
                            ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")
            packed = pack([info, *held], dictionary_bytes)
            with fs.open_output_stream(f"{base}/{name}") as out:
                out.write(packed)
            return pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "records": [len(held)],
                                               "payload_bytes": [size], "archive_bytes": [len(packed)]})
        for b in batches:
            for s in range(0, b.num_rows, 256):
                for r in b.slice(s, 256).to_pylist():
                    payload = r["html"].encode()
                    held.append(page_record(r["page_id"], r["url"], payload, r["refers_to"]))
                    size += len(payload)
                    if size >= archive_bytes:
                        yield flush()
                        held, size = [], 0
        if held:
            yield flush()
    return stage(rows.mapInArrow(run, MANIFEST), "manifest")


def _page_id(name: str | None) -> int | None:
    head = "<urn:page:"
    return int(name[len(head):-1]) if name and name.startswith(head) else None


def read_archives(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """One row a page record of the manifest's archives; ``verified`` says that a
    response's payload has the length and digest its header names."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in RECORD.split(", ")]
        kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.string()]
        for b in batches:
            for path in b.column("path").to_pylist():
                fs, at = _place(path)
                with fs.open_input_stream(at) as file:
                    rows = []
                    for f, block in unpack(file):
                        if f["warc-type"] == "warcinfo":
                            continue
                        digest, size = f["warc-payload-digest"].removeprefix("sha1:"), int(f["warc-payload-length"])
                        payload = block.partition(b"\r\n\r\n")[2]
                        whole = f["warc-type"] == "response"
                        rows.append((_page_id(f["warc-record-id"]), f.get("warc-target-uri"), f["warc-type"],
                                     _digest(payload) if whole else digest, len(payload) if whole else size,
                                     _page_id(f.get("warc-refers-to")),
                                     not whole or (digest == _digest(payload) and size == len(payload)), path))
                        if len(rows) == 4096:
                            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
                            rows = []
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
    return manifest.select("path").repartition("path").mapInArrow(run, RECORD)


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """Write ``pages`` to a new folder of the shared folder and read the archives back.

    The folder goes when the session ends.
    """
    spark, folder = pages.sparkSession, scratch(pages.sparkSession, "warc")
    manifest = write_archives(pages, folder, **options)
    delete_at_exit(spark, folder)
    return read_archives(spark, manifest)
