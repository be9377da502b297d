import base64
import hashlib
import io
import struct

import pytest
import zstandard

from tablewright.llm import warc_zst as w

from .data import words


def pages(spark, rows):
    from pyspark.sql import functions as F
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumns(
        {c: F.lit("extra") for c in ("sha", "first", "path", "refers_to", "records", "n", "key")})


def plain(rows, least=0):
    first, out = {}, {}
    for i, u, h in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] or "")):
        b = (h or "").encode()
        f = first.setdefault(b, i) if len(b) >= least else i
        digest = base64.b32encode(hashlib.sha1(b).digest()).decode()
        out[i] = (len(b), digest, "response" if f == i else "revisit", None if f == i else f)
    return out


ROWS = [(i, f"http://h{i % 5}.org/{i}\r\nX: y", "<p>" + " ".join(words(i % 30, 10 + 5 * (i % 30))) + "\r\n\r\nWARC/1.1é</p>")
        for i in range(120)] + [(200, None, None), (201, "", ""), (202, "http://long", "z" * 300_000), (203, "u", "é😀")]


@pytest.mark.parametrize("archive,least", [(1 << 24, 0), (3000, 0), (3000, 100)])
def test_round_trip(spark, archive, least):
    got = w.round_trip(pages(spark, ROWS), archive_bytes=archive, min_revisit_bytes=least).collect()
    assert {r["page_id"]: (r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got} == plain(ROWS, least)
    assert len(got) == len(ROWS) and all(r["verified"] for r in got)
    assert (len({r["path"] for r in got}) > 8) == (archive == 3000)


def test_repeated_rows_null_ids_empty(spark):
    rows = [(5, "b", "same"), (5, "a", "same"), (5, "a", "same"), (7, "c", "same"), (None, "d", "same"), (None, None, None)]
    got = w.round_trip(pages(spark, rows)).collect()
    found = sorted(((r["page_id"] or 0, r["url"] or "", r["record_type"], r["refers_to"] or 0) for r in got))
    assert found == [(0, "", "response", 0), (0, "d", "response", 0), (5, "a", "response", 0), (5, "a", "revisit", 5),
                     (5, "b", "revisit", 5), (7, "c", "revisit", 5)]
    assert w.round_trip(pages(spark, [])).collect() == []


def test_archive_layout():
    """A skippable frame with the dictionary leads; every record is a frame that the dictionary opens alone."""
    records = [w.page_record(i, f"http://x/{i}", ("<html>" + " ".join(words(i, 80))).encode(), None) for i in range(200)]
    data = w.pack(records, 4096)
    magic, size = struct.unpack("<II", data[:8])
    assert magic == 0x184D2A5D and len(data) < sum(map(len, records)) / 2
    unzip = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8:8 + size]))
    at, seen = 8 + size, []
    while at < len(data):
        one = unzip.decompressobj()
        seen.append(one.decompress(data[at:]))
        at = len(data) - len(one.unused_data)
    assert seen == records
    assert len(list(w.unpack(io.BytesIO(data)))) == 200
    alone = zstandard.ZstdCompressor(level=w.LEVEL)
    assert len(data) - size < sum(len(alone.compress(r)) for r in records)
    with pytest.raises(ValueError):
        list(w.unpack(io.BytesIO(b"x" * 40)))


def test_one_small_record():
    record = w.page_record(None, None, b"", None)
    (fields, block), = w.unpack(io.BytesIO(w.pack([record])))
    assert fields["warc-type"] == "response" and block.endswith(b"\r\n\r\n")
