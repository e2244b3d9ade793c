from __future__ import annotations

import hashlib
import struct
import subprocess

import pytest
import zstandard as zstd

from toneflow.llm import warc
from toneflow.session import scratch_path

from .conftest import prose

LONG = "<p>" + prose(1, 40) + "</p>"
PAGES = [(1, "http://a/1", LONG), (2, "http://a/2", LONG), (3, None, None), (4, "http://a/4", ""), (5, "http://a/5", "short"),
         (6, "http://a/6", "short"), (7, "http://a/7 x\r\ny: z", "é" * 50), (8, "u", "é" * 50), (None, "u", LONG), (None, "v", "n" * 200),
         (2, "http://a/2", LONG), (9, "w", "\r\n\r\nWARC/1.1\r\n" * 50), (10, "z", prose(2, 40_000))]


@pytest.fixture
def pages(spark):
    def make(rows):
        return spark.createDataFrame(rows, "page_id long, url string, html string")
    return make


def expected(rows):
    first = {}
    for i, _, h in rows:
        if i is not None and len((h or "").encode()) >= 100:
            first[h] = min(first.get(h, i), i)
    out = []
    for i, _, h in rows:
        b = (h or "").encode()
        f = first.get(h)
        again = len(b) >= 100 and f is not None and f != i
        out.append((i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", f if again else None))
    return sorted(out, key=str)


def test_round_trip(pages):
    back = warc.round_trip(pages(PAGES).selectExpr("*", "'c' AS digest", "'c' AS first", "'c' AS path"))
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r[n] for n in names) for r in back.collect()), key=str) == expected(PAGES)
    bodies = {r["page_id"]: bytes(r["payload"]).decode() for r in back.collect() if r["record_type"] == "response" and r["page_id"]}
    assert all(bodies[i] == (h or "") for i, _, h in PAGES if i in bodies and i is not None)
    assert warc.round_trip(pages([])).count() == 0


def test_archives_can_be_read_by_others(spark, pages):
    """A dictionary in a leading skippable frame, one frame per record, many archives per task."""
    rows = [(i, f"http://h/{i}", f"<html>{prose(i, 120)}</html>") for i in range(400)]
    archives = warc.write(pages(rows).coalesce(1), scratch_path(spark, "warc"), archive_bytes=100_000).collect()
    assert len(archives) > 2 and sum(a["records"] for a in archives) == len(rows)
    seen = 0
    for a in archives:
        with open(a["path"].removeprefix("file:"), "rb") as f:
            data = f.read()
        magic, size = struct.unpack("<II", data[:8])
        assert magic == 0x184D2A5D and data[8:12] == b"\x37\xa4\x30\xec"
        dictionary = zstd.ZstdCompressionDict(data[8:8 + size])
        at = 8 + size
        while at < len(data):
            one = zstd.ZstdDecompressor(dict_data=dictionary).decompressobj()
            text = one.decompress(data[at:])
            assert text.startswith(b"WARC/1.1\r\n") and text.endswith(b"\r\n\r\n")
            at = len(data) - len(one.unused_data)
            seen += 1
    assert seen == len(rows) + len(archives)
    packed = sum(len(zstd.ZstdCompressor(level=3).compress(warc.record(*r[:2], r[2].encode(), "d", None, "t"))) for r in rows)
    stored = sum(int(subprocess.run(["stat", "-c", "%s", a["path"].removeprefix("file:")], capture_output=True, text=True).stdout) for a in archives)
    assert stored < packed + len(archives) * warc.DICTIONARY_BYTES


@pytest.mark.parametrize("cut", [1, 40, 300])
def test_a_head_at_the_end_of_a_read(spark, cut):
    """The archive's last head begins ``cut`` bytes before a read of 1 MB ends, with little behind it."""
    info = b"WARC/1.1\r\nWARC-Type: warcinfo\r\nContent-Type: application/warc-fields\r\nContent-Length: 0\r\n\r\n\r\n\r\n"

    def first(n):
        return warc.record(1, "http://a/1", b"x" * n, hashlib.sha256(b"x" * n).hexdigest(), None, "t")

    n = (2 << 20) - cut - len(info) - len(first(1 << 20))
    writer = warc.Writer(scratch_path(spark, "warc"))
    writer.add(first(n))
    writer.add(warc.record(2, "http://a/2", b"y", hashlib.sha256(b"y").hexdigest(), None, "t"))
    (path, records, raw), = writer.close()
    got = [(h.get("X-Page-ID"), block.split(b"\r\n\r\n", 1)[1]) for h, block in warc.records_of(path) if h["WARC-Type"] != "warcinfo"]
    assert records == 2 and got == [("1", b"x" * n), ("2", b"y")]


def test_damage_is_noticed(spark, pages):
    archives = warc.write(pages([(1, "u", LONG)]).coalesce(1), scratch_path(spark, "warc"))
    assert warc.read_back(archives).count() == 1
    with open(archives.first()["path"].removeprefix("file:"), "r+b") as f:
        f.truncate(f.seek(0, 2) - 10)
    with pytest.raises(Exception, match="records are missing|breaks off"):
        warc.read_back(archives).collect()
