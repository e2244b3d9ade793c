"""WARC archives with a Zstandard dictionary of their own.

An archive is a skippable frame that holds the dictionary, then one frame per
record, so any record can be read alone once its offset is known.  Every
task writes the records it has, rolls over to a new archive when one is full,
and trains each dictionary from the first records of that archive
(``SAMPLE_BYTES`` at most).  Names are new for every attempt and only a task
that succeeds reports its archives, so what a lost executor leaves behind is
never read.

Folders are opened by their URI through Arrow: local and shared folders, HDFS
and object stores alike.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard as zstd
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from toneflow.llm.tables import OWN, stored
from toneflow.session import scratch_path

# Fixed values of the format: magic number of the skippable frame with a dictionary, and of a dictionary.
DICTIONARY_FRAME, DICTIONARY = 0x184D2A5D, b"\x37\xA4\x30\xEC"
ARCHIVE_BYTES, SAMPLE_BYTES, DICTIONARY_BYTES, LEAST_REVISIT = 128 << 20, 1 << 20, 64 << 10, 100
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"


def record_id(page: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page}')}>"


def record(page: object, url: str | None, payload: bytes, digest: str, refers_to: object, date: str) -> bytes:
    """One record; a revisit has the HTTP head only."""
    kind = "response" if refers_to is None else "revisit"
    block = HTTP % len(payload) + (payload if refers_to is None else b"")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(page)}", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(url.split()))
    head.append(f"WARC-Payload-Digest: sha256:{digest}")
    if page is not None:
        head.append(f"X-Page-ID: {page}")
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {record_id(refers_to)}", f"X-Refers-To-Page-ID: {refers_to}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8", "replace") + b"\r\n\r\n" + block + b"\r\n\r\n"


def dictionary_of(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A trained dictionary, or plain content where there is too little to train from."""
    total = sum(map(len, samples))
    if len(samples) >= 16 and total >= 16 * 1024:
        try:
            return zstd.train_dictionary(min(size, total // 8), samples, k=256, d=8, f=20, accel=4).as_bytes()
        except zstd.ZstdError:
            pass  # samples that are too alike or too small to train from
    return b"".join(samples)[-size:]


def _dictionary(data: bytes) -> zstd.ZstdCompressionDict:
    kind = zstd.DICT_TYPE_FULLDICT if data.startswith(DICTIONARY) else zstd.DICT_TYPE_RAWCONTENT
    return zstd.ZstdCompressionDict(data, dict_type=kind)


class Writer:
    """Archives of one task."""

    def __init__(self, folder: str, archive_bytes: int = ARCHIVE_BYTES, level: int = 3):
        self.folder, self.archive_bytes, self.level = folder.rstrip("/"), archive_bytes, level
        self.done: list[tuple[str, int, int]] = []
        self.waiting: list[bytes] = []
        self.held = self.records = self.raw = 0
        self.file = self.compressor = None
        self.path = ""

    def add(self, data: bytes) -> None:
        if self.file is None:
            self.waiting.append(data)
            self.held += len(data)
            if self.held >= min(SAMPLE_BYTES, self.archive_bytes):
                self._open()
        else:
            self._put(data)
        if self.raw >= self.archive_bytes:
            self.close()

    def _open(self) -> None:
        """Train from the records that wait, and write them."""
        data = dictionary_of(self.waiting)
        self.path = f"{self.folder}/part-{uuid.uuid4().hex}.warc.zst"
        system, path = fs.FileSystem.from_uri(self.path)
        system.create_dir(path.rsplit("/", 1)[0], recursive=True)
        self.file = system.open_output_stream(path, compression=None)  # else the suffix decides
        self.compressor = zstd.ZstdCompressor(level=self.level, dict_data=_dictionary(data))
        self.file.write(struct.pack("<II", DICTIONARY_FRAME, len(data)) + data)
        self._put(b"WARC/1.1\r\nWARC-Type: warcinfo\r\nContent-Type: application/warc-fields\r\nContent-Length: 0\r\n\r\n\r\n\r\n")
        self.records = 0
        waiting, self.waiting, self.held = self.waiting, [], 0
        for w in waiting:
            self._put(w)

    def _put(self, data: bytes) -> None:
        self.file.write(self.compressor.compress(data))
        self.records += 1
        self.raw += len(data)

    def close(self) -> list[tuple[str, int, int]]:
        """(path, records, bytes before compression) of every archive so far."""
        if self.waiting:
            self._open()
        if self.file is not None:
            self.file.close()
            self.done.append((self.path, self.records, self.raw))
            self.file, self.records, self.raw = None, 0, 0
        return self.done


def records_of(path: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """Head and block of every record of an archive, read as a stream."""
    system, name = fs.FileSystem.from_uri(path)
    with system.open_input_stream(name, compression=None) as f:
        magic, size = struct.unpack("<II", f.read(8))
        if magic != DICTIONARY_FRAME:
            raise ValueError(f"{path} doesn't begin with a dictionary")
        reader = zstd.ZstdDecompressor(dict_data=_dictionary(f.read(size))).stream_reader(f, read_across_frames=True)
        held = bytearray()

        def fill(n: int) -> bool:
            while len(held) < n:
                if not (part := reader.read(max(1 << 20, n - len(held)))):
                    return False
                held.extend(part)
            return True

        while fill(1):
            while (end := held.find(b"\r\n\r\n")) < 0:
                if not fill(len(held) + 1):  # the last head may have less behind it than any fixed step
                    raise ValueError(f"{path} breaks off")
            lines = bytes(held[:end]).decode("utf-8").split("\r\n")[1:]
            head = dict(x.split(": ", 1) for x in lines)
            size = int(head["Content-Length"])
            if not fill(end + 8 + size):
                raise ValueError(f"{path} breaks off")
            block = bytes(held[end + 4:end + 4 + size])
            del held[:end + 8 + size]
            yield head, block


def write(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
          date: str = "1970-01-01T00:00:00Z", archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record per row under ``folder`` and return the stored list of archives (path, records, bytes).

    Of rows with equal payloads of at least 100 bytes, the one with the smallest
    id is a response and the others revisit it; rows that repeat its id are
    responses too, and so are payloads that only rows with null ids have.  A null html is an empty payload.
    """
    payload = F.coalesce(F.encode(F.col(html_col), "UTF-8"), F.lit(b""))
    rows = pages.select(F.col(id_col).alias("page"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    keyed = rows.select("page", F.sha2("payload", 256).alias("digest"), F.length("payload").alias("size"))
    first = keyed.filter(F.col("size") >= LEAST_REVISIT).groupBy("digest").agg(
        F.min("page").alias("first"), F.count("*").alias("n")).filter("n > 1 AND first IS NOT NULL").select("digest", "first")
    first = stored(first, "copies").withColumnRenamed("digest", f"{OWN}digest")
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    # Copies are found by digest and named by row; a group of copies is spread by adaptive execution.
    rows = rows.join(first, F.col("digest") == F.col(f"{OWN}digest"), "left")
    refers = F.when(~F.col("page").eqNullSafe(F.col("first")), F.col("first"))
    rows = rows.select("page", "url", "payload", "digest", refers.alias("refers"))

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = Writer(folder, archive_bytes)
        for b in batches:
            for row in zip(*(b.column(i) for i in range(5)), strict=True):
                page, url, payload, digest, refers = (x.as_py() for x in row)
                writer.add(record(page, url, payload, digest, refers, date))
        done = writer.close()
        yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64()))],
                                         ["path", "records", "bytes"])

    return stored(rows.mapInArrow(archive, "path string, records long, bytes long"), "archives")


def read_back(archives: DataFrame, id_type: str = "long") -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, url, payload) of every record of stored archives.

    Digests of payloads in the archives are computed anew and must agree with
    what is recorded, and so must the number of records.
    """
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for b in batches:
            for path, missing in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for head, block in records_of(path):
                    kind = head["WARC-Type"]
                    if kind == "warcinfo":
                        continue
                    missing -= 1
                    http, payload = block.split(b"\r\n\r\n", 1)
                    digest = head["WARC-Payload-Digest"].removeprefix("sha256:")
                    size = int(http.rsplit(b"Content-Length: ", 1)[1])
                    if kind == "response" and (size != len(payload) or hashlib.sha256(payload).hexdigest() != digest):
                        raise ValueError(f"{path}: a payload doesn't agree with its digest")
                    rows.append((head.get("X-Page-ID"), size, digest, kind, head.get("X-Refers-To-Page-ID"),
                                 head.get("WARC-Target-URI"), payload if kind == "response" else None))
                    held += len(payload)
                    if len(rows) >= 1000 or held >= 8 << 20:
                        yield batch(rows)
                        rows, held = [], 0
                if missing:
                    raise ValueError(f"{path}: {missing} records are missing")
        yield batch(rows)

    types = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.binary())
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "payload"]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)

    # As many tasks as archives: their list is tiny, and adaptive execution would read them all in one.
    paths = archives.select("path", "records").repartition(max(1, archives.count()))
    out = paths.mapInArrow(of, "page_id string, payload_bytes long, payload_digest string, record_type string, "
                               "refers_to string, url string, payload binary")
    return out.withColumn("page_id", F.col("page_id").cast(id_type)).withColumn("refers_to", F.col("refers_to").cast(id_type))


def round_trip(pages: DataFrame, folder: str | None = None, **columns) -> DataFrame:
    """Write ``pages`` (under a fresh shared folder unless one is named) and read the archives back."""
    folder = folder or scratch_path(pages.sparkSession, "warc")
    id_type = dict(pages.dtypes)[columns.get("id_col", "page_id")]
    return read_back(write(pages, folder, **columns), id_type)
