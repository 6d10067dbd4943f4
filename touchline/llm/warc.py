"""WARC archives with a Zstandard dictionary.

Writer: every task writes archives ``*.warc.zst``. Each begins with a skippable frame
(magic 0x184D2A5D) that embeds a dictionary trained on the first records of that archive,
and then holds one compressed frame per record, so a record can be read without the
ones before it. Equal payloads of at least ``min_revisit`` bytes are written once: the row with
the smallest id is the response, the others are revisit records that refer to it.

Reader: streams the frames of each archive, checks every response against its digest and
length, and returns one row per record.

Archives live in the shared work folder, opened through ``pyarrow.fs`` by URI. A task
writes files of unique names and reports them as rows; only rows of tasks that Spark
committed are read, so a lost executor or a repeated task leaves no wrong record.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.tables import mapped, run_folder, slices, stored

DICT_MAGIC = 0x184D2A5D
SALTS = 64


def open_fs(uri: str):
    """(file system, path) of a URI or plain path."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:")
                                  else f"file://{uri}")


def classify(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
             html_col: str = "html", min_revisit: int = 100) -> DataFrame:
    """Rows page_id, url, payload (binary), payload_bytes, digest, refers_to.

    ``refers_to`` is null for responses. Rows that share the smallest id are all responses.
    """
    rows = (pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                         F.coalesce(F.col(html_col), F.lit("")).cast("binary").alias("payload"))
            .withColumn("digest", F.unhex(F.sha2("payload", 256)))
            .withColumn("payload_bytes", F.octet_length("payload").cast("long")))
    # Only payloads held by several rows need a look-up; each is repeated once per salt,
    # so the copies of one payload are spread over many tasks.
    shared = (rows.where(F.col("payload_bytes") >= min_revisit).groupBy("digest")
              .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
              .where("n > 1").select("digest", "first_id",
                                     F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    return (salted.join(shared, ["digest", "salt"], "left")
            .select("page_id", "url", "payload", "payload_bytes", "digest",
                    F.when(F.col("page_id") != F.col("first_id"), F.col("first_id")).alias("refers_to")))


def record_bytes(page_id, url, payload: bytes, n_bytes: int, digest: str, refers_to) -> bytes:
    """One WARC/1.1 record: a response with its HTTP message, or a revisit without payload."""
    kind = "response" if refers_to is None else "revisit"
    head = [f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id} {url}')}>",
            f"WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha256:{digest}",
            f"X-Payload-Length: {n_bytes}", "Content-Type: application/http; msgtype=response"]
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    if refers_to is None:
        block += payload
    else:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"X-Refers-To-Page: {refers_to}"]
    head.append(f"Content-Length: {len(block)}")
    return ("WARC/1.1\r\n" + "\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """Headers (lower-case names) and the payload of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    out = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
    block = rest[:int(out["content-length"])]
    out["payload"] = block.partition(b"\r\n\r\n")[2]
    return out


def train(samples: list[bytes], size: int):
    """A dictionary from the samples, or an empty one where they are too few to train on."""
    try:
        return zstandard.train_dictionary(size, samples, k=512, d=8)
    except zstandard.ZstdError:
        return None


class ArchiveWriter:
    """Writes one archive; records wait until the dictionary can be trained."""

    def __init__(self, folder: str, dict_bytes: int, sample_bytes: int, level: int):
        self.path = f"{folder}/{uuid.uuid4().hex}.warc.zst"
        self.dict_bytes, self.sample_bytes, self.level = dict_bytes, sample_bytes, level
        self.waiting: list[bytes] = []
        self.waiting_bytes = self.raw = self.records = 0
        self.out = self.packer = None

    def add(self, record: bytes) -> None:
        self.raw += len(record)
        self.records += 1
        if self.packer is None:
            self.waiting.append(record)
            self.waiting_bytes += len(record)
            if self.waiting_bytes >= self.sample_bytes:
                self._open()
        else:
            self.out.write(self.packer.compress(record))

    def _open(self) -> None:
        fs, path = open_fs(self.path)
        fs.create_dir(path.rpartition("/")[0], recursive=True)
        self.out = fs.open_output_stream(path)
        trained = train(self.waiting, self.dict_bytes)
        body = trained.as_bytes() if trained else b""
        self.out.write(struct.pack("<II", DICT_MAGIC, len(body)) + body)
        self.packer = zstandard.ZstdCompressor(level=self.level, dict_data=trained)
        for record in self.waiting:
            self.out.write(self.packer.compress(record))
        self.waiting = []

    def close(self) -> tuple[str, int]:
        if self.packer is None:
            self._open()
        self.out.close()
        return self.path, self.records


def read_archive(uri: str, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The records of one archive, a chunk at a time."""
    fs, path = open_fs(uri)
    with fs.open_input_stream(path) as f:
        magic, n = struct.unpack("<II", f.read(8))
        if magic != DICT_MAGIC:
            raise ValueError(f"{uri} has no leading dictionary frame")
        body = f.read(n)
        trained = zstandard.ZstdCompressionDict(body) if body else None
        unpacker = zstandard.ZstdDecompressor(dict_data=trained)
        frame, parts, pending = unpacker.decompressobj(), [], b""
        while data := pending or f.read(chunk):
            parts.append(frame.decompress(data))
            pending = frame.unused_data
            if frame.eof:
                yield b"".join(parts)
                frame, parts = unpacker.decompressobj(), []
            else:
                pending = b""
        if parts:
            raise ValueError(f"{uri} ends inside a record")


def write_archives(records: DataFrame, folder: str, archive_bytes: int = 64 << 20,
                   dict_bytes: int = 32 << 10, sample_bytes: int = 4 << 20,
                   level: int = 3) -> DataFrame:
    """Archive ``classify`` rows; returns the stored manifest (path, n_records).

    ``sample_bytes`` bounds what one dictionary is trained on: the first records of each
    archive; ``archive_bytes`` is where a task starts its next archive.
    """
    def write(batches):
        writer = None
        for batch in slices(batches):
            for r in batch.to_pylist():
                if writer is None:
                    writer = ArchiveWriter(folder, dict_bytes, sample_bytes, level)
                writer.add(record_bytes(r["page_id"], r["url"], r["payload"], r["payload_bytes"],
                                        r["digest"].hex(), r["refers_to"]))
                if writer.raw >= archive_bytes:
                    yield _manifest(writer.close())
                    writer = None
        if writer is not None:
            yield _manifest(writer.close())

    return stored(mapped(records, write, "path string, n_records long"), "warc-manifest")


def _manifest(row: tuple[str, int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"path": [row[0]], "n_records": pa.array([row[1]], pa.int64())})


READ_SCHEMA = ("page_id long, payload_bytes long, payload_digest string, record_type string, "
               "refers_to long, record_id string, target_uri string")


def read_archives(manifest: DataFrame) -> DataFrame:
    """One row per record of the archives; raises if a response's payload doesn't fit its
    digest or length, or if an archive has lost records."""
    names = [x.split()[0] for x in READ_SCHEMA.split(", ")]

    def read(batches):
        for batch in batches:
            for entry in batch.to_pylist():
                rows, found = [], 0
                for data in read_archive(entry["path"]):
                    r, found = parse_record(data), found + 1
                    digest = r["warc-payload-digest"].removeprefix("sha256:")
                    n = int(r["x-payload-length"])
                    if r["warc-type"] == "response":
                        if len(r["payload"]) != n or hashlib.sha256(r["payload"]).hexdigest() != digest:
                            raise ValueError(f"damaged record in {entry['path']}")
                    page, ref = r.get("x-page-id"), r.get("x-refers-to-page")
                    rows.append((None if page is None else int(page), n, digest, r["warc-type"],
                                 None if ref is None else int(ref), r["warc-record-id"],
                                 r.get("warc-target-uri")))
                    if len(rows) == 5000:
                        yield _rows(names, rows)
                        rows = []
                if found != entry["n_records"]:
                    raise ValueError(f"{entry['path']}: {found} of {entry['n_records']} records")
                if rows:
                    yield _rows(names, rows)

    n = manifest.count()
    spread = manifest.repartition(max(1, n)) if n else manifest
    return mapped(spread, read, READ_SCHEMA)


def _rows(names: list[str], rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)


def archive_roundtrip(pages: DataFrame, **names) -> DataFrame:
    """Write an archive record per page, read the archives back: a row per record.

    Defined cases: null html is an empty payload; a null page_id or url leaves the header
    out and reads back as null (a null page_id among equal payloads is a response); pages that repeat the
    smallest id of their payload are all responses; an empty table writes no archive.
    """
    folder = run_folder(pages.sparkSession, "warc")
    return read_archives(write_archives(classify(pages, **names), folder))


ORACLE = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (
  SELECT *, CASE WHEN payload_bytes >= 100
                 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first_id
  FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first_id = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM f
"""
