"""WARC archives with a Zstandard dictionary: written, and read back.

Each writer task gathers records to archives of about `archive_mb`; for each it builds a dictionary from a sample of its records (every
n-th, so that there are about 2,000, and 64 KiB of each; records themselves are written whole), puts it
into a leading skippable frame (magic 0x184D2A5D) and compresses every record as a frame of its own, so that any record can be
read by offset. Records with equal payloads of `least_bytes` or more are written once: that of the largest page_id is the
response, the others are revisit records without a payload that refer to it.

Archives go to the shared folder under names of their own for each attempt; the table of archives that the write returns lists
those of successful tasks only, so a lost executor leaves unread files at most. The reader works from that table.

A null html is an empty payload. Rows that share the keeper's page_id and payload are all responses; a null page_id is written
as such and counts as the smallest. Empty table: no archives, empty result. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._scratch import filesystem, new_path, written

SKIPPABLE = 0x184D2A5D
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SCHEMA = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _uri(page_id: int | None) -> str:
    return f"<urn:x-page:{'null' if page_id is None else page_id}>"


def _page(uri: str) -> int | None:
    tail = uri.strip("<>").rsplit(":", 1)[1]
    return None if tail == "null" else int(tail)


def record(page_id: int | None, url: str | None, payload: bytes | None, size: int, digest: str, keeper: int | None, keeper_url: str | None, date: str) -> bytes:
    """A response record, or a revisit record where payload is None. digest: hexadecimal SHA-1 of the whole payload."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode() + (payload or b"")
    clean = lambda s: "".join(s.split()) if s else "about:blank"
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if payload is None else 'response'}", f"WARC-Record-ID: {_uri(page_id)}", f"WARC-Date: {date}", f"WARC-Target-URI: {clean(url)}", f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}"]
    if payload is None:
        head += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: {_uri(keeper)}", f"WARC-Refers-To-Target-URI: {clean(keeper_url)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def archive(records: list[bytes], dict_kb: int = 64, level: int = 6) -> tuple[bytes, list[int]]:
    """(archive, offset of each record)."""
    size = min(dict_kb << 10, sum(map(len, records)) // 8)
    step = max(1, len(records) // 2000)
    samples = [r[: 64 << 10] for r in records[::step]]
    dictionary = None
    if size >= 1024 and len(samples) >= 8:
        try:
            dictionary = zstandard.train_dictionary(size, samples)
        except zstandard.ZstdError:  # too little in common
            dictionary = None
    if dictionary is None:
        dictionary = zstandard.ZstdCompressionDict(b"".join(samples)[: max(size, 256)], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    raw = dictionary.as_bytes()
    out = io.BytesIO()
    out.write(struct.pack("<II", SKIPPABLE, len(raw)) + raw)
    to = zstandard.ZstdCompressor(level=level, dict_data=dictionary, write_content_size=True)
    offsets = []
    for r in records:
        offsets.append(out.tell())
        out.write(to.compress(r))
    return out.getvalue(), offsets


def _dictionary(head: bytes) -> zstandard.ZstdCompressionDict:
    full = head[:4] == b"\x37\xa4\x30\xec"
    return zstandard.ZstdCompressionDict(head, dict_type=zstandard.DICT_TYPE_FULLDICT if full else zstandard.DICT_TYPE_RAWCONTENT)


def read_records(source) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of an archive, read as a stream."""
    magic, size = struct.unpack("<II", source.read(8))
    if magic != SKIPPABLE:
        raise ValueError("no dictionary frame")
    reader = io.BufferedReader(zstandard.ZstdDecompressor(dict_data=_dictionary(source.read(size))).stream_reader(source, read_across_frames=True), 1 << 20)
    while version := reader.readline():
        if not version.startswith(b"WARC/"):
            raise ValueError(f"not a record: {version[:40]!r}")
        headers = {}
        while line := reader.readline().rstrip(b"\r\n"):
            name, _, value = line.decode().partition(":")
            headers[name.strip().lower()] = value.strip()
        block = reader.read(int(headers["content-length"]))
        reader.read(4)
        yield headers, block


def read_record(data: bytes, offset: int) -> bytes:
    """One record by its offset."""
    _, size = struct.unpack("<II", data[:8])
    return zstandard.ZstdDecompressor(dict_data=_dictionary(data[8 : 8 + size])).decompressobj().decompress(data[offset:])


def figures(headers: dict[str, str], block: bytes) -> tuple:
    """A row of SCHEMA from a record that was read."""
    head, _, payload = block.partition(b"\r\n\r\n")
    if headers["warc-type"] == "revisit":
        size = next(int(x.split(b":")[1]) for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:"))
        digest = base64.b32decode(headers["warc-payload-digest"].removeprefix("sha1:")).hex()
        return _page(headers["warc-record-id"]), size, digest, "revisit", _page(headers["warc-refers-to"])
    return _page(headers["warc-record-id"]), len(payload), hashlib.sha1(payload).hexdigest(), "response", None


def write(pages: DataFrame, folder: str, least_bytes: int = 1000, archive_mb: int = 16, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Writes archives into folder; returns (path, records, bytes)."""
    slim = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    slim = slim.withColumn("digest", F.sha1(F.col("html").cast("binary"))).withColumn("size", F.octet_length("html").cast("long"))
    same = slim.filter(F.col("size") >= least_bytes).groupBy("digest", "size").agg(F.max(F.struct("page_id", "url")).alias("k"), F.count("*").alias("n")).filter("n > 1").select("digest", "size", F.col("k.page_id").alias("keeper"), F.col("k.url").alias("keeper_url"), "n")
    same = written(same, "payloads")
    often = F.col("n") * 1000 > pages.count()  # holds for at most 999 payloads: their revisits lose the text where it is read
    hot = same.filter(often).select("digest", "size", F.col("keeper").alias("hot_keeper"), F.col("keeper_url").alias("hot_url"), F.lit(True).alias("hot"))
    first = slim.join(F.broadcast(hot), ["digest", "size"], "left").withColumn("html", F.when(F.coalesce(~F.col("hot"), F.lit(True)) | F.col("page_id").eqNullSafe(F.col("hot_keeper")), F.col("html")))
    # rows that are settled already are dealt out evenly, not by their payload
    first = first.withColumn("meet", F.when(F.col("hot"), F.concat(F.lit("-"), F.xxhash64("page_id", "url", F.spark_partition_id()).cast("string"))).otherwise(F.col("digest")))
    rest = same.filter(~often).select(F.col("digest").alias("meet"), "size", "keeper", "keeper_url", F.lit(True).alias("again"))
    joined = first.join(rest, ["meet", "size"], "left")
    revisit = F.coalesce(F.col("again") & ~F.col("page_id").eqNullSafe(F.col("keeper")), F.lit(False))
    marked = joined.select("page_id", "url", F.when(~revisit, F.col("html")).alias("html"), "digest", "size", F.coalesce("hot_keeper", "keeper").alias("keeper"), F.coalesce("hot_url", "keeper_url").alias("keeper_url"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = filesystem(folder)
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            data, _ = archive(held)
            fs.create_dir(base, recursive=True)
            path = f"{base}/{uuid.uuid4().hex}.warc.zst"
            with fs.open_output_stream(path, compression=None) as out:
                out.write(data)
            return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([len(held)], pa.int64()), pa.array([len(data)], pa.int64())], ["path", "records", "bytes"])

        for batch in batches:
            columns = [batch.column(i) for i in range(7)]
            for i in range(batch.num_rows):
                page_id, url, html, digest, n, keeper, keeper_url = (c[i].as_py() for c in columns)
                held.append(record(page_id, url, None if html is None else html.encode(), n, digest, keeper, keeper_url, date))
                size += len(held[-1])
                if size >= archive_mb << 20:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return written(marked.mapInArrow(run, "path string, records long, bytes long"), "archives")


def read(archives: DataFrame, folder: str) -> DataFrame:
    """SCHEMA of every record of the archives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = filesystem(folder)
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows = []
                with fs.open_input_stream(path, compression=None) as source:
                    for headers, block in read_records(source):
                        rows.append(figures(headers, block))
                        if len(rows) == 10_000:
                            yield _batch(rows)
                            rows = []
                if rows:
                    yield _batch(rows)

    return archives.repartition(F.col("path")).mapInArrow(run, SCHEMA)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], [x.split()[0] for x in SCHEMA.split(", ")])


def op8_warc(spark, sf_dir: str) -> DataFrame:
    folder = new_path(spark, "warc")
    return read(write(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder), folder)


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS payload_digest, max(page_id) OVER (PARTITION BY html) AS keeper FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 1000 AND page_id <> keeper THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> keeper THEN keeper END AS refers_to FROM d
"""
