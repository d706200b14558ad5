"""Removal of lines that recur in many documents, by two Bloom filters and exact confirmation.

First pass: each builder task puts the fingerprints of its lines into a pair of filters, for once-seen and twice-seen ones;
the pairs are merged to the filter of lines that were seen twice or more. Second pass: only lines that this filter holds, the
suspected repeats, are shuffled, as SHA-256 of the line's key, for the exact number of documents and the document that keeps
it. Third pass: documents without a suspected line are finished where they are read; the others meet the lines they lose.

The filters' size follows the input up to `most_bits` (32 MB by default); beyond it more lines are suspected and shuffled,
with the same result. Builder tasks are as many as the cluster runs at once, times two.

A null or empty text is one empty line. A null doc_id counts as the smallest id. Rows that share a doc_id are one document.
Repeats of a line within a document count once. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _bloom
from ._scratch import written

BLANK = b" \t\n\x0b\x0c\r"
NO_ID = -(2**63)
SALTS = 16


def keys_of(text: str | None, least: int) -> tuple[list[bytes], list[bytes | None]]:
    """(lines, their keys): None where a key is shorter than `least` code points."""
    lines = (text or "").encode().split(b"\n")
    keys = []
    for line in lines:
        key = line.strip(BLANK).lower() if len(line) >= least else b""
        keys.append(key if len(key) >= least and (key.isascii() or len(key.decode()) >= least) else None)
    return lines, keys


def fingerprint(key: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(key, digest_size=8).digest(), "little")


try:
    from xxhash import xxh3_64_intdigest as fingerprint  # noqa: F811
except ImportError:
    pass


def line_dedup(docs: DataFrame, min_docs: int = 5, min_chars: int = 40, id_col: str = "doc_id", text_col: str = "text", most_bits: int = 28, with_text: bool = False) -> DataFrame:
    """(id_col, n_lines, n_dropped, kept_sha256[, kept]): keys of at least min_chars code points that are found in at least min_docs documents lose all their lines except those in the largest id that holds it."""
    spark = docs.sparkSession
    slim = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.col(text_col).cast("string").alias("text"))
    size = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = _bloom.bits_for(size / 128, most=most_bits)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _bloom.Pair(bits)
        for batch in batches:
            found = [fingerprint(k) for text in batch.column(0) for k in {k for k in keys_of(text.as_py(), min_chars)[1] if k}]
            if found:
                pair.add(np.array(found, np.uint64))
        yield from pair.chunks()

    builders = max(2, 2 * spark.sparkContext.defaultParallelism)
    twice = spark.sparkContext.broadcast(_bloom.merge(slim.select("text").coalesce(builders).mapInArrow(build, _bloom.CHUNKS_SCHEMA), bits))

    def suspected(keys: list[bytes | None]) -> list[bytes]:
        some = list({k for k in keys if k})
        return [k for k, hit in zip(some, _bloom.has(twice.value, np.array([fingerprint(k) for k in some], np.uint64))) if hit] if some else []

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lines = [], []
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for k in suspected(keys_of(text.as_py(), min_chars)[1]):
                    ids.append(i)
                    lines.append(hashlib.sha256(k).digest())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(lines, pa.binary())], ["id", "line"])

    found = written(slim.mapInArrow(suspects, "id long, line binary"), "suspects")
    repeats = found.distinct().groupBy("line").agg(F.count("*").alias("n"), F.max("id").alias("keeper")).filter(F.col("n") >= min_docs)
    salted = repeats.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    lost = found.distinct().withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")).join(salted, ["line", "salt"]).filter("id <> keeper").groupBy("id").agg(F.collect_list("line").alias("lost"))  # at most the lines of a document

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, sha, rest = [], [], []
            for text in batch.column(1):
                text = text.as_py() or ""
                lines, keys = keys_of(text, min_chars)
                hit = bool(suspected(keys))
                n.append(len(lines))
                sha.append(None if hit else hashlib.sha256(text.encode()).hexdigest())
                rest.append(text if hit or with_text else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(sha, pa.string()), pa.array(rest, pa.string())], ["id", "n_lines", "sha", "text"])

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dropped, shas, texts = [], [], []
            for sha, text, gone in zip(batch.column("sha").to_pylist(), batch.column("text").to_pylist(), batch.column("lost").to_pylist()):
                kept, n = text, 0
                if sha is None:
                    gone = set(gone or ())
                    lines, keys = keys_of(text, min_chars)
                    left = [line for line, k in zip(lines, keys) if not (k and gone and hashlib.sha256(k).digest() in gone)]
                    n, kept = len(lines) - len(left), b"\n".join(left).decode()
                    sha = hashlib.sha256(kept.encode()).hexdigest()
                dropped.append(n)
                shas.append(sha)
                texts.append(kept)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("n_lines"), pa.array(dropped, pa.int64()), pa.array(shas, pa.string()), pa.array(texts if with_text else [None] * len(texts), pa.string())], ["id", "n_lines", "n_dropped", "kept_sha256", "kept"])

    out = slim.mapInArrow(first, "id long, n_lines long, sha string, text string").join(lost, "id", "left").mapInArrow(last, "id long, n_lines long, n_dropped long, kept_sha256 string, kept string")
    return out.select(F.when(F.col("id") != NO_ID, F.col("id")).alias(id_col), "n_lines", "n_dropped", "kept_sha256", *(["kept"] if with_text else []))


def op1_line_dedup(spark, sf_dir: str) -> DataFrame:
    return line_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents
), keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines
), repeats AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT l.doc_id, l.line, l.i, r.k IS NOT NULL AND l.doc_id <> r.keeper AS gone FROM keyed l LEFT JOIN repeats r ON l.k = r.k
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
