"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment of words.

Seeds are word n-grams of the test items that chance seldom makes: by the counts of their words over all documents, a text
holds one at a given place with a probability of at most `most_chance`. (Counts of the n-grams themselves would call a seed
common because an item leaked often.) Items with too few such seeds use their rarest, if they have at least
`least_words` words. Shorter items of more than n words are one seed as a whole, however common their words are, so that every exact copy of them is found;
items of at most n words, such as a single common word, are only sought where chance seldom makes them. Each seed that a document shares with an
item proposes a window of the document around the place where the item would lie, as wide to either side as the insertions that
a passing score can afford; the window is aligned with the item by local alignment with gaps. A document is contaminated by an item whose alignment reaches `least_score` of a perfect copy's score, so
edited, cut and paraphrased copies count, too.

Items are taken in blocks of a bounded size against all documents; a block's seeds are sent to the executors. Documents are read
twice for each block, in place: for word counts, and for seeds and alignments. Nothing of them is shuffled but counts of the
items' words and what was found. Alignments run side by side up to `CELLS` cells a row of the matrix, so long items take turns.

Words are compared in lower case without punctuation at their ends. Items without words contaminate nothing; null and empty
texts have no windows. Items that share a text are each reported; rows that share a document's id and an item's id are one row of
the result, with the best score. Rows without an id are told apart by their texts' SHA-256 (column text_sha256, null for rows with an id). decontaminate() judges each row by itself. Empty tables give an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._text import Words, byte_view, sequence_hashes, slices, span_hashes, within

MATCH, MISMATCH, GAP = 2, -1, -1
CELLS = 1 << 21
#: Places of seeds that are held before those that propose the same window are merged.
PLACES = 1 << 20
_PLAIN = np.zeros(256, bool)
_PLAIN[48:58] = _PLAIN[65:91] = _PLAIN[97:123] = _PLAIN[128:] = True


def plain_words(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, fingerprint) of each word's core between its first and last letter or digit; words without one are left out."""
    w = Words(buf, offs)
    core = np.flatnonzero(_PLAIN[buf])
    lo, hi = np.searchsorted(core, w.start), np.searchsorted(core, w.end)
    some = hi > lo
    start, end = core[lo[some]], core[hi[some] - 1] + 1
    return w.doc[some], span_hashes(buf, start, end)


def align(items: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smith-Waterman of each row of items with the same row of windows (fingerprints; 0 and 1 pad them): (best score, end of the alignment in the window)."""
    rows, width = windows.shape
    h = np.zeros((rows, width + 1), np.int32)
    best, end = np.zeros(rows, np.int32), np.zeros(rows, np.int64)
    ramp = np.arange(width + 1, dtype=np.int32) * -GAP
    for i in range(items.shape[1]):
        step = np.where(items[:, i : i + 1] == windows, MATCH, MISMATCH).astype(np.int32)
        t = np.maximum(h + GAP, 0)
        t[:, 1:] = np.maximum(t[:, 1:], h[:, :-1] + step)
        h = np.maximum.accumulate(t + ramp, axis=1) - ramp  # gaps along the window
        top = h.max(1)
        better = top > best
        if better.any():
            end[better] = h[better].argmax(1)
            best[better] = top[better]
    return best, end


class Seeds:
    """Items of a block and the seeds to find them by."""

    def __init__(self, ids: list, texts: list[str]) -> None:
        buf, offs = byte_view(pa.array(texts, pa.string()))
        doc, self.h = plain_words(buf, offs)
        self.ids, self.first = ids, np.searchsorted(doc, np.arange(len(ids) + 1))
        self.length = np.diff(self.first)

    def choose(self, counts: dict[int, int], total: int, n: int, most_chance: float, least_seeds: int, least_words: int) -> None:
        """Sorted fingerprints of the seeds of each length, and the (item, offset) of each."""
        log = np.log10(np.array([(counts.get(int(x), 0) + 1) / (total + 1) for x in self.h.view(np.int64)])) if len(self.h) else np.zeros(0)
        found: dict[int, list] = {}
        for item, (a, b) in enumerate(zip(self.first[:-1], self.first[1:])):
            m = min(n, b - a)
            if n < b - a < least_words:
                found.setdefault(int(b - a), []).append((sequence_hashes(self.h[a:b], b - a)[0], item, 0))
            if m:
                chance = np.convolve(log[a:b], np.ones(m), "valid")
                keep = chance <= np.log10(most_chance)
                if b - a >= least_words:
                    keep[np.argsort(chance, kind="stable")[:least_seeds]] = True
                h = sequence_hashes(self.h[a:b], m)
                found.setdefault(int(m), []).extend((h[i], item, i) for i in np.flatnonzero(keep))
        self.seeds = {}
        for m, rows in found.items():
            h, item, at = (np.array([r[k] for r in rows], t) for k, t in enumerate((np.uint64, np.int64, np.int64)))
            o = np.argsort(h, kind="stable")
            self.seeds[m] = (h[o], item[o], at[o])

    def matches(self, doc: np.ndarray, h: np.ndarray, least_score: float) -> tuple[np.ndarray, ...]:
        """(row, item, score, end) of the best alignment of each row and item that reaches least_score."""
        windows = []
        for m, (seed, item, at) in self.seeds.items():
            ok = np.flatnonzero(within(doc, m))
            g = sequence_hashes(h, m)[ok]
            lo, hi = np.searchsorted(seed, g, "left"), np.searchsorted(seed, g, "right")
            hit = np.flatnonzero(hi > lo)
            many = (hi - lo)[hit]
            for part in np.split(np.arange(len(hit)), np.flatnonzero(np.diff(np.cumsum(many) // PLACES)) + 1):
                n = many[part]
                which = np.repeat(lo[hit[part]], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                place = np.repeat(ok[hit[part]], n)
                row, pad = doc[place], self.length[item[which]] // 3 + 3
                rough = np.column_stack([row, item[which], (place - at[which] - np.searchsorted(doc, row)) // pad])
                windows.append(np.unique(rough, axis=0))  # one window for seeds that agree about the place
        rough = np.unique(np.concatenate(windows), axis=0) if windows else np.zeros((0, 3), np.int64)
        if not len(rough):
            return (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64))
        rows, item = rough[:, 0], rough[:, 1]
        pad = self.length[item] // 3 + 3
        reach = np.ceil(MATCH * self.length[item] * (1 - least_score) / -GAP).astype(np.int64)  # no passing score affords more inserted words
        begin = np.searchsorted(doc, rows) + rough[:, 2] * pad - reach
        stop = np.minimum(begin + self.length[item] + pad + 2 * reach, np.searchsorted(doc, rows, "right"))
        begin = np.maximum(begin, np.searchsorted(doc, rows))
        score, end = np.zeros(len(rows)), np.zeros(len(rows), np.int64)
        order = np.argsort(self.length[item], kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(np.cumsum((stop - begin)[order]) // CELLS)) + 1):
            a, b = self.first[item[part]], self.length[item[part]]
            x = np.zeros((len(part), b.max()), np.uint64)
            inner = np.arange(b.max())[None, :] < b[:, None]
            x[inner] = self.h[(a[:, None] + np.arange(b.max()))[inner]]
            size = stop[part] - begin[part]
            y = np.ones((len(part), size.max()), np.uint64)
            inner = np.arange(size.max())[None, :] < size[:, None]
            y[inner] = h[(begin[part][:, None] + np.arange(size.max()))[inner]]
            best, at = align(x, y)
            score[part] = best / (MATCH * b)
            end[part] = begin[part] - np.searchsorted(doc, rows[part]) + at
        o = np.lexsort((end, -score, item, rows))
        o = o[score[o] >= least_score]
        lead = np.ones(len(o), bool)
        lead[1:] = (rows[o][1:] != rows[o][:-1]) | (item[o][1:] != item[o][:-1])
        o = o[lead]
        return rows[o], item[o], score[o], end[o]


def blocks(docs: DataFrame, bench: DataFrame, n: int, most_chance: float, least_seeds: int, least_words: int, block_mb: int) -> Iterator:
    """Broadcast Seeds of each block of items. Their number is the items' size over block_mb."""
    spark = docs.sparkSession
    items = bench.select("item_id", F.col("text").cast("string").alias("text")).filter("text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    many = max(1, -(-size // (block_mb << 20)))
    for b in range(many):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(many)) == b).orderBy("item_id", "text").collect()
        seeds = Seeds([r["item_id"] for r in rows], [r["text"] for r in rows])
        words = np.unique(seeds.h)
        shared = spark.sparkContext.broadcast(words)

        def count(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            words, total = shared.value, 0
            n = np.zeros(len(words) + 1, np.int64)
            for batch in batches:
                for lo, hi in slices(batch.column(0)):
                    h = plain_words(*byte_view(batch.column(0)[lo:hi]))[1]
                    total += len(h)
                    if len(words):
                        at = np.searchsorted(words, h)
                        at[(at == len(words)) | (words[np.minimum(at, len(words) - 1)] != h)] = len(words)
                        n += np.bincount(at, minlength=len(words) + 1)
            some = np.flatnonzero(n[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(np.append(words[some].view(np.int64), -1)), pa.array(np.append(n[some], total)), pa.array(np.append(np.zeros(len(some), bool), True))], ["h", "n", "all"])

        sums = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "h long, n long, all boolean").groupBy("h", "all").agg(F.sum("n").alias("n")).collect()  # at most the block's distinct words
        seeds.choose({r["h"]: r["n"] for r in sums if not r["all"]}, sum(r["n"] for r in sums if r["all"]), n, most_chance, least_seeds, least_words)
        yield spark.sparkContext.broadcast(seeds)


def contaminated(docs: DataFrame, bench: DataFrame, n: int = 3, most_chance: float = 1e-7, least_seeds: int = 8, least_score: float = 0.5, least_words: int = 8, block_mb: int = 8) -> DataFrame:
    """(doc_id, item_id, score, doc_end, text_sha256): every document and item that it holds a copy of; score: 1 for an exact copy; doc_end: number of words of the document up to the copy's end."""
    text = F.col("text").cast("string")
    slim = docs.select("doc_id", text.alias("text"), F.when(F.col("doc_id").isNull(), F.sha2(text.cast("binary"), 256)).alias("text_sha256"))
    kind = dict(bench.dtypes)["item_id"]
    out = None
    for shared in blocks(docs, bench, n, most_chance, least_seeds, least_words, block_mb):

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            seeds = shared.value
            for batch in batches:
                for lo, hi in slices(batch.column(1)):
                    row, item, score, end = seeds.matches(*plain_words(*byte_view(batch.column(1)[lo:hi])), least_score)
                    yield pa.RecordBatch.from_arrays([batch.column(0)[lo:hi].take(pa.array(row)), pa.array([seeds.ids[i] for i in item]).cast(pa.int64() if kind != "string" else pa.string()), pa.array(score), pa.array(end), batch.column(2)[lo:hi].take(pa.array(row))], ["doc_id", "item_id", "score", "doc_end", "text_sha256"])

        found = slim.mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, item_id {'bigint' if kind != 'string' else kind}, score double, doc_end long, text_sha256 string")
        out = found if out is None else out.unionAll(found)
    best = F.max(F.struct("score", (-F.col("doc_end")).alias("before")))
    return out.groupBy("doc_id", "text_sha256", "item_id").agg(best.alias("b")).select("doc_id", "item_id", "b.score", (-F.col("b.before")).alias("doc_end"), "text_sha256")


def decontaminate(docs: DataFrame, bench: DataFrame, n: int = 3, most_chance: float = 1e-7, least_seeds: int = 8, least_score: float = 0.5, least_words: int = 8, block_mb: int = 8) -> DataFrame:
    """The rows of docs that hold no item's copy, with all their columns; nothing is shuffled."""
    at = docs.columns.index("text")
    for shared in blocks(docs, bench, n, most_chance, least_seeds, least_words, block_mb):

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            seeds = shared.value
            for batch in batches:
                for lo, hi in slices(batch.column(at)):
                    keep = np.ones(hi - lo, bool)
                    keep[seeds.matches(*plain_words(*byte_view(batch.column(at)[lo:hi])), least_score)[0]] = False
                    yield batch.slice(lo, hi - lo).filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def op3_decontamination(spark, sf_dir: str) -> DataFrame:
    return contaminated(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
