"""Hard negatives by exact inner products, most of which are never finished.

Vectors become whole numbers and are turned by an orthogonal rotation, the principal axes of a bounded sample, so that the leading
components carry most of a product. Partial products over them are accumulated level by level; what the rest can add is at most the
product of the residual norms, and with some slack for rounding a pair that can't reach its anchor's threshold, or is sure to
exceed its ceiling, is discarded. What survives is verified by whole-number products, so the sample decides the time and nothing else.

Anchors are a stated set of the rows. They are sent to the tasks in passes of at most `pass_bytes`; in a pass the table is read twice, for the
positives and for the negatives below them. A task keeps each anchor's best of the rows it has read, whose last is the
threshold; the tasks' lists meet by anchor (by anchor and positive), a few rows from each task.

Rows with a null label, a null vector or any null or non-finite component take no part. Shorter vectors are filled up with zeros. A
null id comes after all others among ties and is no anchor. Repeated rows each take part: an anchor leaves out itself alone, and
repeated anchors have results of their own. Without anchors, positives or negatives nothing is returned. Scores that 64 bits can't hold raise an error.
Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._scratch import new_path

#: Rows of which the rotation is learned, about; anchors and rows compared at once.
FIT_ROWS, TILE, SLICE = 20_000, 256, 2048
#: Of the norms' product: far over what rounding adds to sums of 64-bit floats.
SLACK = 1e-9
EXACT = float(1 << 53)
#: Rows that a task is to read at least, so that few lists meet.
ROWS_A_TASK = 1_000_000


def whole(column: pa.Array, d: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(which rows take part, their vectors as whole numbers in 64-bit floats, filled up with zeros to d components)."""
    flat = column.flatten()
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(lengths)
    values = pc.fill_null(flat.cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False)
    faults = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    taken = (faults[ends] == faults[ends - lengths]) & ~column.is_null().to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(taken)
    out = np.zeros((len(rows), d))
    for n in np.unique(lengths[rows]):
        at = np.flatnonzero(lengths[rows] == n)
        out[at, :n] = np.floor(scale * values[(ends - lengths)[rows[at]][:, None] + np.arange(n)])
    return rows, out


class Vectors:
    """Rows with their numbers, turned vectors and what is left of their norms past each level."""

    def __init__(self, batch: pa.RecordBatch, d: int, scale: int, rotation: np.ndarray, levels: list[int]) -> None:
        rows, self.x = whole(batch.column("v"), d, scale)
        ids = batch.column("id").take(pa.array(rows))
        self.unnamed = ids.is_null().to_numpy(zero_copy_only=False)
        self.id = pc.fill_null(ids, 0).to_numpy(zero_copy_only=False).astype(np.int64)
        self.label = batch.column("label").take(pa.array(rows)).to_numpy(zero_copy_only=False).astype(np.int64)
        self.turned = self.x @ rotation
        squares = np.cumsum((self.turned**2)[:, ::-1], axis=1)[:, ::-1]
        self.rest = np.stack([np.sqrt(squares[:, k]) if k < d else np.zeros(len(rows)) for k in [0, *levels]], axis=1)
        self.most = float(np.abs(self.x).max()) if self.x.size else 0.0


def products(a: Vectors, i: np.ndarray, x: Vectors, j: np.ndarray) -> np.ndarray:
    """Whole-number products of the pairs (i, j)."""
    if a.x.shape[1] * a.most * x.most < EXACT:
        return np.einsum("ij,ij->i", a.x[i].astype(np.int64), x.x[j].astype(np.int64))
    out = [sum(int(p) * int(q) for p, q in zip(a.x[m], x.x[n])) for m, n in zip(i, j)]
    if any(not -(2**63) <= s < 2**63 for s in out):
        raise OverflowError("a score doesn't fit into 64 bits")
    return np.array(out, np.int64)


def survivors(a: Vectors, i: np.ndarray, x: Vectors, j: np.ndarray, low: np.ndarray, high: np.ndarray, levels: list[int], fit: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, row, score) of the pairs of anchors i and rows j whose score is in [low, high] of the anchor; fit: the pairs that count at all."""
    done, at = 0, 0
    part, alive = np.zeros((len(i), len(j))), np.ones((len(i), len(j)), bool) if fit is None else fit
    for at, k in enumerate(levels, 1):  # whole tiles, as long as much of them is alive
        part += a.turned[i, done:k] @ x.turned[j, done:k].T
        rest = np.outer(a.rest[i, at], x.rest[j, at]) + SLACK * np.outer(a.rest[i, 0], x.rest[j, 0]) + SLACK
        alive &= (part + rest >= low[:, None]) & (part - rest <= high[:, None])
        done = k
        if alive.mean() < 0.1:
            break
    m, n = np.nonzero(alive)
    part = part[m, n]
    for at, k in enumerate(levels[at:], at + 1):  # then pair by pair
        if not len(m):
            break
        part += np.einsum("ij,ij->i", a.turned[i[m], done:k], x.turned[j[n], done:k])
        rest = a.rest[i[m], at] * x.rest[j[n], at] + SLACK * a.rest[i[m], 0] * x.rest[j[n], 0] + SLACK
        keep = (part + rest >= low[m]) & (part - rest <= high[m])
        m, n, part, done = m[keep], n[keep], part[keep], k
    score = products(a, i[m], x, j[n])
    keep = (score >= low[m]) & (score <= high[m])
    return i[m[keep]], j[n[keep]], score[keep]


class Best:
    """The first `most` rows of each slot by score, then id."""

    def __init__(self, most: int) -> None:
        self.most = most
        self.slot = self.score = self.id = np.zeros(0, np.int64)
        self.unnamed = np.zeros(0, bool)

    def add(self, slot: np.ndarray, score: np.ndarray, x: Vectors, j: np.ndarray) -> None:
        slot, score, id_, unnamed = (np.concatenate(p) for p in ((self.slot, slot), (self.score, score), (self.id, x.id[j]), (self.unnamed, x.unnamed[j])))
        order = np.lexsort((id_, unnamed, ~score, slot))  # ~s falls as s rises, and never overflows
        slot = slot[order]
        rank = np.arange(len(slot)) - np.searchsorted(slot, slot)
        order = order[rank < self.most]
        self.slot, self.score, self.id, self.unnamed = slot[rank < self.most], score[order], id_[order], unnamed[order]

    def last(self, first: int, n: int, floor: np.ndarray) -> np.ndarray:
        """Scores that rows have to reach in slots first to first + n: those of full lists' last rows, else the floor."""
        out = floor.copy()
        full = np.searchsorted(self.slot, np.arange(first, first + n), "right") - np.searchsorted(self.slot, np.arange(first, first + n)) == self.most
        ends = np.searchsorted(self.slot, np.arange(first, first + n), "right")[full] - 1
        out[full] = np.maximum(out[full], self.score[ends])
        return out

    def batch(self) -> pa.RecordBatch:
        return pa.record_batch({"slot": self.slot, "score": self.score, "id": pa.array(self.id, mask=self.unnamed)})


FOUND = "slot long, score long, id long"
LEAST = np.iinfo(np.int64).min


def positives(a: Vectors, most: int, levels: list[int], read: Callable) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task's first rows of each anchor's label; the anchor's place is the slot."""

    def run(batches):
        best = {}
        by = {label: np.flatnonzero(a.label == label) for label in np.unique(a.label).tolist()}
        for x in read(batches):
            order = np.argsort(x.label, kind="stable")
            labels, begins = np.unique(x.label[order], return_index=True)
            for label, rows in zip(labels.tolist(), np.split(order, begins[1:])):
                for lo in range(0, len(by.get(label, ())), TILE):
                    i = by[label][lo : lo + TILE]
                    kept = best.setdefault((label, lo), Best(most))
                    m, j, score = survivors(a, i, x, rows, kept.last(0, len(i), np.full(len(i), LEAST)), np.full(len(i), np.iinfo(np.int64).max), levels)
                    kept.add(np.searchsorted(i, m), score, x, j)
        for (label, lo), kept in best.items():
            kept.slot = by[label][lo : lo + TILE][kept.slot]
            yield kept.batch()

    return run


def below(a: Vectors, lows: np.ndarray, highs: np.ndarray, most: int, levels: list[int], read: Callable) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task's first rows of another label for each anchor i and positive k with scores in [lows, highs][i, k]; i * width + k is the slot. Where there is no positive, low is over high."""
    width = lows.shape[1]

    def run(batches):
        best = [Best(most) for _ in range(0, len(a.id), TILE)]
        for x in read(batches):
            for kept, lo in zip(best, range(0, len(a.id), TILE)):
                i = np.arange(lo, min(lo + TILE, len(a.id)))
                low = kept.last(lo * width, len(i) * width, lows[i].reshape(-1)).reshape(len(i), width)
                live = low <= highs[i]
                least = np.where(live, low, np.iinfo(np.int64).max).min(axis=1)
                highest = np.where(live, highs[i], LEAST).max(axis=1)
                m, j, score = survivors(a, i, x, np.arange(len(x.id)), least, highest, levels, a.label[i][:, None] != x.label[None, :])
                pair, k = np.nonzero((score[:, None] >= low[m - lo]) & (score[:, None] <= highs[m]))
                kept.add(m[pair] * width + k, score[pair], x, j[pair])
        for kept in best:
            yield kept.batch()

    return run


def _moments(d: int, scale: int):
    def run(batches):
        total = np.zeros((d, d))
        for b in batches:
            x = whole(b.column("v"), d, scale)[1]
            x /= max(1.0, np.abs(x).max(initial=0))
            total += x.T @ x
        yield pa.record_batch({"m": pa.array([total.tobytes()], pa.binary())})

    return run


def rotation(rows: DataFrame, d: int, scale: int, count: int) -> np.ndarray:
    """The principal axes of about FIT_ROWS rows, first those of most weight: bounded by them and d * d, whatever the table."""
    part = rows.filter(F.pmod(F.xxhash64("id", "v"), F.lit(1 << 30)) < int(min(1.0, FIT_ROWS / max(1, count)) * (1 << 30)))
    m = np.frombuffer(part.repartition(1).mapInArrow(_moments(d, scale), "m binary").first()["m"]).reshape(d, d)
    return np.linalg.eigh(m)[1][:, ::-1].copy()


def hard_negatives(rows: DataFrame, anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label: Column | str = "label", positives_each: int = 5, negatives_each: int = 5, low: int = 80, scale: int = 256, pass_bytes: int = 1 << 24) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): of each anchor (a row where `anchor` is true), its positives_each first other rows of its label, and for each of these the negatives_each first rows of other labels with low % to 100 % of the positive's score."""
    spark = rows.sparkSession
    rows = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"), (F.col(label) if isinstance(label, str) else label).cast("long").alias("label"), F.coalesce(anchor, F.lit(False)).alias("chosen")).filter("label IS NOT NULL AND v IS NOT NULL")
    counts = rows.agg(F.count("*").alias("n"), F.count_if("chosen").alias("anchors"), F.coalesce(F.max(F.size("v")), F.lit(0)).alias("d")).first()
    d = max(1, counts["d"])
    axes = rotation(rows, d, scale, counts["n"])
    levels = sorted({max(1, d // 8), max(1, d // 4), max(1, d // 2), d})
    passes = max(1, -(-counts["anchors"] * d * 24 // pass_bytes))
    path = new_path(spark, "negatives")
    found = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    found.write.parquet(path)
    reading = rows.select("id", "label", "v").coalesce(max(spark.sparkContext.defaultParallelism, -(-counts["n"] // ROWS_A_TASK)))

    for p in range(passes if counts["anchors"] else 0):
        here = rows.filter("chosen").filter(F.pmod(F.xxhash64("id"), F.lit(passes)) == p).select("id", "label", "v").toArrow().combine_chunks()  # about pass_bytes / 3
        if not here.num_rows:
            continue
        a = Vectors(here.to_batches()[0], d, scale, axes, levels)
        shared = spark.sparkContext.broadcast((a, axes))

        def read(batches, shared=shared):
            for b in batches:
                for lo in range(0, b.num_rows, SLICE):
                    yield Vectors(b.slice(lo, SLICE), d, scale, shared.value[1], levels)

        def first(batches, shared=shared, read=read):
            yield from positives(shared.value[0], positives_each + 1, levels, read)(batches)

        merged = reading.mapInArrow(first, FOUND)
        order = [F.desc("score"), F.asc_nulls_last("id")]
        merged = merged.withColumn("r", F.row_number().over(W.partitionBy("slot").orderBy(*order))).filter(F.col("r") <= positives_each + 1)
        best = merged.toArrow()  # a few rows an anchor of the pass
        lows, highs, ids = _ladders(a, best, positives_each, low)
        wanted = spark.sparkContext.broadcast((lows, highs))

        def second(batches, shared=shared, wanted=wanted, read=read):
            yield from below(shared.value[0], *wanted.value, negatives_each, levels, read)(batches)

        under = reading.mapInArrow(second, FOUND).withColumn("rank", F.row_number().over(W.partitionBy("slot").orderBy(*order))).filter(F.col("rank") <= negatives_each)
        slots = np.flatnonzero((lows <= highs).reshape(-1))
        if len(slots):
            named = pa.table({"slot": slots, "anchor_id": a.id[slots // positives_each], "positive_id": ids.take(pa.array(slots)), "positive_score": highs.reshape(-1)[slots]})
            out = under.join(F.broadcast(spark.createDataFrame(named)), "slot")  # rows of a pass
            out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")).write.mode("append").parquet(path)
        shared.unpersist()
        wanted.unpersist()
    return spark.read.schema(found.schema).parquet(path)


def _ladders(a: Vectors, best: pa.Table, most: int, low: int) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(lows, highs) of each anchor and positive, and the positives' ids in the same order. An anchor itself leaves its list once."""
    slot, score, r = (best.column(c).to_numpy() for c in ("slot", "score", "r"))
    ids = best.column("id").combine_chunks()
    known = pc.fill_null(ids, 0).to_numpy(zero_copy_only=False)
    own = products(a, np.arange(len(a.id)), a, np.arange(len(a.id)))
    order = np.lexsort((r, slot))
    slot, score, known, null = slot[order], score[order], known[order], ids.is_null().to_numpy(zero_copy_only=False)[order]
    itself = (known == a.id[slot]) & ~null & (score == own[slot])
    at = np.flatnonzero(itself)
    once = at[np.unique(slot[at], return_index=True)[1]]
    keep = np.ones(len(slot), bool)
    keep[once] = False
    slot, score, known, null = slot[keep], score[keep], known[keep], null[keep]
    rank = np.arange(len(slot)) - np.searchsorted(slot, slot)
    keep = rank < most
    places = slot[keep] * most + rank[keep]
    lows, highs = np.zeros(len(a.id) * most, np.int64), np.full(len(a.id) * most, -1, np.int64)
    highs[places] = score[keep]
    lows[places] = [int(s) + -(int(s) * (100 - low) // 100) for s in score[keep]]  # the least n with 100 * n >= low * s
    out, named = np.zeros(len(lows), np.int64), np.zeros(len(lows), bool)
    out[places], named[places] = known[keep], ~null[keep]
    return lows.reshape(-1, most), highs.reshape(-1, most), pa.array(out, mask=~named)


def op12_hard_negatives(spark, sf_dir: str) -> DataFrame:
    """The negatives of every hundredth vector; the labels of every seventh are wrong on purpose."""
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    return hard_negatives(e, F.col("vec_id") % 100 == 0, label=label)


SQL = """
WITH e AS (SELECT row_number() OVER () AS k, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.k, a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score FROM e a JOIN e b ON a.k <> b.k WHERE a.vec_id % 100 = 0),
p AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY score DESC, id NULLS LAST) AS r FROM s WHERE same QUALIFY r <= 5)
SELECT p.anchor_id, p.id AS positive_id, CAST(row_number() OVER (PARTITION BY p.k, p.r ORDER BY s.score DESC, s.id NULLS LAST) AS INTEGER) AS rank, s.id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON p.k = s.k AND NOT s.same AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score QUALIFY rank <= 5
"""
