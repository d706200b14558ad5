"""Mixing sources to target weights by iterative proportional fitting.

Token counts of the cells (source, language, topic) are raked until their sums match the target share of every source,
language and topic. A cell's weight is raked over original tokens. Documents are kept with a probability that is raked again under
the bound 1, so that the expected kept tokens meet the targets and are `keep_share` of all. A target that asks for more of a value
than there is can't be met at that share: `exact` then lowers the share until all are met, otherwise they are missed. Whether a
document is kept depends on a hash of its id and text only.

Targets: a dictionary for each margin (value -> weight; None is the null value), or a power: target share = (token share) ** power,
renormalised, which 1 leaves as it is and 0 makes equal. Values that no target names keep their token share.

Documents are read twice: for the cells, and to be weighed. Nothing but cells is shuffled. The cells (one row for each combination
that occurs) meet in one task, which runs all rounds on arrays; rates go back by a join, broadcast up to `few_cells` of them.

topic: a column that the caller names; without one, a class by form (table, marked, shouting, notice, prose), since the
tables that this was made for have no topics.

Null source, language or topic are a value of their own. A null or empty text has no tokens; it takes its cell's probability.
Rows that share id and text share their fate. Empty table: empty result. mix() replaces columns of the same names as the added
ones; sample() returns all columns as they came.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._scratch import written
from ._text import SPACE, byte_view, slices

DIMS = ("source", "lang", "topic")
MOST_ROUNDS = 200_000
ADDED = ("topic", "n_tokens", "weight", "probability", "kept")
_FORM = np.zeros((3, 256), bool)
for _k, _chars in enumerate([b"|", b"#*$%&<>{}=", b"!"]):
    _FORM[_k, list(_chars)] = True


def measure(column: pa.Array) -> tuple[list[str], np.ndarray]:
    """(topic, number of words) of each text: the topic is coarse, from its form: table, marked, shouting, notice or prose."""
    buf, offs = byte_view(column)
    inside = ~SPACE[buf]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    at = offs[:-1][offs[:-1] < len(buf)]
    begins[at] = inside[at]
    many = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[offs])
    size = np.maximum(np.diff(offs), 1)
    bars, marks, shouts = (many(_FORM[k][buf]) / size for k in range(3))
    notice = [bool(x) for x in pc.fill_null(pc.match_substring_regex(column.cast(pa.large_string()), "(?i)license|copyright"), False).to_pylist()]
    topics = ["table" if a > 0.02 else "marked" if b > 0.03 else "shouting" if c > 0.03 else "notice" if d else "prose" for a, b, c, d in zip(bars, marks, shouts, notice)]
    return topics, many(begins)


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def measured(docs: DataFrame, keep: list[Column], topic: Column | None = None) -> DataFrame:
    """Columns `keep` of docs as c0, c1, ..., so that no name of theirs can clash, with topic and n_tokens."""
    own = [f"c{i}" for i in range(len(keep))]
    slim = docs.select(F.col("text").cast("string").alias("text"), (F.lit(None) if topic is None else topic).cast("string").alias("topic"), *(c.alias(o) for c, o in zip(keep, own)))
    by_form = topic is None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column(0)):
                topics, n = measure(batch.column(0)[lo:hi])
                given = pa.array(topics, pa.string()) if by_form else batch.column(1)[lo:hi]
                yield pa.RecordBatch.from_arrays([*(batch.column(i + 2)[lo:hi] for i in range(len(own))), given, pa.array(n.astype(np.int64))], [*own, "topic", "n_tokens"])

    schema = T.StructType([*(slim.schema[c] for c in own), T.StructField("topic", T.StringType()), T.StructField("n_tokens", T.LongType())])
    return slim.mapInArrow(run, schema)


def goals(values: list, own: np.ndarray, target: dict | float) -> np.ndarray:
    """Target share of each value, from its own share; a value without tokens has none."""
    if isinstance(target, dict):
        goal = np.array([float(target.get(v, s)) for v, s in zip(values, own)])
    else:
        goal = own ** float(target)
    goal = np.where(own > 0, goal, 0.0)
    return goal / (goal.sum() or 1.0)


def rake(tokens: np.ndarray, margins: list[np.ndarray], goal: list[np.ndarray], tolerance: float = 1e-9) -> np.ndarray:
    """Tokens of each cell, scaled margin by margin until a whole round moves no more than `tolerance` of all tokens. margins: number of each cell's value, by dimension; goal: target share of each value. Targets that contradict each other settle, too: on what fits the last margin."""
    total = max(tokens.sum(), 1.0)
    w = tokens.astype(float)
    for _ in range(MOST_ROUNDS):
        before = w
        for m, g in zip(margins, goal):
            own = np.bincount(m, weights=w, minlength=len(g))
            w = w * np.divide(g * total, own, out=np.zeros(len(g)), where=own > 0)[m]
        if np.abs(w - before).sum() <= tolerance * total:
            return w
    raise ArithmeticError(f"raking did not settle in {MOST_ROUNDS} rounds")


def bounded(tokens: np.ndarray, w: np.ndarray, margins: list[np.ndarray], share: float, tolerance: float = 1e-8) -> tuple[np.ndarray, float]:
    """(kept tokens of each cell, none above its tokens; largest miss as a part of all tokens) when the margins of w are raked to `share` of them, until they are met or a round moves no more."""
    total = max(tokens.sum(), 1)
    goal = [np.bincount(m, weights=w) * share for m in margins]
    x = np.minimum(w * share, tokens)
    for _ in range(MOST_ROUNDS):
        before = x
        for m, g in zip(margins, goal):
            own = np.bincount(m, weights=x)
            x = np.minimum(x * np.divide(g, own, out=np.ones(len(g)), where=own > 0)[m], tokens)
        miss = max(np.abs(np.bincount(m, weights=x) - g).max(initial=0) for m, g in zip(margins, goal)) / total
        if miss < 1e-7 or np.abs(x - before).sum() <= tolerance * total:
            return x, miss
    raise ArithmeticError(f"raking under the bound did not settle in {MOST_ROUNDS} rounds")


def probabilities(tokens: np.ndarray, w: np.ndarray, margins: list[np.ndarray], keep_share: float, exact: bool) -> tuple[np.ndarray, float]:
    """(probability of each cell, share that is kept): raked under the bound 1. Where the targets can't be met at keep_share, exact keeps the largest share (to 0.001) at which they are; otherwise the share is kept and the targets are met as far as they can be."""
    some = tokens > 0
    g = np.divide(w, tokens, out=np.zeros(len(w)), where=some)
    if not g.any():
        return np.zeros(len(w)), keep_share
    x, miss = bounded(tokens, w, margins, keep_share)
    if exact and miss > 1e-5:
        low, high = min(keep_share, tokens.sum() / w.sum() / g.max()), keep_share
        for m in margins:
            own, goal = np.bincount(m, weights=tokens), np.bincount(m, weights=w)
            high = min(high, (own[goal > 0] / goal[goal > 0]).min())
        low = min(low, high)
        while high - low > 1e-3:
            middle = (low + high) / 2
            low, high = (middle, high) if bounded(tokens, w, margins, middle)[1] <= 1e-5 else (low, middle)
        keep_share, x = low, bounded(tokens, w, margins, low)[0]
    budget, scale, p = keep_share * tokens.sum(), 1.0, np.divide(x, tokens, out=np.zeros(len(w)), where=some)
    while True:  # each step fills a cell or ends
        full = p * scale >= 1
        rest = x[~full].sum()
        better = (budget - tokens[full].sum()) / rest if rest else scale
        if better <= scale * (1 + 1e-12):
            return np.minimum(p * scale, 1), keep_share
        scale = better


def rates(cells: DataFrame, targets: dict, keep_share: float, exact: bool = False) -> DataFrame:
    """cells (source, lang, topic, tokens) with weight (raked tokens over tokens) and probability. One task takes all cells: about 150 bytes for each combination of source, language and topic that occurs, whatever the number of documents."""
    schema = T.StructType([*(cells.schema[d] for d in DIMS), T.StructField("tokens", T.LongType()), T.StructField("weight", T.DoubleType()), T.StructField("probability", T.DoubleType())])

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([(d, "ascending") for d in DIMS])  # one order of sums, whoever counted the cells
        tokens = table.column("tokens").to_numpy().astype(float)
        coded = [table.column(d).combine_chunks().dictionary_encode(null_encoding="encode") for d in DIMS]
        margins = [np.asarray(c.indices) for c in coded]
        goal = []
        for d, c, m in zip(DIMS, coded, margins):
            own = np.bincount(m, weights=tokens, minlength=len(c.dictionary)) / max(tokens.sum(), 1)
            goal.append(goals(c.dictionary.to_pylist(), own, targets.get(d, 1.0)))
        w = rake(tokens, margins, goal)
        p, share = probabilities(tokens, w, margins, keep_share, exact)
        weight = np.round(np.divide(w, tokens, out=np.zeros(len(w)), where=tokens > 0), 9)
        return pa.table([*(table.column(d) for d in DIMS), table.column("tokens"), pa.array(weight), pa.array(np.round(np.where(tokens > 0, p, share), 9))], names=schema.names)

    return cells.groupBy().applyInArrow(run, schema)


def chance(seed: int = 5) -> Column:
    """A number in [0, 1) from a hash of the id and the text."""
    return F.pmod(F.xxhash64("doc_id", "text", F.lit(seed)), F.lit(1 << 52)) / F.lit(float(1 << 52))


def _drawn(docs: DataFrame, targets: dict, keep_share: float, exact: bool, columns: list[str], topic_col: str | None, few_cells: int) -> DataFrame:
    """columns as c0, c1, ... with topic, n_tokens, weight, probability, kept."""
    topic = quoted(topic_col) if topic_col else None
    place = [F.col(d).cast("string") for d in DIMS[:2]]
    cells = measured(docs, place, topic).groupBy(F.col("c0").alias("source"), F.col("c1").alias("lang"), "topic").agg(F.sum("n_tokens").alias("tokens"))
    rate = written(rates(written(cells, "cells"), targets, keep_share, exact).select(*(F.col(d).alias(f"of_{d}") for d in DIMS), "weight", "probability"), "rates")
    if rate.count() <= few_cells:  # about 50 bytes a row
        rate = F.broadcast(rate)
    n = len(columns)
    own = measured(docs, [*map(quoted, columns), *place, chance()], topic)
    meet = F.col(f"c{n}").eqNullSafe(F.col("of_source")) & F.col(f"c{n + 1}").eqNullSafe(F.col("of_lang")) & F.col("topic").eqNullSafe(F.col("of_topic"))
    return own.join(rate, meet, "left").withColumn("kept", F.col(f"c{n + 2}") < F.col("probability"))


def mix(docs: DataFrame, targets: dict, keep_share: float = 0.8, columns: list[str] | None = None, exact: bool = False, topic_col: str | None = None, few_cells: int = 100_000) -> DataFrame:
    """docs (or these columns of it) with topic, n_tokens, weight, probability, kept. exact: the targets come before keep_share, which is lowered as far as they need."""
    own = [c for c in (columns or docs.columns) if c not in ADDED]
    return _drawn(docs, targets, keep_share, exact, own, topic_col, few_cells).select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(own)), *ADDED)


def sample(docs: DataFrame, targets: dict, keep_share: float = 0.8, exact: bool = False, topic_col: str | None = None, few_cells: int = 100_000) -> DataFrame:
    """The rows of docs that are kept, with their own columns as they are, whatever their names."""
    return _drawn(docs, targets, keep_share, exact, docs.columns, topic_col, few_cells).filter("kept").select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)))


#: Targets of the query and the pipeline: sources evened out, languages by weight, topics with less form than prose.
TARGETS = {"source": 0.7, "lang": {"en": 0.55, "de": 0.17, "fr": 0.16, "es": 0.12}, "topic": 0.9}


def op5_mixing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix(docs, TARGETS, columns=["doc_id", "source", "lang"], exact=True).select("doc_id", "source", "lang", "topic", "n_tokens", "weight", "probability", "kept")
