"""Language identification by a linear-chain conditional random field over words.

Each word is labelled with a language: its scores come from affixes (2 to 4 bytes at either end), n-grams (2 to 4 bytes) and a
lexicon of words that the training sample holds often; learned transitions link neighbouring words, so that a foreign word in
a sentence follows its surroundings and a switch of language inside a text is found. Marginals come from forward-backward;
a document's language is the one with the largest sum of marginals, its score that sum's share.

Training takes whole texts of at most `most_docs` labelled rows to one task (chosen by a hash of id and text, in equal parts for
each language, so that rare ones and rows without an id have theirs) and maximises the likelihood of sequences spliced from runs of
different languages, by AdaGrad. Only the model reaches the driver. Prediction is one pass in Arrow batches, without a shuffle: segments of 32 words become 4 x 4 transfer matrices, which are scanned document by
document, so that a text of any length takes the same memory a word.

A null text, or one without a letter, is `und` with score 0. Ties go to the first language in order of name. With no training
row every text is `und`. A null doc_id hashes as an empty string (remainder 0: learned from). Repeated rows are predicted each. Empty tables give empty results. Other columns are ignored.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._sample import SPAN, drawn
from ._text import LOWER, Words, byte_view, slices

BUCKETS = 1 << 16
SEGMENT = 32
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True


def held_out():
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2


class Vocabulary:
    """The distinct words of a slice and their features: of, the distinct word of each word; feature ids and the word each is of. Words without letters have no features."""

    def __init__(self, w: Words, lexicon: np.ndarray) -> None:
        h, at, self.of = np.unique(w.h, return_index=True, return_inverse=True)
        letters = np.flatnonzero(_LETTER[w.buf])
        lo, hi = np.searchsorted(letters, w.start[at]), np.searchsorted(letters, w.end[at])
        self.lettered = hi > lo
        own = np.flatnonzero(self.lettered)
        start, end = letters[lo[own]], letters[hi[own] - 1] + 1
        length = end - start
        low = LOWER[w.buf]
        word = np.repeat(np.arange(len(own)), length + 2)
        first = np.concatenate([[0], np.cumsum(length + 2)])
        place = np.arange(first[-1]) - np.repeat(first[:-1], length + 2)
        inner = (place > 0) & (place <= np.repeat(length, length + 2))
        text = np.zeros(first[-1] + 4, np.uint64)
        text[: first[-1]][inner] = low[np.repeat(start, length + 2)[inner] + place[inner] - 1]
        m = first[-1]
        ids, owners = [], []
        code = text[:m].copy()
        for n in (2, 3, 4):
            code = code | (text[n - 1 : n - 1 + m] << np.uint64(8 * (n - 1)))
            ok = place + n <= np.repeat(length + 2, length + 2)
            ids.append(_bucket(code[ok], n))
            owners.append(word[ok])
            for kind, spot in ((10 + n, first[:-1]), (20 + n, first[1:] - n)):
                long = length + 2 > n
                ids.append(_bucket(code[spot[long]], kind))
                owners.append(np.flatnonzero(long))
        if len(lexicon):
            found = np.minimum(np.searchsorted(lexicon, h[own]), len(lexicon) - 1)
            hit = lexicon[found] == h[own]
            ids.append((BUCKETS + found[hit]).astype(np.int32))
            owners.append(np.flatnonzero(hit))
        self.feature, self.owner, self.size = np.concatenate(ids), own.astype(np.int32)[np.concatenate(owners)], len(h)

    def scores(self, weights: np.ndarray) -> np.ndarray:
        return np.column_stack([np.bincount(self.owner, weights=weights[self.feature, k], minlength=self.size) for k in range(weights.shape[1])]) if self.size else np.zeros((0, weights.shape[1]))


def _bucket(code: np.ndarray, kind: int) -> np.ndarray:
    x = (code + np.uint64(kind << 40)) * np.uint64(0x9E3779B97F4A7C15)
    return (x >> np.uint64(48)).astype(np.int32)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(x.sum(-1, keepdims=True), 1e-300)


def marginals(scores: np.ndarray, first: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """Label probabilities of every word; first: where each document begins, and the end."""
    n, k = scores.shape
    if not n:
        return np.zeros((0, k))
    e = np.exp(scores - scores.max(1, keepdims=True))
    m = np.exp(transitions - transitions.max())
    length = np.diff(first)
    segments = -(-length // SEGMENT)
    begin = np.concatenate([[0], np.cumsum(segments)])
    doc = np.repeat(np.arange(len(length)), segments)
    at = first[doc] + (np.arange(begin[-1]) - begin[doc]) * SEGMENT
    many = np.minimum(first[doc + 1] - at, SEGMENT)
    s = len(at)
    product = np.tile(np.eye(k), (s, 1, 1))
    for t in range(SEGMENT):
        on = np.flatnonzero(many > t)
        x = (product[on].reshape(-1, k) @ m).reshape(-1, k, k) * e[at[on] + t][:, None, :]
        product[on] = x / x.max((1, 2), keepdims=True)
    enter, leave = np.empty((s, k)), np.empty((s, k))
    by_size = np.argsort(-segments, kind="stable")
    a, b = np.full((len(length), k), 1.0 / k), np.full((len(length), k), 1.0 / k)
    alive = np.searchsorted(-segments[by_size], -np.arange(segments.max()), "left")  # documents with more than j segments
    for j in range(int(segments.max())):
        d = by_size[: alive[j]]
        i = begin[d] + j
        enter[i] = a[d]
        a[d] = _unit(np.einsum("ij,ijk->ik", a[d], product[i]))
        i = begin[d] + segments[d] - 1 - j
        leave[i] = b[d]
        b[d] = _unit(np.einsum("ijk,ik->ij", product[i], b[d]))
    out = np.empty((n, k))
    for t in range(SEGMENT):
        on = np.flatnonzero(many > t)
        enter[on] = _unit((enter[on] @ m) * e[at[on] + t])
        out[at[on] + t] = enter[on]
    for t in range(SEGMENT - 1, -1, -1):
        on = np.flatnonzero(many > t)
        out[at[on] + t] *= leave[on]
        leave[on] = _unit((leave[on] * e[at[on] + t]) @ m.T)
    return _unit(out)


def fit(texts: list[str], langs: list[str], steps: int = 220, batch: int = 96, span: int = 64, seed: int = 11, lexicon_count: int = 6, lexicon_size: int = 20_000) -> dict:
    """The model: languages, lexicon (fingerprints), feature weights, transitions."""
    names = sorted(set(langs))
    k = len(names)
    buf, offs = byte_view(pa.array(texts, pa.string()))
    w = Words(buf, offs)
    label = np.repeat([names.index(x) for x in langs], w.n)
    h, count = np.unique(w.h, return_counts=True)
    common = np.sort(h[np.argsort(-count, kind="stable")[:lexicon_size]])
    lexicon = np.sort(np.intersect1d(common, h[count >= lexicon_count]))
    v = Vocabulary(w, lexicon)
    order = np.argsort(v.owner, kind="stable")
    features, bounds = v.feature[order], np.concatenate([[0], np.cumsum(np.bincount(v.owner, minlength=v.size))])
    v.feature = v.owner = order = None
    weights, moved = np.zeros((BUCKETS + len(lexicon), k)), np.full((BUCKETS + len(lexicon), k), 1e-3)
    transitions, moved_t = np.zeros((k, k)), np.full((k, k), 1e-3)
    rng = np.random.default_rng(seed)
    by_lang = [np.flatnonzero(label == x) for x in range(k)]
    for _ in range(steps):
        # Sequences spliced from runs: consecutive words of one language, a few runs each.
        picks = np.empty((batch, span), np.int64)
        for r in range(batch):
            t = 0
            while t < span:
                pool = by_lang[rng.integers(k)]
                run = min(span - t, 1 + int(rng.geometric(1 / 24)), len(pool))
                s = rng.integers(len(pool) - run + 1)
                picks[r, t : t + run] = pool[s : s + run]
                t += run
        y = label[picks]
        word, inverse = np.unique(v.of[picks], return_inverse=True)
        inverse = inverse.reshape(picks.shape)
        n = bounds[word + 1] - bounds[word]
        f = features[np.repeat(bounds[word], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
        owner = np.repeat(np.arange(len(word)), n)
        scores = np.column_stack([np.bincount(owner, weights=weights[f, x], minlength=len(word)) for x in range(k)])[inverse]
        e, m = np.exp(scores - scores.max(2, keepdims=True)), np.exp(transitions)
        alpha, beta = np.empty_like(e), np.empty_like(e)
        alpha[:, 0] = _unit(e[:, 0])
        for t in range(1, span):
            alpha[:, t] = _unit((alpha[:, t - 1] @ m) * e[:, t])
        beta[:, -1] = 1 / k
        gt = np.zeros((k, k))
        for t in range(span - 1, 0, -1):
            right = beta[:, t] * e[:, t]
            xi = alpha[:, t - 1, :, None] * m[None] * right[:, None, :]
            gt -= (xi / xi.sum((1, 2), keepdims=True)).sum(0)
            beta[:, t - 1] = _unit(right @ m.T)
        gamma = _unit(alpha * beta)
        np.add.at(gt, (y[:, :-1].ravel(), y[:, 1:].ravel()), 1.0)
        g = -gamma
        np.put_along_axis(g, y[:, :, None], np.take_along_axis(g, y[:, :, None], 2) + 1, 2)
        for x in range(k):
            per_word = np.bincount(inverse.ravel(), weights=g[:, :, x].ravel(), minlength=len(word))
            grad = np.bincount(f, weights=per_word[owner], minlength=len(weights)) / batch
            moved[:, x] += grad**2
            weights[:, x] += 0.15 * grad / np.sqrt(moved[:, x])
        moved_t += (gt / batch) ** 2
        transitions += 0.15 * (gt / batch) / np.sqrt(moved_t)
    return {"names": names, "lexicon": lexicon, "weights": weights.astype(np.float32), "transitions": transitions}


def train(docs: DataFrame, most_docs: int = 400) -> dict | None:
    """fit() in one task, on a sample of at most most_docs of the rows that may be learned from; None without any. Languages have equal parts in it, as far as they have rows; at most most_docs languages, the most frequent, are learned. Repeated rows count once."""
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).filter(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    hashed = rows.withColumn("h", drawn(3))
    langs = hashed.groupBy("lang").agg(F.count("*").alias("m"), F.approx_count_distinct("h").alias("n")).orderBy(F.desc("m"), "lang").limit(most_docs)
    few = hashed.select("lang", "h").join(F.broadcast(langs), "lang").filter(F.col("h") < F.least(F.lit(1.0), 2 * most_docs / F.col("n")) * SPAN).select("lang", "h").distinct()
    chosen = few.withColumn("k", F.row_number().over(W.partitionBy("lang").orderBy("h"))).filter(F.col("k") <= most_docs).orderBy("k", "h", "lang").limit(most_docs).select("lang", "h")

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for batch in batches:
            keys = list(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()))
            new = [k not in seen and not seen.add(k) for k in keys]
            yield batch.filter(pa.array(new, pa.bool_()))

    def learn(table: pa.Table) -> pa.Table:
        got = {(r["lang"], r["h"]): r["text"] for r in table.to_pylist() if r["text"].split()}
        order = sorted(got, key=lambda k: (k[1], k[0]))
        out = io.BytesIO()
        if order:
            model = fit([got[k] for k in order], [k[0] for k in order])
            np.savez(out, **(model | {"names": np.array(model["names"])}))
        return pa.table({"model": pa.array([out.getvalue()], pa.binary())})

    sample = hashed.join(F.broadcast(chosen), ["lang", "h"]).select("text", "lang", "h").mapInArrow(once, "text string, lang string, h long")
    raw = [r["model"] for r in sample.groupBy().applyInArrow(learn, "model binary").collect()]
    if not raw or not raw[0]:
        return None
    model = dict(np.load(io.BytesIO(raw[0])))
    return model | {"names": model["names"].tolist()}


def label_words(model: dict, text: str) -> list[tuple[str, str, float]]:
    """(word, language, probability) of each word of a text, for code-switched text."""
    buf, offs = byte_view(pa.array([text], pa.string()))
    w = Words(buf, offs)
    v = Vocabulary(w, model["lexicon"])
    p = marginals(v.scores(model["weights"])[v.of], w.first, model["transitions"])
    raw = buf.tobytes()
    return [(raw[a:b].decode(), model["names"][x.argmax()], float(x.max())) for a, b, x in zip(w.start, w.end, p)]


def verdicts(column: pa.Array, model: dict | None) -> tuple[list[str], np.ndarray]:
    """(language, score) of each text of a column."""
    buf, offs = byte_view(column)
    total = np.zeros((len(column), 1))
    if model:
        w = Words(buf, offs)
        v = Vocabulary(w, model["lexicon"])
        p = marginals(v.scores(model["weights"])[v.of], w.first, model["transitions"]) * v.lettered[v.of][:, None]
        total = np.column_stack([np.bincount(w.doc, weights=p[:, x], minlength=len(column)) for x in range(len(model["names"]))])
    score = total.max(1) / np.maximum(total.sum(1), 1e-300)
    lettered = np.concatenate([[0], np.cumsum(_LETTER[buf] & (buf < 128))])
    plain = lettered[offs[1:]] > lettered[offs[:-1]]
    known = [bool(model) and (bool(ok) or any(c.isalpha() for c in (column[i].as_py() or ""))) for i, ok in enumerate(plain)]
    return [model["names"][b] if ok else "und" for b, ok in zip(total.argmax(1), known)], np.where(known, np.clip(score, 0, 1), 0.0)


def predict(docs: DataFrame, model: dict | None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS + lexicon_size rows at most, whatever the input

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column(2)):
                lang, score = verdicts(batch.column(2)[lo:hi], shared.value)
                yield pa.RecordBatch.from_arrays([batch.column(0)[lo:hi], batch.column(1)[lo:hi], pa.array(lang, pa.string()), pa.array(score)], ["doc_id", "held_out", "lang_pred", "score"])

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def accepted(docs: DataFrame, model: dict | None, least_score: float = 0.35) -> DataFrame:
    """The rows of docs, with all their columns, that have a language with at least this score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column(at)):
                lang, score = verdicts(batch.column(at)[lo:hi], shared.value)
                yield batch.slice(lo, hi - lo).filter(pa.array([x != "und" and s >= least_score for x, s in zip(lang, score)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op2_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return predict(docs, train(docs))
