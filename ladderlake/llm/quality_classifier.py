"""A quality classifier from positives and unlabelled text (non-negative unbiased PU risk).

Trusted positives are texts labelled 1; the unlabelled are a sample of all texts, as found: labelled ones of either kind among them. The share of positives among the unlabelled is
estimated from how the two groups' scores compare (the least ratio of their upper tails, each at its bound of confidence). Those scores are
of rows that their model was not fitted on (folds), as few positives are otherwise told apart by chance. A model is then fitted that
minimises prior * R+(positives) + max(0, R-(unlabelled) - prior * R-(positives)) with logistic loss. Its margin is a log-odds under
that prior, and the score is its probability: no text labelled 0 is used as such. calibrate="labels" instead takes scale and cut from
a one-dimensional logistic fit on the training rows whose label is known, those labelled 0 among them.

Features are figures of form and repetition computed from each whole text in Arrow batches. Fitting takes three samples of at most
`most_rows` training rows each (chosen by a hash of id and text; repeated rows count once) to one task: of all rows (the unlabelled),
of those labelled 1 and of those labelled 0; so labels aren't thinned as the input grows. That is 3 * most_rows * about 40 numbers.
Calibration by labels weighs rows by their samples' rates. A null doc_id hashes as an empty string (remainder 0: learned from). Scoring is one pass without a shuffle.

Without a positive every score is 0.5 and every prediction 1. Null and empty texts get the features of an empty text and a score. Several labels of one document count as their mean; null
labels as none. Repeated rows are scored each. Empty tables give an empty result. Other columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._sample import drawn, least
from ._text import Words, byte_view, per_doc, sequence_hashes, slices, within

_KIND = np.zeros((8, 256), np.int64)
for _k, _chars in enumerate([b"#*$%&<>^~@_=+\\", b"|", b"!?", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b".,;:", b"\n"]):
    _KIND[_k, list(_chars)] = 1
FOLDS = 5


def features(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """A row of features for each text."""
    w = Words(buf, offs, lower=True)
    n = w.n.astype(float)
    one = np.maximum(n, 1)
    size = np.maximum(np.diff(offs), 1).astype(float)
    out = [np.log1p(n), np.log1p(size)]
    for kind in _KIND:
        total = np.concatenate([[0], np.cumsum(kind[buf])])
        ratio = (total[offs[1:]] - total[offs[:-1]]) / size
        out += [ratio, np.sqrt(ratio)]
    length = (w.end - w.start).astype(float)
    mean = per_doc(np.add, length, w.first) / one
    out += [mean, np.sqrt(np.maximum(per_doc(np.add, length**2, w.first) / one - mean**2, 0)), per_doc(np.maximum, length, w.first) ** 0.5]
    out += [per_doc(np.add, (length <= k).astype(float), w.first) / one for k in (1, 3)]
    if len(w.h):
        last = buf[w.end - 1]
        out.append(per_doc(np.add, np.isin(last, np.frombuffer(b"#*$%&|!?", np.uint8)).astype(float), w.first) / one)
        upper = np.concatenate([[0], np.cumsum(_KIND[3][buf])])
        out.append(per_doc(np.add, (2 * (upper[w.end] - upper[w.start]) > length).astype(float), w.first) / one)
    else:
        out += [np.zeros(len(n))] * 2
    for k in (1, 2, 3):
        ok = within(w.doc, k)
        h, d = sequence_hashes(w.h, k)[ok], w.doc[: len(ok)][ok]
        o = np.lexsort((h, d))
        again = np.zeros(len(h), bool)
        again[1:] = (h[o][1:] == h[o][:-1]) & (d[o][1:] == d[o][:-1])
        dup = np.bincount(d[o], weights=again, minlength=len(n)) / one
        out += [dup, np.sqrt(dup)]
    beside = np.zeros(len(w.h), bool)
    beside[1:] = (w.h[1:] == w.h[:-1]) & (w.doc[1:] == w.doc[:-1])
    out.append(per_doc(np.add, beside.astype(float), w.first) / one)
    return np.column_stack(out)


def _adam(gradient, size: int, steps: int, rate: float = 0.05) -> np.ndarray:
    x, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    for t in range(1, steps + 1):
        g = gradient(x)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        x = x - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return x


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, decay: float = 1e-3, steps: int = 400) -> np.ndarray:
    weight = weight / weight.sum()
    return _adam(lambda b: x.T @ (weight * (sigmoid(x @ b) - y)) + decay * np.append(b[:-1], 0), x.shape[1], steps)


def class_prior(p: np.ndarray, u: np.ndarray, width: float = 1.5) -> float:
    """The least ratio of the unlabelled to the positive scores' upper tails. Each share is moved by `width` standard errors, those of the unlabelled up and those of the positives down, so that a thin tail of few rows doesn't decide."""

    def tail(scores, cut, way):
        share = (scores >= cut).mean()
        return share + way * width * np.sqrt(share * (1 - share) / len(scores))

    tails = [(tail(u, c, 1), tail(p, c, -1)) for c in np.quantile(p, np.linspace(0.0, 0.9, 46))]
    return float(np.clip(min([a / b for a, b in tails if b > 0], default=0.99), 0.05, 0.99))


def unseen_scores(positive: np.ndarray, unlabelled: np.ndarray, fold_p: np.ndarray, fold_u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scores of both groups, each row's by a model of positives against unlabelled rows of the other folds."""
    of_p, of_u = np.zeros(len(positive)), np.zeros(len(unlabelled))
    for f in range(FOLDS):
        p, u = positive[fold_p != f], unlabelled[fold_u != f]
        if len(p) and len(u):
            y = np.repeat([1.0, 0.0], [len(p), len(u)])
            b = logistic(np.vstack([p, u]), y, np.where(y == 1, 1 / len(p), 1 / len(u)))
            of_p[fold_p == f], of_u[fold_u == f] = positive[fold_p == f] @ b, unlabelled[fold_u == f] @ b
    return of_p, of_u


def fit_pu(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None = None, folds: tuple[np.ndarray, np.ndarray] | None = None, decay: float = 1e-3, steps: int = 600) -> tuple[np.ndarray, float]:
    """(weights, class prior) of a linear score under the non-negative risk; the last column is the constant. folds: each row's fold, one and the same for a row in both groups."""
    if prior is None:
        folds = folds or (np.arange(len(positive)) % FOLDS, np.arange(len(unlabelled)) % FOLDS)
        prior = class_prior(*unseen_scores(positive, unlabelled, *folds))

    def gradient(b):
        zp, zu = positive @ b, unlabelled @ b
        of_p = positive.T @ (-sigmoid(-zp)) / len(zp)  # of log(1 + exp(-z))
        negative = unlabelled.T @ sigmoid(zu) / len(zu) - prior * positive.T @ sigmoid(zp) / len(zp)
        risk = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        return (prior * of_p + negative if risk >= 0 else -negative) + decay * np.append(b[:-1], 0)

    return _adam(gradient, positive.shape[1], steps, 0.02), prior


def learn(x: np.ndarray, y: np.ndarray, of_all: np.ndarray, calibrate: str, rates: tuple[float, float]) -> dict:
    """The model of feature rows x: y is 1, 0 or NaN; of_all marks the sample of all rows; rates: parts of the rows labelled 1 and 0 that are in x."""
    if not of_all.any():
        of_all = np.ones(len(x), bool)
    centre, scale = x[of_all].mean(0), x[of_all].std(0) + 1e-9
    z = np.column_stack([np.clip((x - centre) / scale, -8, 8), np.ones(len(x))])
    positive = y >= 0.5
    n = {"n_positive": int(positive.sum()), "n_unlabelled": int(of_all.sum())}
    if not positive.any():
        return n | {"centre": centre, "scale": scale, "w": np.zeros(z.shape[1]), "a": 1.0, "b": 0.0, "prior": 0.5}
    fold = np.arange(len(x)) % FOLDS  # rows come in order of their hashes
    w, prior = fit_pu(z[positive], z[of_all], folds=(fold[positive], fold[of_all]))
    s, seen, a, b = z @ w, ~np.isnan(y), 1.0, 0.0
    if calibrate == "labels" and (y[seen] < 0.5).any():
        a, b = logistic(np.column_stack([s[seen], np.ones(seen.sum())]), (y[seen] >= 0.5).astype(float), np.where(y[seen] >= 0.5, 1 / rates[0], 1 / rates[1]), decay=0, steps=1500)
    return n | {"centre": centre, "scale": scale, "w": w, "a": max(float(a), 1e-3), "b": float(b), "prior": prior}


def fit(docs: DataFrame, labels: DataFrame, most_rows: int = 20_000, label: str = "quality", calibrate: str = "none") -> dict:
    """The model, from training rows (crc32(doc_id) mod 3 other than 1): centre and scale of the features, weights, and the calibration's two numbers. calibrate: "none" for the margin of the risk as it is, or "labels"."""
    train = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text")).filter(~held_out())
    known = labels.groupBy(F.col("doc_id").alias("of")).agg((F.avg(F.col(label)) >= 0.5).cast("int").alias("y")).filter("y is not null")
    hashed = train.withColumn("h", drawn(7))
    marked = hashed.select("doc_id", "h").join(known, F.col("doc_id") == F.col("of"), "left").select("h", "y")
    n = {r["y"]: r["n"] for r in marked.groupBy("y").agg(F.approx_count_distinct("h").alias("n")).collect()}
    total = sum(n.values())
    parts = [(None, marked, total), (1, marked.filter("y = 1"), n.get(1, 0)), (0, marked.filter("y = 0"), n.get(0, 0))]
    chosen = functools.reduce(DataFrame.unionAll, (least(rows, most_rows, m).select("h", F.lit(k).cast("int").alias("y")) for k, rows, m in parts))
    chosen = chosen.groupBy("h").agg(F.max("y").alias("y"), F.bool_or(F.col("y").isNull()).alias("of_all"))  # at most 3 * most_rows rows of 16 bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for batch in batches:
            batch = batch.filter(pa.array([h not in seen and not seen.add(h) for h in batch.column(0).to_pylist()], pa.bool_()))
            for lo, hi in slices(batch.column(1)):
                x = features(*byte_view(batch.column(1)[lo:hi]))
                yield pa.RecordBatch.from_arrays([batch.column(0)[lo:hi], batch.column(2)[lo:hi], batch.column(3)[lo:hi], pa.array(list(x), pa.list_(pa.float64()))], ["h", "of_all", "y", "x"])

    def run_fit(table: pa.Table) -> pa.Table:
        h, first = np.unique(table.column("h").to_numpy(), return_index=True)
        table = table.take(pa.array(first))
        y = np.array([np.nan if v is None else v for v in table.column("y").to_pylist()], float)
        of_all = np.array(table.column("of_all").to_pylist())
        rates = tuple(max(1, (y == k).sum()) / max(1, n.get(k, 0)) for k in (1, 0))
        model = learn(np.array(table.column("x").to_pylist()), y, of_all, calibrate, rates)
        return pa.table({k: pa.array([model[k].tolist() if isinstance(model[k], np.ndarray) else model[k]]) for k in ("centre", "scale", "w", "a", "b", "prior", "n_positive", "n_unlabelled")})

    sampled = hashed.join(F.broadcast(chosen), "h").select("h", "text", "of_all", "y").mapInArrow(run, "h long, of_all boolean, y int, x array<double>")
    rows = sampled.groupBy().applyInArrow(run_fit, "centre array<double>, scale array<double>, w array<double>, a double, b double, prior double, n_positive long, n_unlabelled long").collect()
    if not rows:
        return {"centre": [], "scale": [], "w": [0.0], "a": 1.0, "b": 0.0, "prior": 0.5}
    return {k: np.array(v) if isinstance(v, list) else v for k, v in rows[0].asDict().items()}


def held_out():
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 1


def score(docs: DataFrame, model: dict) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column(2)):
                x = features(*byte_view(batch.column(2)[lo:hi]))
                z = np.clip((x - model["centre"]) / model["scale"], -8, 8) if len(model["centre"]) else np.zeros((hi - lo, 0))
                p = sigmoid(model["a"] * (np.column_stack([z, np.ones(hi - lo)]) @ model["w"]) + model["b"])
                yield pa.RecordBatch.from_arrays([batch.column(0)[lo:hi], batch.column(1)[lo:hi], pa.array(p), pa.array((p >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def op10_quality_classifier(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
