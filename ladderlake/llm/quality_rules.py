"""Quality rules on repetition inside a document, from a word-level suffix array.

The suffixes of all documents of a slice are sorted together by prefix doubling, each document apart from the others; the
ranks of every doubling give the longest common prefixes of neighbours. The longest of a suffix's two common prefixes is the
longest repeated substring that begins there (the deepest LCP interval that holds it). Those of at least `min_repeat` words
that no earlier start extends are maximal; the union of their spans gives the covered fraction, and their longest the longest
repeat. A document is rejected when either passes its limit.

Words in repeats of `min_repeat` words are in repeated windows of three, too, of which the base rule allows half of the words, so
only a limit below 0.5 adds to it. 0.2 is chosen, not learned. Both places of a repeat are covered, so it also weighs the longest
repeat against the text: two places apart may each take a tenth of the words; `most_longest` binds beyond 1,000 words.

Null and empty texts have no words and fail the base rule. Repeated rows are judged each by itself. An empty table gives an
empty result; other columns are ignored. Texts are whole; memory follows the longest text or a slice of 1 MB.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ._text import Words, byte_view, per_doc, slices

#: Characters that count as symbols.
SYMBOLS = b"#*$%&|<>"
SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, covered_fraction double, longest_repeat long, n_maximal long"


def longest_repeats(ids: np.ndarray, doc: np.ndarray, doc_end: np.ndarray) -> np.ndarray:
    """For each word, the length in words of the longest substring that starts there and occurs elsewhere in the document too. doc_end: the end of each word's document."""
    n = len(ids)
    if n == 0:
        return np.zeros(0, np.int64)
    order = np.lexsort((ids, doc))
    d, w = doc[order], ids[order]
    new = np.ones(n, bool)
    new[1:] = (d[1:] != d[:-1]) | (w[1:] != w[:-1])
    head = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = head
    levels, k = [rank.copy()], 1
    size = np.bincount(head, minlength=n)
    active = np.flatnonzero(size[rank] > 1)
    while len(active):
        at = active + k
        inside = at < doc_end[active]
        second = np.where(inside, rank[np.minimum(at, n - 1)] + 1, 0)
        o = np.lexsort((second, rank[active]))
        active, second = active[o], second[o]
        r = rank[active]
        group = np.ones(len(r), bool)
        group[1:] = r[1:] != r[:-1]
        sub = group.copy()
        sub[1:] |= second[1:] != second[:-1]
        index = np.arange(len(r))
        fresh = r + np.maximum.accumulate(np.where(sub, index, 0)) - np.maximum.accumulate(np.where(group, index, 0))
        rank[active] = fresh
        k *= 2
        levels.append(rank.copy())
        count = np.diff(np.append(np.flatnonzero(sub), len(r)))
        active = active[np.repeat(count > 1, count)]
    sa = np.empty(n, np.int64)
    sa[rank] = np.arange(n)
    a, b = sa[:-1], sa[1:]
    near = np.flatnonzero(levels[0][a] == levels[0][b])
    a, b = a[near], b[near]
    lcp = np.zeros(len(near), np.int64)
    for level in range(len(levels) - 1, -1, -1):
        x, y = a + lcp, b + lcp
        ok = (x < doc_end[a]) & (y < doc_end[b])
        same = ok & (levels[level][np.minimum(x, n - 1)] == levels[level][np.minimum(y, n - 1)])
        lcp += same.astype(np.int64) << level
    out = np.zeros(n, np.int64)
    np.maximum.at(out, a, lcp)
    np.maximum.at(out, b, lcp)
    return out


def covered(longest: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether each word lies in a span that starts where length > 0."""
    n = len(longest)
    step = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(length)
    np.add.at(step, at, 1)
    np.subtract.at(step, at + length[at], 1)
    return np.cumsum(step[:-1]) > 0


def _dup_lines(raw: bytes) -> int:
    if raw.count(b"\n") == 0:
        return 0
    seen, n = set(), 0
    for line in raw.split(b"\n"):
        if line in seen:
            n += bool(line.strip(b" \t\n\x0b\x0c\r"))
        else:
            seen.add(line)
    return n


def judge(docs: DataFrame, min_repeat: int = 8, most_covered: float = 0.2, most_longest: int = 100, min_words: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of figures and a verdict for each row of docs: rejected if repeats of at least min_repeat words cover more than most_covered of its words, or one is longer than most_longest words."""
    symbol = np.zeros(256, np.int64)
    symbol[list(SYMBOLS)] = 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column(1)):
                buf, offs = byte_view(batch.column(1)[lo:hi])
                w = Words(buf, offs, lower=False)
                _, ids = np.unique(w.h, return_inverse=True)
                longest = longest_repeats(ids, w.doc, w.first[1:][w.doc])
                points = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])
                chars = np.concatenate([[0], np.cumsum(points[w.end] - points[w.start])])
                symbols = np.concatenate([[0], np.cumsum(symbol[buf])])
                three = covered(longest, np.where(longest >= 3, 3, 0))
                begins = longest >= min_repeat
                longer = np.zeros(len(longest), bool)
                longer[1:] = (longest[:-1] == longest[1:] + 1) & (w.doc[1:] == w.doc[:-1])
                inside = covered(longest, np.where(begins, longest, 0))
                n = w.n.astype(np.int64)
                repeat = per_doc(np.add, three.astype(np.int64), w.first)
                cover = per_doc(np.add, inside.astype(np.int64), w.first) / np.maximum(n, 1)
                most = per_doc(np.maximum, longest, w.first)
                maximal = per_doc(np.add, (begins & ~longer).astype(np.int64), w.first)
                failed = (n < min_words) | (100 * repeat > 50 * n)
                raw = buf.tobytes()
                dup = np.array([_dup_lines(raw[offs[i] : offs[i + 1]]) for i in range(hi - lo)], np.int64)
                kept = ~failed & (cover <= most_covered) & (most <= most_longest)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[lo:hi], *(pa.array(x) for x in (n, chars[w.first[1:]] - chars[w.first[:-1]], symbols[offs[1:]] - symbols[offs[:-1]], dup, repeat, failed, kept, cover, most, maximal))],
                    ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "covered_fraction", "longest_repeat", "n_maximal"],
                )

    slim = docs.selectExpr(f"cast(`{id_col}` as long) AS doc_id", f"cast(`{text_col}` as string) AS text")
    out = slim.mapInArrow(run, SCHEMA)
    return out if id_col == "doc_id" else out.withColumnRenamed("doc_id", id_col)


def op9_quality_rules(spark, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/documents.parquet"))
