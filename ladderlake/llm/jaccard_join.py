"""Exact self-join of documents on the Jaccard similarity of their word shingles, with set relations that spare work.

1. Equal sets become one node (128-bit signature), so copies cost one row each and no pair.
2. Tokens are ordered: common ones last, by counts over all documents, the rest by fingerprint. Two sets of similarity t share
   a token among the first n - ceil(t n) + 1 of each, so those prefixes are indexed: token -> list of (set, size, position).
3. Index lists are sorted by size and cut into blocks with ranges of size and position; pairs of blocks whose sizes differ too
   much, or whose positions leave too few tokens behind, are skipped whole, then pairs one by one (index-level skipping).
4. Short lists give their pairs at once. A long list first gives each set's pair with a leader of about its size. Parity bitmaps
   of 2 to 4 bits a token bound a pair's overlap from above (half of what sizes and Hamming distance leave), so pairs are
   settled without their sets: those that may have a similarity of 0.5 form groups, which are compared inside: sets are taken so that each is highly similar to one whose
   answers are known, and its overlaps with all others of the group are derived from those by the index lists of the tokens in
   which the two differ only (answer-level skipping). No pair of a group is written out; links come out as a forest.
   Between groups, long lists give the pairs that can link, and bitmaps leave few to compare.
5. Comparisons are on whole sets; components of the links give the classes. Every pair that can link is compared in a group
   or as a pair, so no link is lost.

Long lists and groups are dealt out in cells by pairs of chunks (`cell` entries, `block` sets), so none has to fit a task.

Empty or null texts have no shingles and link with nothing. Fewer words than a shingle count as one shingle. Rows that share
a doc_id are one document for links; a null doc_id counts as the smallest. Repeated rows come back each. An empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _bloom
from ._scratch import dropped, written
from ._text import Words, byte_view, distinct_pairs, mix, sequence_hashes, slices, within
from .components import components

NO_ID = -(2**63)
SHORT = 6
BLOCK = 64


def shingle_sets(buf: np.ndarray, offs: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (row, shingle fingerprint) of lower-cased words."""
    w = Words(buf, offs)
    ok = within(w.doc, k)
    docs, hashes = [w.doc[: len(ok)][ok]], [sequence_hashes(w.h, k)[ok]]
    for n in range(1, k):
        few = np.flatnonzero(w.n == n)
        if len(few):
            docs.append(few)
            hashes.append(sequence_hashes(w.h, n)[w.first[few]])
    return distinct_pairs(np.concatenate(docs), np.concatenate(hashes))


def needed(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """The least intersection of sets of these sizes at the threshold."""
    return -(-percent * (a + b) // (100 + percent))


def possible(n1, p1, n2, p2, percent: int):
    """Whether sets of sizes n1, n2 that share the tokens at positions p1, p2 can link."""
    most = np.minimum(p1, p2) + 1 + np.minimum(n1 - 1 - p1, n2 - 1 - p2)
    return (100 * np.minimum(n1, n2) >= percent * np.maximum(n1, n2)) & (most >= needed(n1, n2, percent))


def list_pairs(n: np.ndarray, p: np.ndarray, group: np.ndarray, percent: int, side: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs i < j of one list sorted by n that can link and are of different groups (and of different sides, if given), block by block."""
    first = np.arange(0, len(n), BLOCK)
    lo_n, hi_n = np.minimum.reduceat(n, first), np.maximum.reduceat(n, first)
    lo_p, hi_p = np.minimum.reduceat(p, first), np.maximum.reduceat(p, first)
    left, right = [], []
    for x in range(len(first)):
        y = np.arange(x, len(first))
        # Best case of a pair of blocks: the largest sizes behind the smallest positions.
        best = np.minimum(hi_p[x], hi_p[y]) + 1 + np.minimum(hi_n[x] - 1 - lo_p[x], hi_n[y] - 1 - lo_p[y])
        y = y[(100 * hi_n[x] >= percent * lo_n[y]) & (best >= needed(lo_n[x], lo_n[y], percent))]
        i = np.arange(first[x], min(first[x] + BLOCK, len(n)))
        for z in y:
            j = np.arange(first[z], min(first[z] + BLOCK, len(n)))
            ok = (i[:, None] < j[None, :]) & (group[i][:, None] != group[j][None, :]) & possible(n[i][:, None], p[i][:, None], n[j][None, :], p[j][None, :], percent)
            if side is not None:
                ok &= side[i][:, None] != side[j][None, :]
            a, b = np.nonzero(ok)
            left.append(i[a])
            right.append(j[b])
    return (np.concatenate(left), np.concatenate(right)) if left else (np.zeros(0, np.int64),) * 2


def first_pairs(token: np.ndarray, ids: np.ndarray, n: np.ndarray, p: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of entries in any order: pairs of short lists, leader pairs of long ones, and the entries of long lists."""
    o = np.lexsort((ids, n, token))
    token, ids, n, p = token[o], ids[o], n[o], p[o]
    start = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]])) if len(token) else np.zeros(0, np.int64)
    size = np.diff(np.append(start, len(token)))
    of = np.repeat(size, size)
    left, right = [], []
    for k in range(1, min(SHORT, max(2, len(token) + 1))):
        i = np.flatnonzero((of[: len(of) - k] <= SHORT) & (token[k:] == token[: len(token) - k]))
        left.append(i)
        right.append(i + k)
    for s, m in zip(start[size > SHORT], size[size > SHORT]):
        i = 0
        while i < m:
            end = int(np.searchsorted(n[s : s + m], 100 * n[s + i] // percent, "right"))
            left.append(np.full(end - i - 1, s + i))
            right.append(np.arange(s + i + 1, s + end))
            i = end
    left, right = np.concatenate(left), np.concatenate(right)
    ok = possible(n[left], p[left], n[right], p[right], percent) & (ids[left] != ids[right])
    pair = np.unique(np.column_stack([ids[left[ok]], ids[right[ok]]]), axis=0) if ok.any() else np.zeros((0, 2), np.int64)
    return pair[:, 0], pair[:, 1], o[of > SHORT]


def parities(doc: np.ndarray, h: np.ndarray, n: np.ndarray) -> list[bytes]:
    """A bitmap of each set: whether an odd number of its tokens falls on a bit; a power of two of bits, 2 to 4 a token, at least 64."""
    bits = 1 << np.maximum(6, np.ceil(np.log2(np.maximum(2 * n, 1))).astype(np.int64))
    first = np.concatenate([[0], np.cumsum(bits)])
    at = first[doc] + (mix(h ^ np.uint64(0xD6E8FEB86659FD93)) & (bits[doc] - 1).astype(np.uint64)).astype(np.int64)
    packed = np.packbits((np.bincount(at, minlength=first[-1]) & 1).astype(np.uint8), bitorder="little").tobytes()
    return [packed[a // 8 : b // 8] for a, b in zip(first[:-1], first[1:])]


def most_common(x: bytes, nx: int, y: bytes, ny: int) -> int:
    """What two sets can have in common at most, by their bitmaps; the longer is folded to the shorter."""
    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    if len(x) != len(y):
        x, y = (x, y) if len(x) < len(y) else (y, x)
        y = np.bitwise_xor.reduce(y.reshape(-1, len(x)), axis=0)
    return (nx + ny - int(np.bitwise_count(x ^ y).sum())) // 2


def group_links(sets: list[np.ndarray], side: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """A forest of the links between sets of side 0 and of side 1 (of all sets if side is 0 throughout): set i's overlaps with all sets are those of the most similar set done before, less the index lists of tokens that i lacks, plus those of tokens that it adds."""
    n = np.array([len(x) for x in sets])
    m = len(sets)
    tokens, of = np.unique(np.concatenate(sets), return_inverse=True)
    cut = np.concatenate([[0], np.cumsum(n)])
    coded = [np.sort(of[a:b]) for a, b in zip(cut[:-1], cut[1:])]
    order = np.argsort(of, kind="stable")
    owner = np.repeat(np.arange(m), n)[order]
    begin = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(tokens)))])

    def along(t: np.ndarray) -> np.ndarray:
        """Overlaps that the index lists of tokens t add."""
        size = begin[t + 1] - begin[t]
        at = np.repeat(begin[t] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        return np.bincount(owner[at], minlength=m)

    parent = list(range(m))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    both = side.any()
    best, base = np.zeros(m), np.full(m, -1)  # the most similar set that is done, for each set
    done = np.zeros(m, bool)
    rows: dict[int, np.ndarray] = {}
    out = []
    todo = np.flatnonzero(side == 0)
    for _ in range(len(todo)):
        left = todo[~done[todo]]
        i = int(left[np.argmax(best[left])])
        b = int(base[i])
        gone = new = None
        if b >= 0 and b in rows:
            gone, new = np.setdiff1d(coded[b], coded[i], True), np.setdiff1d(coded[i], coded[b], True)
        if gone is not None and len(gone) + len(new) < n[i]:
            row = rows[b] - along(gone) + along(new)
        else:
            row = along(coded[i])
        done[i] = True
        rows[i] = row
        if len(rows) > 64:  # what is kept of answers is bounded
            rows.pop(next(iter(rows)))
        union = n[i] + n - row
        hit = np.flatnonzero((100 * row >= percent * union) & (side == 1 if both else ~done))
        for j in hit.tolist():
            x, y = find(i), find(j)
            if x != y:
                parent[x] = y
                out.append((i, j))
        near = row / union
        closer = near > best
        best[closer], base[closer] = near[closer], i
    return out


class Join:
    def __init__(self, docs: DataFrame, k: int = 5, percent: int = 80, heavy: int = 50_000, cell: int = 1 << 15, block: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> None:
        self.spark, self.k, self.percent, self.heavy, self.cell, self.block = docs.sparkSession, k, percent, heavy, cell, block
        self.docs = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.col(text_col).cast("string").alias("text"))

    def _common(self) -> np.ndarray:
        """At most `heavy` shingles, from rare to common: those that a task finds in 4 documents or more. They only set an order; any order gives the same links."""
        k = self.k

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, size = [], 0

            def out():
                h, at = np.unique(np.concatenate([x for x, _ in held]), return_inverse=True)
                n = np.bincount(at, weights=np.concatenate([c for _, c in held])).astype(np.int64)
                return pa.RecordBatch.from_arrays([pa.array(h[n > 3].view(np.int64)), pa.array(n[n > 3])], ["h", "n"])

            for batch in batches:
                for lo, hi in slices(batch.column(0)):
                    h, c = np.unique(shingle_sets(*byte_view(batch.column(0)[lo:hi]), k)[1], return_counts=True)
                    held.append((h, c))
                    size += len(h)
                    if size > 1_500_000:
                        yield out()
                        held, size = [], 0
            if held:
                yield out()

        rows = self.docs.select("text").mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "h").limit(self.heavy).toArrow()
        return rows.column("h").to_numpy()[::-1].astype(np.int64).view(np.uint64)

    def nodes(self) -> DataFrame:
        """(id, n, s1, s2, prefix, bits) of every document; prefix: fingerprints as bytes."""
        common = self._common()
        by_h = np.argsort(common)
        shared = self.spark.sparkContext.broadcast((common[by_h], by_h + 1))
        k, percent = self.k, self.percent

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            heavy, rank_of = shared.value
            for batch in batches:
                for lo, hi in slices(batch.column(1)):
                    doc, h = shingle_sets(*byte_view(batch.column(1)[lo:hi]), k)
                    rank = np.zeros(len(h), np.int64)
                    if len(heavy) and len(h):
                        at = np.minimum(np.searchsorted(heavy, h), len(heavy) - 1)
                        hit = heavy[at] == h
                        rank[hit] = rank_of[at[hit]]
                    n = np.bincount(doc, minlength=hi - lo)
                    first = np.concatenate([[0], np.cumsum(n)])
                    sums = [np.diff(np.concatenate([[np.uint64(0)], np.cumsum(mix(h ^ np.uint64(c)), dtype=np.uint64)])[first]) for c in (0x51ED270B, 0xA0761D6478BD642F)]
                    bits = parities(doc, h, n)
                    if rank.any():
                        h = h[np.lexsort((h, rank, doc))]
                    long = n - -(-percent * n // 100) + (n > 0)
                    ends = first[:-1] + long
                    prefix = [h[a:b].tobytes() for a, b in zip(first[:-1], ends)]
                    yield pa.RecordBatch.from_arrays([batch.column(0)[lo:hi], pa.array(n.astype(np.int64)), *(pa.array(s.view(np.int64)) for s in sums), pa.array(prefix, pa.binary()), pa.array(bits, pa.binary())], ["id", "n", "s1", "s2", "prefix", "bits"])

        return self.docs.mapInArrow(run, "id long, n long, s1 long, s2 long, prefix binary, bits binary")

    def lists(self, nodes: DataFrame, reps: tuple[DataFrame, DataFrame]) -> DataFrame:
        """(kind, token, a, b, n, p): kind 0, pairs to compare; kind 1, entries of long lists."""
        percent = self.percent
        total = nodes.agg(F.sum(F.octet_length("prefix")).alias("b")).first()["b"] or 0
        buckets = 1 << max(4, int(np.ceil(np.log2(max(1, total / 8 / 300_000)))))

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                data = batch.column("prefix").cast(pa.large_binary())
                for lo, hi in slices(data, 8 << 20):
                    part = data[lo:hi]
                    many = np.array([len(x.as_py()) // 8 for x in part])
                    token = np.frombuffer(b"".join(x.as_py() for x in part), np.uint64)
                    if not len(token):
                        continue
                    entry = np.repeat(np.arange(hi - lo), many)
                    ids = np.asarray(batch.column("id")[lo:hi])[entry]
                    n = np.asarray(batch.column("n")[lo:hi])[entry].astype(np.int32)
                    p = (np.arange(len(token)) - np.repeat(np.cumsum(many) - many, many)).astype(np.int32)
                    bucket = (mix(token) % np.uint64(buckets)).astype(np.int64)
                    o = np.argsort(bucket, kind="stable")
                    cuts = np.searchsorted(bucket[o], np.arange(buckets + 1))
                    rows = [(x, o[a:b]) for x, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if b > a]
                    yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in rows], pa.int64()), *(pa.array([v[i].tobytes() for _, i in rows], pa.binary()) for v in (token, ids, n, p))], ["bucket", "token", "ids", "n", "p"])

        def meet(table):
            token, ids, n, p = (np.frombuffer(b"".join(table.column(c).to_pylist()), t).astype(u) for c, t, u in (("token", np.uint64, np.uint64), ("ids", np.int64, np.int64), ("n", np.int32, np.int64), ("p", np.int32, np.int64)))
            a, b, rest = first_pairs(token, ids, n, p, percent)
            zero = np.zeros(len(a), np.int64)
            both = lambda x, y: pa.array(np.concatenate([x, y]))
            return pa.table({"kind": both(zero, zero[:0] + 1).cast(pa.int64()) if not len(rest) else both(zero, np.ones(len(rest), np.int64)), "token": both(zero, token[rest].view(np.int64)), "a": both(a, ids[rest]), "b": both(b, np.zeros(len(rest), np.int64)), "n": both(zero, n[rest]), "p": both(zero, p[rest])})

        hot, rare = reps
        told = nodes.filter("n > 0").join(F.broadcast(hot.select("s1", "s2", "n", F.col("rep").alias("hot"))), ["s1", "s2", "n"], "left")
        own = told.filter("hot IS NULL").join(rare.select("s1", "s2", "n", F.col("rep").alias("id")), ["s1", "s2", "n", "id"]).select("id", "n", "prefix")
        own = own.unionAll(told.filter("id = hot").groupBy("id", "n").agg(F.first("prefix").alias("prefix")))  # many rows may repeat a hot set's own
        packed = own.mapInArrow(pack, "bucket long, token binary, ids binary, n binary, p binary")
        return packed.groupBy("bucket").applyInArrow(meet, "kind long, token long, a long, b long, n long, p long")

    def sets(self, pairs: DataFrame) -> DataFrame:
        """(id, s) of the documents of pairs (a, b): sorted fingerprints as bytes. A Bloom filter of bounded size finds the texts; it lets a few more through."""
        k = self.k
        ids = pairs.select("a").unionAll(pairs.select("b")).distinct().withColumnRenamed("a", "id")
        bits = _bloom.bits_for(2 * ids.count(), most=26)

        def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            pair = _bloom.Pair(bits)
            for batch in batches:
                if batch.num_rows:
                    pair.add(mix(np.asarray(batch.column(0)).view(np.uint64)))
            yield from pair.chunks()

        wanted = self.spark.sparkContext.broadcast(_bloom.merge(ids.coalesce(max(2, self.spark.sparkContext.defaultParallelism)).mapInArrow(build, _bloom.CHUNKS_SCHEMA), bits, "once"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                batch = batch.filter(pa.array(_bloom.has(wanted.value, mix(np.asarray(batch.column(0)).view(np.uint64)))))
                for lo, hi in slices(batch.column(1)):
                    doc, h = shingle_sets(*byte_view(batch.column(1)[lo:hi]), k)
                    first = np.searchsorted(doc, np.arange(hi - lo + 1))
                    yield pa.RecordBatch.from_arrays([batch.column(0)[lo:hi], pa.array([h[a:b].tobytes() for a, b in zip(first[:-1], first[1:])], pa.binary())], ["id", "s"])

        return self.docs.mapInArrow(run, "id long, s binary")

    def bounded(self, pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
        """The pairs (a, b) whose bitmaps allow the similarity."""

        def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = []
                for x, nx, y, ny in zip(*(batch.column(c).to_pylist() for c in ("xa", "na", "xb", "nb"))):
                    most = min(most_common(x, nx, y, ny), nx, ny)
                    keep.append(100 * most >= percent * (nx + ny - most))
                yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

        side = lambda c: nodes.select(F.col("id").alias(c), F.col("bits").alias(f"x{c}"), F.col("n").alias(f"n{c}"))
        return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "xa", "na", "xb", "nb").mapInArrow(meet, "a long, b long")

    def compare(self, pairs: DataFrame, made: DataFrame) -> DataFrame:
        """(a, b, both, na, nb) of every pair (a, b): sizes of the sets and of their intersection."""

        def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                common, na, nb = [], [], []
                for x, y in zip(batch.column("sa"), batch.column("sb")):
                    x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                    x, y = (x, y) if len(x) <= len(y) else (y, x)
                    common.append(int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum()) if len(x) else 0)
                    na.append(len(x))
                    nb.append(len(y))
                yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), *(pa.array(v, pa.int64()) for v in (common, na, nb))], ["a", "b", "both", "na", "nb"])

        joined = pairs.join(made.select(F.col("id").alias("a"), F.col("s").alias("sa")), "a").join(made.select(F.col("id").alias("b"), F.col("s").alias("sb")), "b")
        return joined.select("a", "b", "sa", "sb").mapInArrow(meet, "a long, b long, both long, na long, nb long")

    def _later(self, entries: DataFrame, known: DataFrame) -> DataFrame:
        """Pairs (a, b) of long lists' entries of different components, a and b in order of (n, id)."""
        percent, cell = self.percent, self.cell
        labelled = entries.join(known.withColumnRenamed("id", "a"), "a", "left").withColumn("c", F.coalesce("comp", "a"))
        sizes = labelled.groupBy("token").agg(F.count("*").alias("m"), F.min("c").alias("c0"), F.max("c").alias("c1")).filter("c0 <> c1").select("token", F.ceil(F.col("m") / cell).cast("int").alias("g"))
        dealt = labelled.join(sizes, "token").withColumn("mine", F.pmod(F.xxhash64("a"), F.col("g")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("g") - 1)))
        dealt = dealt.select("token", F.least("mine", "other").alias("x"), F.greatest("mine", "other").alias("y"), "mine", "a", "n", "p", "c")

        def meet(key, table):
            a, n, p, c, mine = (table.column(v).to_numpy().astype(np.int64) for v in ("a", "n", "p", "c", "mine"))
            o = np.lexsort((a, n))
            a, n, p, c, mine = a[o], n[o], p[o], c[o], mine[o]
            i, j = list_pairs(n, p, c, percent, mine if key[1].as_py() != key[2].as_py() else None)
            return pa.table({"a": a[i], "b": a[j]})

        return dealt.groupBy("token", "x", "y").applyInArrow(meet, "a long, b long").distinct()

    def _inside(self, groups: DataFrame, made: DataFrame) -> DataFrame:
        """Links (a, b) of sets of one group; groups: (id, comp)."""
        percent, block = self.percent, self.block
        sizes = groups.groupBy("comp").agg(F.count("*").alias("m")).select("comp", F.ceil(F.col("m") / block).cast("int").alias("g"))
        dealt = groups.join(sizes, "comp").join(made, "id").withColumn("mine", F.pmod(F.xxhash64("id"), F.col("g")).cast("int"))
        dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("g") - 1))).select("comp", F.least("mine", "other").alias("x"), F.greatest("mine", "other").alias("y"), "mine", "id", "s")

        def meet(key, table):
            ids, mine = table.column("id").to_numpy(), table.column("mine").to_numpy()
            sets = [np.frombuffer(v, np.uint64) for v in table.column("s").to_pylist()]
            found = group_links(sets, (mine != key[1].as_py()).astype(np.int64), percent)
            return pa.table({"a": pa.array([ids[i] for i, _ in found], pa.int64()), "b": pa.array([ids[j] for _, j in found], pa.int64())})

        return dealt.groupBy("comp", "x", "y").applyInArrow(meet, "a long, b long")

    def run(self) -> DataFrame:
        """(id, n_shingles, component_id) of every row."""
        nodes = written(self.nodes(), "sets")
        total = nodes.count()
        split = lambda sets: (sets.filter(F.col("m") * 1000 > total), sets.filter(F.col("m") * 1000 <= total))  # noqa: E731  at most 999 hot sets
        reps = written(nodes.filter("n > 0").groupBy("s1", "s2", "n").agg(F.min("id").alias("rep"), F.count("*").alias("m")), "reps")
        lists = written(self.lists(nodes, split(reps)), "lists")
        pairs = written(lists.filter("kind = 0").select("a", "b").distinct(), "pairs")
        near = written(self.bounded(pairs, nodes, 50), "near")
        groups = components(near)
        inside = written(self._inside(groups, self.sets(near)), "inside")
        entries = lists.filter("kind = 1").select("token", "a", "n", "p")
        later = written(self.bounded(self._later(entries, groups).join(pairs, ["a", "b"], "left_anti"), nodes, self.percent), "later")
        links = inside
        if later.limit(1).count():
            linked = f"100 * both >= {self.percent} * (na + nb - both)"
            links = links.unionAll(self.compare(later, self.sets(later)).filter(linked).select("a", "b"))
        known = components(links)
        classes = written(reps.join(known.withColumnRenamed("id", "rep"), "rep", "left").select("s1", "s2", "n", "m", F.coalesce("comp", "rep").alias("comp")), "classes")
        dropped(reps, lists, pairs, near, groups, inside, later, known)
        hot, rare = split(classes)
        told = nodes.select("id", "n", "s1", "s2").join(F.broadcast(hot.select("s1", "s2", "n", F.col("comp").alias("hot"))), ["s1", "s2", "n"], "left")
        # rows of hot sets, and empty ones, are settled: they are dealt out evenly, not by their set
        open_ = F.col("hot").isNull() & (F.col("n") > 0)
        told = told.select("id", "n", "hot", "s2", F.when(open_, F.col("s1")).otherwise(F.xxhash64("id", F.spark_partition_id())).alias("s1"), F.when(open_, F.col("n")).otherwise(-1).alias("size"))
        out = told.join(rare.select("s1", "s2", F.col("n").alias("size"), "comp"), ["s1", "s2", "size"], "left")
        return out.select("id", F.col("n").alias("n_shingles"), F.coalesce("hot", "comp", "id").alias("component_id"))


def jaccard_join(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of docs; see Join for the options."""
    out = Join(docs, **options).run()
    back = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return out.select(back("id").alias("doc_id"), "n_shingles", back("component_id").alias("component_id"))


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """One row of docs for each class of texts: that of the smallest doc_id (null is the smallest), of the least hash of id and text among those, of the least other columns among equal ones. Rows that share an id or have none are joined by their texts only."""
    named = lambda c: F.col("`" + c.replace("`", "``") + "`")
    own = [f"c{i}" for i in range(len(docs.columns))]  # columns go by place: no name of theirs can clash
    rank = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    text = F.col("text").cast("string")
    keyed = docs.select(*(named(c).alias(o) for c, o in zip(docs.columns, own)), rank.alias("rank"), text.alias("text"), F.xxhash64(rank, F.coalesce(text, F.lit(""))).alias("key"))
    out = Join(keyed.select(F.col("key").alias("doc_id"), "text"), **options).run().select(F.col("id").alias("key"), "component_id").distinct()
    keep = keyed.select("key", "rank").distinct().join(out, "key").groupBy("component_id").agg(F.min(F.struct("rank", "key"))["key"].alias("key")).select("key")
    others = [o for o, (c, t) in zip(own, docs.dtypes) if c not in ("doc_id", "text") and "map<" not in t and t != "variant"]
    least = keyed.join(keep, "key", "left_semi").groupBy("key").agg(F.min_by(F.struct(*own), F.struct(F.lit(0), *others)).alias("kept"))
    return least.select(*(F.col(f"kept.{o}").alias(c) for c, o in zip(docs.columns, own)))


def op7_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return jaccard_join(spark.read.parquet(f"{sf_dir}/documents.parquet"))
