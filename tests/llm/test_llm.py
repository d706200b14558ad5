"""Operators against plain versions on small tables with nulls, empty and long texts, ties, repeats and clashing columns."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from ladderlake.llm import decontamination, jaccard_join, language_id, line_dedup, mixing, ngram_lm, quality_classifier, quality_rules, sharding, warc
from ladderlake.llm._text import Words, byte_view
from ladderlake.llm.elias_fano import EliasFano, in_word

SF = "/root/testdata/sf0.001"
ASCII_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: Names that the operators use themselves.
EXTRA = "id long, n long, h long, token long, comp long, line string, size int, shard int, _arc int, kept boolean, topic string, score double, rep long, y double"


def words(text):
    return (text or "").encode().translate(ASCII_LOWER).split()


@pytest.fixture(scope="session")
def docs(spark):
    """Texts of the smallest table, and odd ones; other columns have clashing names."""
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    line = "A line of more than forty characters, over and over again."
    long = " ".join(f"w{i % 977}" for i in range(30_000))
    odd = [(1000, None, None, None), (1001, "", "en", None), (1002, " \n\t ", "xx", "s"), (1003, "12 34 !?", "en", "s"), (1004, long, "en", "s"), (1005, long + " tail", "en", "s"), (1006, "one two", "en", "s"), (1006, "one two", "en", "s"), (1007, "One  two", "de", "s"), (None, "a null id " * 9, "en", "s")]
    odd += [(1010 + i, f"{line if i % 2 else line.upper() + ' '}\nand number {i} more {'x' * i}", "en", "hot") for i in range(9)]
    odd += [(1030 + i, f"\x0b {line}\n{line}", "en", "hot") for i in range(2)]
    schema = f"doc_id long, text string, lang string, source string, {EXTRA}"
    return spark.createDataFrame([(*r, *([None] * len(EXTRA.split(",")))) for r in [*rows, *odd]], schema).repartition(5).cache()


def table(df, *keys):
    return sorted((tuple(r) for r in df.select(*keys).collect()), key=str)


def test_words_are_those_of_bytes_split():
    texts = ["Ab  cd\x0bE", "", None, "é ü\n", " x", "ab"]
    buf, offs = byte_view(pa.array(texts))
    w = Words(buf, offs)
    raw = buf.tobytes()
    assert [raw[a:b] for a, b in zip(w.start, w.end)] == [x for t in texts for x in (t or "").encode().split()]
    assert w.n.tolist() == [len((t or "").encode().split()) for t in texts]
    by = {}
    for a, b, h in zip(w.start, w.end, w.h):
        assert by.setdefault(raw[a:b].lower(), h) == h
    assert len(set(by.values())) == len(by)


def test_elias_fano_reads_back_and_finds():
    rng = np.random.default_rng(1)
    for u, n in [(1, 500), (7, 500), (1000, 500), (2**40, 500), (2**64, 500), (2**64, 100), (2**64, 60), (2**64, 2)]:
        v = np.sort(np.unique(rng.integers(0, u, n, dtype=np.uint64, endpoint=False)))
        e = EliasFano(EliasFano.encode(v, u, "a"), "a")
        assert (e.get(np.arange(len(v))) == v).all()
        q = np.unique(np.concatenate([v, rng.integers(0, u, 500, dtype=np.uint64, endpoint=False)]))
        at = {int(x): i for i, x in enumerate(v)}
        assert e.find(q).tolist() == [at.get(int(x), -1) for x in q]
        low, high = e.pair(np.arange(len(v) - 1))
        assert (low == v[:-1]).all() and (high == v[1:]).all()
    dense = np.sort(np.concatenate([np.arange(1000, 1400), rng.integers(0, 2**30, 90), [2**40]])).astype(np.uint64)
    e = EliasFano(EliasFano.encode(dense, 2**41, "a"), "a")
    assert (e.get(np.arange(len(dense))) == dense).all() and (e.pair(np.arange(len(dense) - 1))[1] == dense[1:]).all()
    q = np.arange(990, 1420).astype(np.uint64)
    assert [dense[i] if i >= 0 else None for i in e.find(q)] == [x if x in dense else None for x in q]
    words = rng.integers(1, 2**63, 200, dtype=np.uint64)
    for r in (0, 3, 11):
        some = words[np.bitwise_count(words) > r]
        assert in_word(some, np.full(len(some), r)).tolist() == [[i for i in range(64) if int(x) >> i & 1][r] for x in some]


# 1
def test_line_dedup(spark, docs):
    rows = docs.select("doc_id", "text").collect()
    blank = " \t\n\x0b\x0c\r"
    key = lambda line: line.strip(blank).encode().translate(ASCII_LOWER).decode()
    rank = lambda i: -1 if i is None else i
    held = collections.defaultdict(set)
    for r in rows:
        for line in (r["text"] or "").split("\n"):
            if len(key(line)) >= 40:
                held[key(line)].add(rank(r["doc_id"]))
    want = []
    for r in rows:
        lines = (r["text"] or "").split("\n")
        left = [x for x in lines if len(held.get(key(x), ())) < 5 or rank(r["doc_id"]) == max(held[key(x)])]
        want.append((r["doc_id"], len(lines), len(lines) - len(left), hashlib.sha256("\n".join(left).encode()).hexdigest()))
    got = line_dedup.line_dedup(docs)
    assert table(got, "doc_id", "n_lines", "n_dropped", "kept_sha256") == sorted(want, key=str)
    assert sum(w[2] for w in want) > 8
    full = line_dedup.line_dedup(docs, most_bits=16, with_text=True)  # a filter that is nearly full
    assert table(full, "doc_id", "n_lines", "n_dropped", "kept_sha256") == sorted(want, key=str)
    assert line_dedup.line_dedup(docs.limit(0)).count() == 0


# 2
def test_language_id(spark, docs):
    model = language_id.train(docs)
    got = {}
    for r in language_id.predict(docs, model).collect():
        got[r["doc_id"]] = r
        assert 0 <= r["score"] <= 1
        assert r["held_out"] == (zlib.crc32(str("" if r["doc_id"] is None else r["doc_id"]).encode()) % 4 == 2)
    assert {got[i]["lang_pred"] for i in (1000, 1001, 1002, 1003)} == {"und"}
    real = [(r["lang"], got[r["doc_id"]]) for r in docs.filter("doc_id < 1000").collect()]
    held = [lang == g["lang_pred"] for lang, g in real if g["held_out"]]
    assert len(held) > 20 and sum(held) / len(held) > 0.95
    labels = language_id.label_words(model, "the and of that with der die und ist auf")
    assert {x[1] for x in labels[:4]} == {"en"} and {x[1] for x in labels[6:]} == {"de"}
    assert language_id.predict(docs.limit(0), model).count() == 0
    assert {r["lang_pred"] for r in language_id.predict(docs, language_id.train(docs.limit(0))).collect()} == {"und"}
    kept = {r["doc_id"] for r in language_id.accepted(docs, model).collect()}
    assert kept.isdisjoint({1000, 1001, 1002, 1003}) and len(kept) > 150


def test_language_sample_is_bounded_whatever_the_ids(spark):
    rows = [(None, f"the and of that with number {i}", "en") for i in range(3000)] + [(None, f"der die und ist auf nummer {i}", "de") for i in range(12)] + [(4, "la casa de los gatos", "es")] * 500
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.train(docs, most_docs=30)
    assert model["names"] == ["de", "en", "es"]
    got = language_id.predict(docs, model).groupBy("lang_pred").count().collect()
    assert {r["lang_pred"]: r["count"] for r in got} == {"en": 3000, "de": 12, "es": 500}


def test_crf_marginals_are_those_of_all_paths():
    rng = np.random.default_rng(3)
    scores, m = rng.normal(size=(8, 3)), rng.normal(size=(3, 3))
    first = np.array([0, 0, 5, 8])
    got = language_id.marginals(scores, first, m)
    for a, b in ((0, 5), (5, 8)):
        total, mass = np.zeros((b - a, 3)), 0.0
        for path in np.ndindex(*[3] * (b - a)):
            # the first word is entered from every label alike
            x = np.log(np.exp(m[:, path[0]]).sum()) + scores[a, path[0]] + sum(m[path[i - 1], path[i]] + scores[a + i, path[i]] for i in range(1, b - a))
            mass += np.exp(x)
            for i, y in enumerate(path):
                total[i, y] += np.exp(x)
        assert np.allclose(got[a:b], total / mass)
    long = language_id.marginals(np.tile(scores, (20, 1)), np.array([0, 160]), m)
    assert np.allclose(long.sum(1), 1)


# 3
def test_alignment_is_that_of_the_full_matrix():
    rng = np.random.default_rng(5)
    for _ in range(50):
        a, b = rng.integers(2, 6, 12).astype(np.uint64), rng.integers(2, 6, 20).astype(np.uint64)
        h = np.zeros((13, 21), int)
        for i in range(12):
            for j in range(20):
                h[i + 1, j + 1] = max(0, h[i, j] + (2 if a[i] == b[j] else -1), h[i, j + 1] - 1, h[i + 1, j] - 1)
        assert decontamination.align(a[None], b[None])[0][0] == h.max()


def test_decontamination(spark, docs):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    rng = random.Random(2)
    items = {r["item_id"]: r["text"] for r in bench.collect()}
    pick = sorted(items)[:6]
    plant = []
    for n, i in enumerate(pick):
        w = items[i].split()
        edited = [f"edit{k}" if k % 7 == 3 else x for k, x in enumerate(w)]
        cut = [x for k, x in enumerate(w) if k % 9 != 4]
        plant += [(5000 + 10 * n, f"Before it. {items[i]} After it."), (5001 + 10 * n, "x y z " * 50 + " ".join(edited)), (5002 + 10 * n, " ".join(cut).upper() + " and on"), (5003 + 10 * n, " ".join(rng.sample(w, len(w))))]
    planted = spark.createDataFrame(plant, "doc_id long, text string")
    both = docs.select("doc_id", "text").unionByName(planted)
    odd = bench.unionByName(spark.createDataFrame([(900, None), (901, ""), (902, "!! ?")], bench.schema))
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in decontamination.contaminated(both, odd).collect()}
    for n, i in enumerate(pick):
        assert got[5000 + 10 * n, i] == 1.0
        assert got[5001 + 10 * n, i] >= 0.5 and got[5002 + 10 * n, i] >= 0.5
        assert (5003 + 10 * n, i) not in got
    exact = {(d, i) for d, t in [(r["doc_id"], r["text"] or "") for r in both.collect()] for i, text in items.items() if text in t}
    assert exact <= set(got)
    left = {r["doc_id"] for r in decontamination.decontaminate(docs, bench).collect()}
    dirty = {r["doc_id"] for r in decontamination.contaminated(docs, bench).collect()}
    assert left == {r["doc_id"] for r in docs.collect()} - dirty and dirty
    assert decontamination.contaminated(docs.limit(0), bench).count() == 0
    assert decontamination.contaminated(docs, bench.limit(0)).count() == 0


def test_decontamination_finds_a_stretched_copy_at_every_offset(spark):
    item = [f"i{k}" for k in range(45)]
    copy = [f"e{k}" if k in (4, 13, 31, 40) else w for k, w in enumerate(item)]
    copy = copy[:22] + [f"n{k}" for k in range(30)] + copy[22:]
    rows = [(i, " ".join([f"b{k}" for k in range(i)] + copy + [f"a{k}" for k in range(60)])) for i in range(40)] + [(99, " ".join(f"c{k}" for k in range(20_000)))]
    got = decontamination.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")).collect()
    assert {r["doc_id"] for r in got} == set(range(40)) and len({r["score"] for r in got}) == 1


def test_decontamination_finds_what_alignment_with_every_text_finds(spark):
    bench = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").collect()
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    plain = lambda column: decontamination.plain_words(*byte_view(pa.array(column, pa.string())))
    rows = docs.collect()
    item_of, item_h = plain([r["text"] for r in bench])
    doc_of, doc_h = plain([r["text"] for r in rows])
    items = [item_h[item_of == i] for i in range(len(bench))]
    want = set()
    for d, r in enumerate(rows):
        h = doc_h[doc_of == d]
        if not len(h):
            continue
        common = [i for i, x in enumerate(items) if 2 * np.isin(x, h).sum() >= len(x)]  # half the score takes as many equal words
        for i in common:
            if decontamination.align(items[i][None], h[None])[0][0] >= 0.5 * 2 * len(items[i]):
                want.add((r["doc_id"], bench[i]["item_id"]))
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.contaminated(docs, spark.createDataFrame(bench)).collect()}
    assert got <= want and len(got) >= 0.9 * len(want) > 5, (len(got), len(want))


def test_decontamination_items_that_are_short_long_or_share_an_id(spark):
    rng = random.Random(7)
    long = [f"l{rng.randrange(3000)}" for _ in range(4000)]
    copy = [w if k % 5 else f"e{k}" for k, w in enumerate(long)]
    rows = [(k, f"the cat and the dog number {k} sat on the mat") for k in range(300)] + [(7, "quixotic zephyr vortex"), (8, " ".join(["pad"] * 900 + copy)), (9, " ".join(long[:1500]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = [(1, "the"), (2, "quixotic zephyr vortex"), (3, " ".join(long)), (4, "the cat and the dog number 12 sat on the mat"), (4, "cat and the dog number 12 sat on the mat"), (None, "and the")]
    got = decontamination.contaminated(docs, spark.createDataFrame(items, "item_id long, text string"), most_chance=1e-6).collect()
    pairs = [(r["doc_id"], r["item_id"]) for r in got]
    assert len(pairs) == len(set(pairs)) and {i for _, i in pairs} == {2, 3, 4}
    assert (7, 2) in pairs and (8, 3) in pairs and (9, 3) not in pairs and (12, 4) in pairs


def test_decontamination_finds_whole_copies_of_short_items_and_tells_rows_without_an_id_apart(spark):
    few = "what is the capital of france and where lies it".split()
    rng = random.Random(11)
    noise = " ".join(rng.choice(few) for _ in range(20_000))
    items = [(1, "what is the capital of france"), (2, "the capital of france lies"), (3, "the of"), (4, "where lies it and what")]
    rows = [(1, "tell me: What is the capital of France?"), (2, "it lies where it lies"), (3, noise), (None, "one: what is the capital of france"), (None, "two: what is the capital of france"), (None, "where lies it"), (None, None), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    exact = {(d, None if d is not None else hashlib.sha256(t.encode()).hexdigest(), i) for d, t in rows for i, x in items if len(x.split()) > 3 and f" {x} " in f" {(t or '').lower().replace('?', '')} "}
    assert {(1, 1), (3, 2)} <= {(d, i) for d, _, i in exact}
    got = {(r["doc_id"], r["text_sha256"], r["item_id"]): r["score"] for r in decontamination.contaminated(docs, bench).collect()}
    assert exact <= {k for k, v in got.items() if v == 1} and {i for _, _, i in got} <= {1, 2, 4}
    assert sum(d is None for d, _, _ in got) == 2 and not any(d in (2, 4) for d, _, _ in got)
    dirty = {k[:2] for k in got}
    clean = [r for r in rows if (r[0], hashlib.sha256(r[1].encode()).hexdigest() if r[0] is None and r[1] else None) not in dirty]
    assert sorted(map(tuple, decontamination.decontaminate(docs, bench).collect()), key=str) == sorted(clean, key=str)


def test_decontamination_merges_windows_in_parts(monkeypatch):
    item = " ".join(f"i{k % 9}" for k in range(30))
    seeds = decontamination.Seeds([1, 1, 2], [item, item, "i1 i2 i3 i4"])
    seeds.choose({}, 10**6, 3, 1e-7, 8, 8)
    doc, h = decontamination.plain_words(*byte_view(pa.array([item, f"a {item} b {item}", "i1 i2 i3 i4", "none"])))
    want = [x.tolist() for x in seeds.matches(doc, h, 0.5)]
    monkeypatch.setattr(decontamination, "PLACES", 7)
    assert [x.tolist() for x in seeds.matches(doc, h, 0.5)] == want and len(want[0]) == 7


# 4
@pytest.mark.parametrize("slack", [0.0, 0.1])
def test_sharding(spark, docs, slack):
    got = sharding.shard(docs, shards=7, vnodes=32, slack=slack).collect()
    assert len(got) == docs.count()
    by = collections.defaultdict(list)
    for r in got:
        by[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    if slack:
        assert max(map(len, by.values())) <= math.ceil(1.1 * len(got) / 7)
    else:
        assert max(map(len, by.values())) - min(len(by.get(s, ())) for s in range(7)) <= 1
    sizes = {(r["doc_id"], r["size"], r["text_crc32"]) for r in got}
    assert sizes == {(r["doc_id"], len((r["text"] or "").encode()) + 8, zlib.crc32((r["text"] or "").encode())) for r in docs.collect()}
    assert sharding.shard(docs.limit(0), shards=7).count() == 0
    few = sharding.shard(docs.limit(3), shards=7).collect()
    assert sorted(r["shard"] for r in few) == [0, 1, 2]
    carried = sharding.shard(docs, shards=7, vnodes=32, slack=slack, carry=True)
    assert set(docs.columns) <= set(carried.columns) and len(carried.columns) == len(set(carried.columns))
    assert table(carried, "doc_id", "text_crc32", "shard") == sorted(((r["doc_id"], r["text_crc32"], r["shard"]) for r in got), key=str)
    assert table(carried, "doc_id", "text", "lang") == table(docs, "doc_id", "text", "lang")


@pytest.mark.parametrize("slack", [0.0, 0.15])
def test_sharding_is_a_walk_on_the_ring(spark, slack):
    import bisect

    from pyspark.sql import functions as F

    rows = [(i, "hot" if i % 3 == 0 else f"text {i // 2}") for i in range(3000)] + [(None, "x"), (None, None), (None, "hot")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    points = sharding.ring(5, 16)
    edges = [p for p, _ in points]
    at = [r[0] for r in docs.select(F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(sharding.SPAN))).collect()]  # a null text lies with the empty ones
    arcs = [bisect.bisect_left(edges, x) % len(edges) for x in at]
    room, over, want = sharding.bounds(len(rows), 5, slack), [], collections.Counter()
    for arc in sorted(arcs):  # every row by itself: first each arc's own shard, then on from point to point
        if room[points[arc][1]]:
            room[points[arc][1]] -= 1
            want[points[arc][1], arc] += 1
        else:
            over.append(arc)
    for arc in over:
        k = arc
        while not room[points[k % len(points)][1]]:
            k += 1
        room[points[k % len(points)][1]] -= 1
        want[points[k % len(points)][1], arc] += 1
    got = sharding.shard(docs, shards=5, vnodes=16, slack=slack).collect()
    arc_of = {crc: arc for crc, arc in zip((zlib.crc32((t or "").encode()) for _, t in rows), arcs)}
    assert collections.Counter((r["shard"], arc_of[r["text_crc32"]]) for r in got) == want
    shards_of = collections.defaultdict(set)
    for r in got:
        shards_of[r["text_crc32"]].add(r["shard"])
    parted = sum(len(v) > 1 for k, v in shards_of.items() if k != zlib.crc32(b"hot"))
    assert parted <= 5 + len({(r["shard"], arc_of[r["text_crc32"]]) for r in got}) - len(set(arcs))  # each bound parts one group at most


def test_sharding_moves_few_rows_and_holds_hot_keys(spark):
    many = spark.range(20_000).selectExpr("id as doc_id", "if(id % 3 = 0, 'hot', concat('t', id)) as text")
    a, b = ({r["doc_id"]: r["shard"] for r in sharding.shard(many.filter("id % 3 <> 0"), shards=n, vnodes=128, slack=0.2).collect()} for n in (10, 11))
    assert sum(a[i] != b[i] for i in a) / len(a) < 0.3  # 1 / 11 and what overflows
    n = collections.Counter(r["shard"] for r in sharding.shard(many, shards=10).collect())
    assert set(n.values()) == {2000}


def test_ring_search():
    points = sharding.ring(5, 16)
    edges = [p for p, _ in points]
    import bisect

    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    at = [0, 1, sharding.SPAN - 1, *edges, *[e + 1 for e in edges], *[e - 1 for e in edges]]
    from pyspark.sql import functions as F

    got = spark.createDataFrame([(x,) for x in at], "at long").select("at", sharding._arc(F.col("at"), edges).alias("arc")).collect()
    assert all(r["arc"] == bisect.bisect_left(edges, r["at"]) % len(edges) for r in got)


# 5
def test_mixing(spark, docs):
    targets = {"source": 0.5, "lang": {"en": 0.4, "de": 0.3}, "topic": 1.0}
    got = mixing.mix(docs, targets, keep_share=0.6).collect()
    assert len(got) == docs.count()
    cells = collections.Counter()
    for r in got:
        assert r["n_tokens"] == len((r["text"] or "").encode().split())
        assert r["kept"] == (r["kept"] and r["probability"] > 0)
        cells[r["source"], r["lang"], r["topic"]] += r["n_tokens"]
    total = sum(cells.values())
    goal = []
    for d, name in enumerate(mixing.DIMS):
        own = collections.Counter()
        for k, n in cells.items():
            own[k[d]] += n
        own = {k: n / total for k, n in own.items() if n}
        t = targets[name]
        g = {k: t.get(k, s) if isinstance(t, dict) else s**t for k, s in own.items()}
        goal.append({k: v / sum(g.values()) * total for k, v in g.items()})
    w = {k: float(n) for k, n in cells.items()}
    for _ in range(50):
        for d in range(3):
            s = collections.Counter()
            for k, x in w.items():
                s[k[d]] += x
            w = {k: x * (goal[d].get(k[d], 0) / s[k[d]] if s[k[d]] else 0) for k, x in w.items()}
    for r in got:
        k = r["source"], r["lang"], r["topic"]
        if cells[k]:
            assert r["weight"] == pytest.approx(w[k] / cells[k], rel=1e-4, abs=1e-6)
    assert sum(r["n_tokens"] * r["probability"] for r in got) == pytest.approx(0.6 * total, rel=1e-4)
    assert 0.4 * total < sum(r["n_tokens"] for r in got if r["kept"]) < 0.8 * total
    assert mixing.mix(docs.limit(0), targets).count() == 0
    joined = mixing.mix(docs, targets, keep_share=0.6, few_cells=0).collect()
    assert sorted((str(r["doc_id"]), r["probability"]) for r in joined) == sorted((str(r["doc_id"]), r["probability"]) for r in got)


def test_sampling_leaves_columns_as_they_are(spark):
    names = ["_source", "topic", "kept", "n_tokens", "weight", "probability", "c0", "of_lang", "draw", "a.b"]
    rows = [(i, f"text number {i}", "en", f"s{i % 3}", *(f"{n}{i}" for n in names)) for i in range(60)]
    docs = spark.createDataFrame(rows, ["doc_id", "text", "lang", "source", *names])
    left = mixing.sample(docs, {}, keep_share=0.5)
    assert left.schema == docs.schema and 10 < left.count() < 50
    assert set(map(tuple, left.collect())) <= set(rows)
    kinds = {r["topic"] for r in mixing.mix(docs, {}, columns=["doc_id"], topic_col="kept").collect()}
    assert kinds == {f"kept{i}" for i in range(60)}


def test_raking_settles_when_targets_contradict():
    # value 0 of the first margin is only found with value 0 of the second
    w = mixing.rake(np.array([10.0, 10.0, 0.0, 10.0]), [np.array([0, 1, 0, 1]), np.array([0, 0, 1, 1])], [np.array([0.7, 0.3]), np.array([0.5, 0.5])])
    assert w.sum() == pytest.approx(30) and w[2] == 0 and w[0] + w[1] == pytest.approx(15)


def test_mixing_keeps_tokens_in_the_target_shares(spark):
    rng = random.Random(11)
    rows = [(i, "w " * rng.randrange(20, 60), "hot" if rng.random() < 0.33 else f"s{rng.randrange(6)}", rng.choices(["en", "de", "fr", "es"], [70, 10, 10, 10])[0]) for i in range(3000)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string, lang string"), mixing.TARGETS, keep_share=0.9, exact=True).collect()
    stays = sum(r["n_tokens"] * r["probability"] for r in got)
    assert all(0 <= r["probability"] <= 1 for r in got)
    assert 0.5 * sum(r["n_tokens"] for r in got) < stays
    for d in mixing.DIMS:
        want, have, own = collections.Counter(), collections.Counter(), collections.Counter()
        for r in got:
            own[r[d]] += r["n_tokens"]
            have[r[d]] += r["n_tokens"] * r["probability"] / stays
        for k, n in own.items():
            t = mixing.TARGETS[d]
            want[k] = t[k] if isinstance(t, dict) else (n / sum(own.values())) ** t
        for k in own:
            assert have[k] == pytest.approx(want[k] / sum(want.values()), abs=1e-3)


# 6
def test_ngram_lm(spark, docs):
    from pyspark.sql import functions as F

    slim = docs.select("doc_id", "text")
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0
    rows = [(r["doc_id"], r["text"]) for r in slim.collect()]
    train = [words(t) + ["END"] for i, t in rows if not held(i)]
    least, discount = 2, ngram_lm.DISCOUNT
    one, two, three = collections.Counter(), collections.Counter(), collections.Counter()
    for s in train:
        p = ["END", *s]
        one.update(s)
        two.update(zip(p, p[1:]))
        three.update(zip(p, p[1:], p[2:]))
    n, v = sum(one.values()), len(one)
    two = {k: c for k, c in two.items() if c >= least}
    kept3 = {k: c for k, c in three.items() if c >= least and k[:2] in two}
    left2, left3 = collections.defaultdict(lambda: 1.0), collections.defaultdict(lambda: 1.0)
    for k, c in two.items():
        left2[k[0]] -= (c - discount) / one[k[0]]
    for k, c in kept3.items():
        left3[k[:2]] -= (c - discount) / two[k[:2]]
    p1 = lambda w: (one[w] + 0.1) / (n + 0.1 * (v + 1))
    p2 = lambda u, w: ((two[u, w] - discount) / one[u] if (u, w) in two else 0) + left2[u] * p1(w)
    p3 = lambda t, u, w: p2(u, w) if (t, u) not in two else ((kept3[t, u, w] - discount) / two[t, u] if (t, u, w) in kept3 else 0) + left3[t, u] * p2(u, w)
    info = ngram_lm.build(slim.filter(~ngram_lm.held_out()).select(F.col("text")), min_count=least)
    assert info["ngrams"] == [v, len(two), len(kept3)]
    got = ngram_lm.score(docs, info).collect()
    assert len(got) == len(rows)
    want = collections.defaultdict(list)
    for i, t in rows:
        s = words(t) + ["END"]
        p = ["END", *s]
        score = math.log10(p2("END", s[0])) + sum(math.log10(p3(*x)) for x in zip(p, p[1:], p[2:]))
        want[i].append((held(i), len(s), sum(w in one for w in s), sum(math.log10(p1(w)) for w in s), score))
    for r in got:
        h, m, k, base, score = want[r["doc_id"]][0]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (h, m, k, n)
        assert r["base_score"] == pytest.approx(base, abs=1e-6 * m)
        assert abs(r["score"] - score) < 0.05 * m + 0.05  # what quantising moves
    none = ngram_lm.score(docs.limit(4), ngram_lm.build(slim.select("text").limit(0))).collect()
    assert all(r["n_known"] == 0 and r["train_tokens"] == 0 for r in none)


def test_ngram_lm_keeps_what_was_seen_once(spark):
    texts = ["one two three", "two three four", None, "five one two six"]
    info = ngram_lm.build(spark.createDataFrame([(t,) for t in texts], "text string"))
    two, three = set(), set()
    for t in texts:
        p = ["END", *words(t), "END"]
        two.update(zip(p, p[1:]))
        three.update(zip(p, p[1:], p[2:]))
    assert info["ngrams"] == [7, len(two), len(three)]
    held = spark.createDataFrame([(1, "five one two six"), (2, "six two one five")], "doc_id long, text string")
    seen, unseen = (r["score"] for r in ngram_lm.score(held, info).orderBy("doc_id").collect())
    assert seen > unseen + 1


# 7
@pytest.mark.parametrize("cell, block", [(1 << 15, 1024), (8, 5)])
def test_jaccard_join(spark, cell, block):
    rng = random.Random(4)
    base = [[f"w{rng.randrange(400)}" for _ in range(rng.randrange(6, 80))] for _ in range(30)]
    hot = [f"h{i}" for i in range(9)]
    rows = []
    for k, b in enumerate(base):
        for _ in range(rng.randrange(1, 12)):
            w = list(b)
            for _ in range(rng.randrange(0, 4)):
                w[rng.randrange(len(w))] = f"e{rng.randrange(30)}"
            rows.append(" ".join(w if k % 3 else hot + w))
    rows += ["", None, " ", "a b", "A  b", "a b c", *[" ".join([*hot, f"t{i}", "u"]) for i in range(40)], " ".join(hot)]
    rng.shuffle(rows)
    data = [(100 + 3 * i, t) for i, t in enumerate(rows)] + [(None, rows[0]), (100, rows[0])]
    sets = []
    for i, t in data:
        w = words(t)
        sets.append(frozenset(tuple(w[j : j + 5]) for j in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    ids = [-1 if i is None else i for i, _ in data]
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x in range(len(data)):
        for y in range(x):
            m = len(sets[x] & sets[y])
            if m and 100 * m >= 80 * len(sets[x] | sets[y]):
                a, b = sorted((find(ids[x]), find(ids[y])))
                parent[b] = a
    want = sorted(((i, len(s), None if find(j) == -1 else find(j)) for (i, _), s, j in zip(data, sets, ids)), key=str)
    df = spark.createDataFrame([(*r, 1, 2) for r in data], "doc_id long, text string, id int, rep int").repartition(4)
    assert table(jaccard_join.jaccard_join(df, cell=cell, block=block), "doc_id", "n_shingles", "component_id") == want
    left = [r["doc_id"] for r in jaccard_join.one_of_each(df).collect()]
    assert sorted(map(str, left)) == sorted(map(str, {c for _, _, c in want}))
    assert jaccard_join.jaccard_join(df.limit(0)).count() == 0


def test_one_of_each_drops_only_rows_whose_texts_link(spark):
    text = lambda k: " ".join(f"t{k}w{i}" for i in range(20))
    rows = [(None, text(0), 1), (None, text(1), 2), (None, text(1), 1), (7, text(2), 1), (7, text(3), 1), (8, text(3), 1), (9, text(4), 1), (None, text(4) + " more", 1)]
    left = jaccard_join.one_of_each(spark.createDataFrame(rows, "doc_id long, text string, part int")).collect()
    want = [(None, text(0), 1), (None, text(1), 1), (7, text(2), 1), (7, text(3), 1), (None, text(4) + " more", 1)]
    assert sorted(map(str, map(tuple, left))) == sorted(map(str, want))


def test_list_pairs_skip_no_pair():
    rng = np.random.default_rng(6)
    n = np.sort(rng.integers(1, 300, 400))
    p = (rng.random(400) * (n - np.ceil(0.8 * n) + 1)).astype(np.int64)
    c = rng.integers(0, 50, 400)
    i, j = jaccard_join.list_pairs(n, p, c, 80)
    all_ = {(a, b) for a in range(400) for b in range(a + 1, 400) if c[a] != c[b] and jaccard_join.possible(n[a], p[a], n[b], p[b], 80)}
    assert set(zip(i.tolist(), j.tolist())) == all_


def test_bitmaps_bound_what_sets_share():
    rng = np.random.default_rng(9)
    pool = rng.choice(2**50, 4000, replace=False).astype(np.uint64)
    sets = [np.sort(rng.choice(pool, n, replace=False)) for n in rng.integers(1, 900, 60)] + [pool[:500], np.sort(pool[:510])]
    bits = jaccard_join.parities(np.repeat(np.arange(62), [len(x) for x in sets]), np.concatenate(sets), np.array([len(x) for x in sets]))
    for i in range(62):
        for j in range(62):
            most = jaccard_join.most_common(bits[i], len(sets[i]), bits[j], len(sets[j]))
            assert most >= len(np.intersect1d(sets[i], sets[j]))
    assert jaccard_join.most_common(bits[60], 500, bits[61], 510) == 500


def test_group_links_connect_what_all_pairs_connect():
    rng = np.random.default_rng(8)
    base = rng.choice(2**40, 120, replace=False).astype(np.uint64)
    sets = []
    for _ in range(90):
        x = base.copy()
        at = rng.choice(120, rng.integers(0, 30), replace=False)
        x[at] = rng.choice(2**40, len(at)).astype(np.uint64)
        sets.append(np.unique(x))
    for side in (np.zeros(90, np.int64), rng.integers(0, 2, 90)):

        def classes(pairs):
            c = list(range(90))
            for i, j in pairs:
                a, b = c[i], c[j]
                c = [min(a, b) if x in (a, b) else x for x in c]
            return c

        two = side.any()
        want = [(i, j) for i in range(90) for j in range(90) if i != j and (not two or (side[i], side[j]) == (0, 1)) and 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))]
        got = jaccard_join.group_links(sets, side, 80)
        assert set(got) <= set(want) and classes(got) == classes(want) and want


# 8
def test_warc(spark, tmp_path):
    rows = [(r["page_id"], r["url"], r["html"]) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    same = "é" * 600
    rows += [(900, None, None), (901, "u u", ""), (902, "v", same), (903, "v", same), (904, "v", same), (905, "v", "x" * 999), (906, "v", "x" * 999), (None, "w", same), (904, "v", same), (907, "v", "WARC/1.1\r\n\r\n" * 90)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, keeper int").repartition(3)
    archives = warc.write(df, str(tmp_path), archive_mb=1)
    got = table(warc.read(archives, str(tmp_path)), *[x.split()[0] for x in warc.SCHEMA.split(", ")])
    last = {}
    for i, _, h in rows:
        last[h or ""] = max(last.get(h or "", -1), -1 if i is None else i)
    want = []
    for i, _, h in rows:
        raw = (h or "").encode()
        again = len(raw) >= 1000 and i != last[h or ""]
        want.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", last[h] if again else None))
    assert got == sorted(want, key=str)
    assert warc.read(warc.write(df.limit(0), str(tmp_path)), str(tmp_path)).count() == 0


def test_warc_of_a_payload_that_is_a_third_of_the_table(spark, tmp_path):
    hot, twice = "h" * 1500, "t" * 1500
    rows = [(i, "u", hot if i % 3 == 0 else twice if i in (1, 2) else f"{i} " * 400) for i in range(3000)] + [(2997, "u", hot), (None, None, hot)]
    folder = str(tmp_path)
    got = warc.read(warc.write(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4), folder, archive_mb=1), folder).collect()
    want = [(i, "response" if i not in (1, None) and (i % 3 or i == 2997) else "revisit", 2997 if i is None or (i % 3 == 0 and i != 2997) else 2 if i == 1 else None) for i, _, _ in rows]
    assert sorted(((r["page_id"], r["record_type"], r["refers_to"]) for r in got), key=str) == sorted(want, key=str)


def test_warc_records_stand_alone():
    records = [warc.record(i, f"http://x/{i}", f"<p>{'word ' * i}</p>".encode(), 5 * i + 7, hashlib.sha1(b"").hexdigest(), None, None, "2024-01-01T00:00:00Z") for i in range(300)]
    data, offsets = warc.archive(records)
    assert data[:4] == warc.SKIPPABLE.to_bytes(4, "little")
    assert all(warc.read_record(data, at) == r for at, r in zip(offsets, records))
    assert len(data) < sum(map(len, records)) / 3
    one, at = warc.archive(records[:1])
    assert warc.read_record(one, at[0]) == records[0]


# 9
def test_quality_rules(spark, docs):
    def plain(text, least=8):
        w = (text or "").encode().split()
        n = len(w)
        lines = (text or "").encode().split(b"\n")
        seen = collections.Counter(tuple(w[i : i + 3]) for i in range(n - 2))
        hit = {j for i in range(n - 2) if seen[tuple(w[i : i + 3])] > 1 for j in range(i, i + 3)}
        dup = sum(1 for i, x in enumerate(lines) if x.split() and x in lines[:i])
        longest, cover = 0, set()
        if n < 1500:
            at = collections.defaultdict(list)
            for i, x in enumerate(w):
                at[x].append(i)
            for i in range(n):
                best = 0
                for j in at[w[i]]:
                    k = 0
                    while j != i and max(i, j) + k < n and w[i + k] == w[j + k]:
                        k += 1
                    best = max(best, k)
                longest = max(longest, best)
                if best >= least:
                    cover.update(range(i, i + best))
        failed = n < 50 or 100 * len(hit) > 50 * n
        return n, sum(len(x.decode()) for x in w), sum((text or "").count(c) for c in "#*$%&|<>"), dup, len(hit), failed, longest, len(cover) / max(n, 1)

    got = quality_rules.judge(docs).collect()
    texts = collections.defaultdict(list)
    for r in docs.collect():
        texts[r["doc_id"]].append(r["text"])
    assert len(got) == docs.count()
    for r in got:
        want = plain(texts[r["doc_id"]][0])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == want[:6]
        if r["n_words"] < 1500:
            assert (r["longest_repeat"], round(r["covered_fraction"], 9)) == (want[6], round(want[7], 9))
        assert r["kept"] <= (not r["base_failed"])
    assert quality_rules.judge(docs.limit(0)).count() == 0


def test_covered_fraction_rejects_what_the_base_rule_lets_through(spark):
    new = (f"w{i}" for i in range(100_000))
    take = lambda n: [next(new) for _ in range(n)]
    passage, line, short = take(90), take(12), take(6)
    texts = {
        1: sum((passage + take(110) for _ in range(5)), []),  # 45% in repeats
        2: sum((line + take(28) for _ in range(10)), []),  # 30%
        3: sum((line + take(88) for _ in range(10)), []),  # 12%
        4: sum((short + take(14) for _ in range(20)), []),  # 30%, in repeats too short to count
        5: passage + take(500) + passage,  # 26%, one repeat
    }
    rows = quality_rules.judge(spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string")).collect()
    assert not any(r["base_failed"] for r in rows) and max(r["longest_repeat"] for r in rows) <= 100
    assert {r["doc_id"]: r["kept"] for r in rows} == {1: False, 2: False, 3: True, 4: True, 5: False}


# 10
def test_quality_classifier(spark, docs):
    rng = np.random.default_rng(0)
    p, u = rng.normal(1, 1, (4000, 1)), np.vstack([rng.normal(1, 1, (1500, 1)), rng.normal(-3, 1, (3500, 1))])
    one = lambda x: np.column_stack([x, np.ones(len(x))])
    _, prior = quality_classifier.fit_pu(one(p), one(u))
    assert 0.2 < prior < 0.4
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    odd = labels.select("doc_id", "quality").unionAll(spark.createDataFrame([(1000, None), (None, 1), (1006, 1), (1006, 1)], "doc_id long, quality int"))
    got = {}
    rows = quality_classifier.score(docs, quality_classifier.fit(docs, odd)).collect()
    for r in rows:
        got[r["doc_id"]] = r
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
        assert r["held_out"] == (zlib.crc32(str("" if r["doc_id"] is None else r["doc_id"]).encode()) % 3 == 1)
    assert len(rows) == docs.count()
    known = [(x["quality"], got[x["doc_id"]]) for x in labels.collect()]
    assert sum(q == g["predicted"] for q, g in known) / len(known) > 0.85
    assert quality_classifier.score(docs.limit(0), quality_classifier.fit(docs, odd)).count() == 0
    assert quality_classifier.score(docs, quality_classifier.fit(docs.limit(0), odd)).count() == docs.count()


def test_quality_classifier_keeps_the_labels_beside_many_unlabelled(spark):
    bad, good = "$$ ## BUY || NOW !! " * 12, "A calm sentence follows another one, and nothing in it is odd. "
    rows = [(i, f"{good * (1 + i % 3)}{i}" if i % 2 else f"{bad}{i}") for i in range(6000)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    model = quality_classifier.fit(spark.createDataFrame(rows, "doc_id long, text string"), labels, most_rows=60)
    assert np.any(model["w"])
    assert model["n_positive"] == sum(zlib.crc32(str(i).encode()) % 3 != 1 for i in range(1, 40, 2)) and model["n_unlabelled"] == 60
    # a third of the rows without an id, all alike: they count once, and the bound holds
    odd = spark.createDataFrame(rows + [(None, good)] * 3000 + [(None, f"{bad} {i}") for i in range(900)], "doc_id long, text string")
    assert quality_classifier.fit(odd, labels, most_rows=60)["n_unlabelled"] <= 60


def test_non_negative_risk_has_no_better_neighbour():
    rng = np.random.default_rng(4)
    p = np.column_stack([rng.normal(1, 1, (300, 2)), np.ones(300)])
    u = np.column_stack([np.vstack([rng.normal(1, 1, (200, 2)), rng.normal(-1, 1, (400, 2))]), np.ones(600)])

    def risk(b, prior=1 / 3, decay=1e-3):  # plain loops
        loss = lambda z: math.log1p(math.exp(-z))
        good = sum(loss(float(x @ b)) for x in p) / len(p)
        rest = sum(loss(-float(x @ b)) for x in u) / len(u) - prior * sum(loss(-float(x @ b)) for x in p) / len(p)
        return prior * good + max(0.0, rest) + decay / 2 * float(b[:-1] @ b[:-1])

    b, prior = quality_classifier.fit_pu(p, u, prior=1 / 3, steps=3000)
    assert prior == 1 / 3
    best = risk(b)
    for k in range(3):
        for step in (-0.05, 0.05):
            assert risk(b + step * np.eye(3)[k]) >= best - 2e-4
    assert best < risk(np.zeros(3)) - 0.1


def test_class_prior_of_few_positives_is_not_told_by_chance():
    rng = np.random.default_rng(9)
    draw = lambda n, at: np.column_stack([rng.normal(at, 1, (n, 1)), rng.normal(0, 1, (n, 39)), np.ones(n)])
    for size, low, high in [(1, 0.7, 0.99), (16, 0.7, 0.9)]:  # 40 features, of which one tells; 0.8 is true
        for _ in range(4):
            p, u = draw(42 * size, 2), np.vstack([draw(100 * size, 2), draw(25 * size, -3)])
            assert low <= quality_classifier.fit_pu(p, u)[1] <= high
            y = np.repeat([1.0, 0.0], [len(p), len(u)])
            seen = quality_classifier.logistic(np.vstack([p, u]), y, np.where(y == 1, 1 / len(p), 1 / len(u)))
            assert size > 1 or quality_classifier.class_prior(p @ seen, u @ seen) < 0.5  # what scores of rows that were fitted on say
    # rows that are in both groups are in one fold
    x = np.vstack([draw(42, 2), draw(60, 2), draw(25, -3)])
    fold = np.arange(len(x)) % quality_classifier.FOLDS
    of_p, of_u = quality_classifier.unseen_scores(x[:42], x, fold[:42], fold)
    assert np.allclose(of_p, of_u[:42])


def test_quality_of_the_smallest_table_and_without_positives(spark):
    read, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = quality_classifier.fit(read, labels)
    share = labels.agg({"quality": "avg"}).first()[0]
    assert abs(model["prior"] - share) < 0.15
    got = {r["doc_id"]: r for r in quality_classifier.score(read, model).collect()}
    held = [x["quality"] == got[x["doc_id"]]["predicted"] for x in labels.collect() if got[x["doc_id"]]["held_out"]]
    assert sum(held) >= 32 and len(held) == 35
    for none in (labels.limit(0), labels.filter("quality = 0"), labels.selectExpr("doc_id", "cast(null as int) as quality")):
        rows = quality_classifier.score(read, quality_classifier.fit(read, none)).collect()
        assert len(rows) == len(got) and all(r["score"] == 0.5 and r["predicted"] == 1 for r in rows)


@pytest.mark.parametrize("calibrate", ["none", "labels"])
def test_quality_of_rows_that_were_held_out(spark, calibrate):
    read = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = quality_classifier.fit(read, labels, calibrate=calibrate)
    share = labels.agg({"quality": "avg"}).first()[0]
    assert abs(model["prior"] - share) < 0.1
    got = {r["doc_id"]: r for r in quality_classifier.score(read, model).collect()}
    held = [x["quality"] == got[x["doc_id"]]["predicted"] for x in labels.collect() if got[x["doc_id"]]["held_out"]]
    assert len(held) > 80 and sum(held) / len(held) > 0.95


def test_pipeline(spark):
    import corpus_pipeline

    read = spark.read.parquet(f"{SF}/documents.parquet")
    before = read
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SF).cache()
        assert after.columns == read.columns
        assert 0.5 * before.count() < after.count() <= before.count()
        before = after
    got = corpus_pipeline.run(spark, SF)
    assert table(got, *read.columns) == table(before, *read.columns)
    assert set(read.columns) < set(got.columns)


def test_pipeline_on_odd_tables(spark, tmp_path):
    import corpus_pipeline

    plain = spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()
    names = ["_id", "_row", "_source", "topic", "kept", "weight", "id"]
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else r["doc_id"], r["text"], r["lang"], r["source"], *(f"{n}{i}" for n in names)) for i, r in enumerate(plain)]
    rows += [(None, None, None, None, *names), (None, "", "en", "s", *names)]
    schema = "doc_id long, text string, lang string, source string, " + ", ".join(f"{n} string" for n in names)
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    left = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:3]:
        left = stage(spark, left, str(tmp_path))
    texts = [r["text"] for r in left.collect()]
    assert left.columns == [c.split()[0] for c in schema.split(", ")]
    assert len(texts) > 50 and len(set(texts)) == len(texts)  # texts of one id, or of none, stay apart
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()  # with three documents a source, mixing keeps a tenth
    assert {tuple(r[c] for c in ("doc_id", "text", "lang", "source", *names)) for r in got} <= set(rows)
    assert got and {r["text"] for r in got} <= set(texts)
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_one_of_each_keeps_columns_of_any_name(spark):
    rows = [(1, "one two three four five six", "a", "mine", 7, "dot"), (2, "one two three four five six", "b", "other", 8, "dot"), (3, "", "c", "x", 9, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, key string, `_key` string, rank int, `a.b` string")
    assert sorted(map(tuple, jaccard_join.one_of_each(df).collect())) == [rows[0], rows[2]]
    assert jaccard_join.one_of_each(df).columns == df.columns


def test_null_and_empty_texts_share_a_shard(spark):
    rows = [(i, None if i % 2 else "") for i in range(10)] + [(100 + i, f"text {i}") for i in range(230)]
    got = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string")).filter("doc_id < 10").select("shard", "text_crc32").collect()
    assert len({r["text_crc32"] for r in got}) == 1 and len({r["shard"] for r in got}) <= 2


def test_movement_as_the_query_runs(spark):
    from pyspark.sql import functions as F

    df = spark.range(20_000).selectExpr("id AS doc_id", "concat('text ', id) AS text")
    a, b = (sharding.shard(df, shards=n).select("doc_id", F.col("shard").alias(f"s{n}")) for n in (24, 25))
    moved, among_old = a.join(b, "doc_id").agg(F.count_if(F.expr("s24 <> s25")), F.count_if(F.expr("s24 <> s25 AND s25 < 24"))).first()
    assert moved / 20_000 < 0.09 and among_old / 20_000 < 0.05  # 0.04 is needed


def test_ngram_lm_seeks_children_by_their_context(spark):
    """A child's value names its context, so shards hold no pointers beside it; slices grow with the number of shards that each visits."""
    info = ngram_lm.build(spark.createDataFrame([("a b c a b",), ("b c a",), (None,)], "text string"))
    model = ngram_lm.Trie(info)
    assert all(not any(k.startswith("p.") for k in arrays) for level in (2, 3) for arrays in model.level[level])
    t = ngram_lm.Tokens(pa.array(["a b", "c c", "x a b c"]))
    assert [x.tolist() for x in t.n[None]] == [[3, 3, 5]]
    counts, _, p = ngram_lm.token_scores(model, t, 1)
    assert counts.tolist() == [3, 3, 3, 2, 2, 3, 0, 3, 3, 2, 3] and np.isfinite(p).all()
    assert [ngram_lm.grown(2, n) for n in (1, 255, 256, 512, 4096)] == [2, 2, 4, 8, 8]


def test_ngram_lm_numbers_keys_as_unique_does():
    """Keys are sorted in one word with their places, where both fit, and fingerprints meet by hashing: neither sorts places."""
    rng = np.random.default_rng(4)
    for bits in (3, 20, 63):  # the last doesn't fit
        key = rng.integers(0, 1 << bits, 5000, dtype=np.uint64)
        for got in (ngram_lm.numbered(key, bits), ngram_lm.numbered_hashes(key)):
            assert all(np.array_equal(a, b) for a, b in zip(got, np.unique(key, return_inverse=True)))
        assert np.array_equal(ngram_lm.order_of(key, bits), np.argsort(key, kind="stable"))
    assert [x.tolist() for x in ngram_lm.numbered(key[:0], 3)] == [[], []]


def test_ngram_lm_cuts_words_of_parts_of_a_slice(monkeypatch):
    texts = pa.array(["a b  A", None, "", "b " * 50, " c"])
    whole = ngram_lm.Tokens(texts)
    monkeypatch.setattr(ngram_lm, "CUT", 3)
    parts = ngram_lm.Tokens(texts)
    for name in ("h", "of", "prev", "first", "n"):
        assert np.array_equal(getattr(whole, name), getattr(parts, name))
    assert whole.n.tolist() == [4, 1, 1, 51, 2] and (whole.h[whole.prev[whole.first[:-1]]] == ngram_lm.END).all()
    assert [ngram_lm.piece_of(n) for n in (1, 128, 256, 4096)] == [3 << 20, 3 << 20, 6 << 20, 6 << 20]


def test_ngram_lm_asks_cells_and_opens_no_others(spark, monkeypatch):
    """Tasks map level 1 alone, whatever the number of shards; a cell has its own file. Frequent words are cut into several cells, and a model of two levels learns its third while it scores."""
    from pyspark.sql import functions as F

    rng = np.random.default_rng(6)
    texts = [" ".join(f"w{k}" for k in rng.zipf(1.3, 60) % 400) for _ in range(60)] + [None, "", " new words only"]
    docs = spark.createDataFrame([(k if k else None, t) for k, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    train = docs.filter(~ngram_lm.held_out()).select(F.col("text"))

    def scores(info):
        got = ngram_lm.score(docs, info).collect()
        assert len(got) == len(texts)
        return {r["doc_id"]: tuple(r)[1:] for r in got}

    whole, two = ngram_lm.build(train), ngram_lm.build(train, levels=2)
    assert set(ngram_lm.trie(whole).level) == {1} and 3 not in two["files"]
    assert scores(whole) == scores(two)
    monkeypatch.setattr(ngram_lm, "CELL", 100)
    cut = ngram_lm.build(train)
    assert len(cut["files"][3]) == cut["cell0"][-1] > len(cut["files"][2]) and cut["ngrams"] == whole["ngrams"]
    model, want = ngram_lm.Trie(cut), scores(whole)
    for k, got in scores(cut).items():
        t = ngram_lm.Tokens(pa.array([texts[k or 0]], pa.string()))
        assert got[:5] == want[k][:5] and got[5] == pytest.approx(want[k][5], abs=0.02 * len(t.of))
        assert got[5] == pytest.approx(ngram_lm.token_scores(model, t, 1)[2].sum(), abs=1e-5 * len(t.of))


def test_ngram_lm_packs_numbers_of_any_size():
    some = [np.array([0, 255, 3], np.uint32), np.zeros(0, np.int64), np.array([2**64 - 1, 0], np.uint64), np.array([1 << 40])]
    for a, b in zip(some, ngram_lm.unpacked(*ngram_lm.packed(*some), *map(len, some))):
        assert a.tolist() == b.tolist()
