"""Main text of pages, hard negatives and divergence of sources: planted pages, and plain versions on odd tables."""

import html
import math
import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest

from ladderlake.llm import hard_negatives, html_extraction, source_divergence
from ladderlake.llm.html_extraction import Page, density, main_text, states

SF = "/root/testdata/sf0.001"
LONG = "A sentence of the article that goes on for a while, so that its paragraph is one of some length."
ARTICLE = f"<h1>The title</h1><p>{LONG}</p><p>Short.</p><p>One more, with <b>bold</b> words, <a href='/x'>a link</a> &amp; a char&shy;acter.<br>{LONG}</p>"
WANT = f"The title {LONG} Short. One more, with bold words, a link & a char\xadacter. {LONG}"
LINKS = '<a href="/">Home</a> <a href="/n">News of the day</a> <a href="/s">Sports and more</a>'
LAYOUTS = {
    "plain blocks": f"<html><body><div>{LINKS}</div><div>{ARTICLE}</div><div>{LINKS}</div></body></html>",
    "header and footer": f"<body><header><h1>The site</h1>{LINKS}</header><div class='content'>{ARTICLE}</div><footer>{LONG}</footer></body>",
    "comments by name": f"<body><article>{ARTICLE}</article><div id='comments'><h3>What others say</h3><div class='comment'><p>{LONG * 4}</p></div></div></body>",
    "comments by heading": f"<body><article>{ARTICLE}<section><h2>3 Comments</h2><article><p>{LONG * 3}</p></article></section></article></body>",
    "form around the page": f"<body><form id='all'><nav>{LINKS}</nav><article>{ARTICLE}</article></form></body>",
    "header of the article": f"<body><main><article><header><h1>The title</h1><p>By someone</p></header>{ARTICLE[18:]}</article></main></body>",
    "sidebars and notices": f"<body><article>{ARTICLE}<aside>{LONG}</aside><div class='share-buttons'>Share</div></article><div class='cookieNotice'>{LONG * 4}</div><p hidden>{LONG}</p></body>",
    "main": f"<body><main>{ARTICLE}</main><div class='left sidebar'><p>{LONG}</p></div></body>",
    "open tags": f"<body><nav><ul><li><a href='/'>Home<li>More</ul></nav><article>{ARTICLE.replace('</p>', '')}<footer>{LONG}",
    "named around": f"<body class='has-sidebar'><div id='page-sidebar-wrapper'><div class='ad'>{LONG}</div><article>{ARTICLE}</article></div></body>",
    "table": f"<TABLE><TR><TD>{LINKS}<TD>{ARTICLE}<TD></TABLE>",
    "scripts": f"<head><title>The title</title><style>p {{}}</style></head><article><script>var t = '</p><p>' < 1;</script><!-- <p>no</p> -->{ARTICLE}</article><script>never closed <p>{LONG}</p>",
}


@pytest.mark.parametrize("name", sorted(LAYOUTS))
def test_layouts(name):
    assert main_text(LAYOUTS[name]) == WANT


def test_odd_pages():
    for source, want in [(None, ""), ("", ""), (" \n", ""), ("just text", "just text"), ("<", "<"), ("a < b", "a < b"), ("<p>a", "a"), ("<!--", ""), ('<a "', ""), ("<script>x", ""), ("&am", "&am"), ("&#65;&nbsp;&lt;p&gt;", "A <p>"), ('<p title="a>b">c</p>', "c"), ("<td>x</td>", "x"), ("<p>a<p>b", "a b"), ("a<b>b</b>c", "abc"), ("<nav>only a menu</nav>", "")]:
        assert main_text(source) == want, source
    for source in ["<div>" * 20_000 + "x", "<i>" * 20_000 + "x", "<p>x" * 20_000, "</x>" * 20_000, '<a ="' * 20_000, "<li>x" * 20_000]:  # in time that grows with the length
        main_text(source)


def test_densities_are_those_of_a_plain_recursion():
    p = Page(LAYOUTS["sidebars and notices"])
    state = states(p)
    children = defaultdict(list)
    for v, u in enumerate(p.parent):
        children[u].append(v)

    def counts(v):
        if state[v]:
            return (0, 0, 0, 0)
        return tuple(map(sum, zip((p.c[v], p.t[v], p.lc[v], p.lt[v]), *map(counts, children[v]))))

    def plain(v):
        c, t, lc, lt = (max(x, 1) for x in counts(v))
        (c_b, _, lc_b, _), k = counts(0), max(counts(v)[0] - counts(v)[2], 1)
        return c / t * math.log(c / lc * t / lt, math.log(c / k * lc + lc_b / c_b * c + math.e)) if counts(v)[0] else 0

    live = [v for v in range(len(p.parent)) if not state[v]]
    assert len(live) > 8
    for v in live:
        assert density(*counts(v), counts(0)[0], counts(0)[2]) == pytest.approx(plain(v))


def test_pages_of_the_tables(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    odd = [(-1, None, None, "x", 7), (-1, "u", "", "x", 7), (None, "u", "<p>a  b</p>", "x", 7), (None, "u", "<p>a  b</p>", "x", 7)]
    table = spark.createDataFrame([(r["page_id"], r["url"], r["html"], "x", 1) for r in pages] + odd, "page_id long, url string, html string, text string, n_chars int").repartition(3)
    got = Counter(map(tuple, html_extraction.extract(table).collect()))
    want = Counter({(-1, None, "", 0): 1, (-1, "u", "", 0): 1, (None, "u", "a b", 3): 2})
    for r in pages:
        inner = re.sub(r"</?(?:p|h1|br)\b[^>]*>", " ", re.search(r"<article>(.*?)</article>", r["html"], re.S)[1])
        text = " ".join(html.unescape(re.sub(r"<[^>]*>", "", inner)).split())
        want[(r["page_id"], r["url"], text, len(text))] += 1
    assert got == want
    assert html_extraction.extract(table.limit(0)).collect() == []


def in_sql(sql, **tables):
    c = duckdb.connect()
    for name, (schema, rows) in tables.items():
        c.execute(f"CREATE TABLE {name} ({schema})")
        if rows:
            c.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' * len(rows[0]))})", rows)
    return Counter(c.execute(sql).fetchall())


def vectors(seed, n=260, d=12):
    rng = random.Random(seed)
    rows = [(i * 10, [rng.gauss(0, 1) + 2 * (k == i % 3) for k in range(d)], i % 3) for i in range(n)]
    rows += [(7 + 10 * i, rows[5][1], i % 2) for i in range(40)]  # one common vector
    rows += [(100, [0.5] * d, 1), (100, [0.5] * d, 1), (200, [0.25] * d, None), (300, None, 1), (400, [None] * d, 1), (500, [float("nan")] * d, 0), (600, [float("inf")] + [0.0] * (d - 1), 0), (None, [0.5] * d, 2), (None, [0.5] * d, 0), (-700, [-1.0] * d, 1), (800, [0.0] * d, 2)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_hard_negatives_are_those_of_all_products(spark, seed, monkeypatch):
    monkeypatch.setattr(hard_negatives, "TILE", 7)
    monkeypatch.setattr(hard_negatives, "SLICE", 50)
    rows = vectors(seed)
    table = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], "vec_id long, embedding array<float>, label int, id int, v int, score string").repartition(3)
    label = spark_label()
    run = lambda **k: Counter(map(tuple, hard_negatives.hard_negatives(table, anchors(), label=label, **k).collect()))
    want = in_sql(hard_negatives.SQL, embeddings=("vec_id BIGINT, embedding FLOAT[], label INT", rows))
    assert len(want) > 50
    assert run() == want
    assert run(pass_bytes=2000) == want  # in several passes


def spark_label():
    from pyspark.sql import functions as F

    return F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))


def anchors():
    from pyspark.sql import functions as F

    return F.col("vec_id") % 100 == 0


def test_hard_negatives_of_odd_tables(spark):
    schema = "vec_id long, embedding array<float>, label int"
    for rows in ([], [(100, [1.0], 1)], [(1, [1.0], 1), (2, [1.0], 2)], [(100, [], 1), (101, [], 1), (102, [], 2)]):
        got = hard_negatives.hard_negatives(spark.createDataFrame(rows, schema), anchors()).collect()
        assert [tuple(r) for r in got] == ([(100, 101, 1, 102, 0, 0)] if len(rows) == 3 else [])
    uneven = [(100, [1.0, 1.0], 1), (101, [1.0], 1), (102, [0.75, 0.0, 9.0], 2), (103, [0.875], 2)]
    assert [tuple(r) for r in hard_negatives.hard_negatives(spark.createDataFrame(uneven, schema), anchors()).collect()] == [(100, 101, 1, 103, 65536, 57344)]
    large = [(100, [1e6, 1.0], 1), (101, [0.0078125, 0.0], 1), (102, [0.00390625, 99.0], 2), (103, [0.0078125, 0.0], 2)]
    assert {tuple(r)[:4] for r in hard_negatives.hard_negatives(spark.createDataFrame(large, schema), anchors()).collect()} == {(100, 101, 1, 103)}
    with pytest.raises(Exception, match="64 bits"):
        hard_negatives.hard_negatives(spark.createDataFrame([(100, [1e12], 1), (101, [1e12], 1)], schema), anchors()).collect()


def test_partial_products_discard_before_the_end():
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 16)) * np.array([8.0] * 2 + [0.1] * 14)
    batch = pa.record_batch({"id": np.arange(400), "v": pa.array(list(x)), "label": np.zeros(400, np.int64)})
    v = hard_negatives.Vectors(batch, 16, 256, np.eye(16), [2, 4, 8, 16])
    all_scores = (v.x @ v.x.T).astype(np.int64)
    low = np.sort(all_scores, axis=1)[:, -5]
    seen = []
    real = hard_negatives.products
    try:
        hard_negatives.products = lambda a, i, x, j: seen.append(len(i)) or real(a, i, x, j)
        i, j, score = hard_negatives.survivors(v, np.arange(400), v, np.arange(400), low, np.full(400, 1 << 60), [2, 4, 8, 16])
    finally:
        hard_negatives.products = real
    assert sum(seen) < 0.05 * 400 * 400
    assert set(zip(i, j)) == set(zip(*np.nonzero(all_scores >= low[:, None])))
    assert (score == all_scores[i, j]).all()


def plain_divergence(rows):
    lower = str.maketrans(source_divergence.UPPER, source_divergence.LOWER)
    count, df, groups = Counter(), Counter(), set()
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        words = [w.translate(lower) for w in re.findall(source_divergence.TERM, text or "")]
        count.update((lang, source, w) for w in words)
        df.update((lang, w) for w in set(words))
    out = Counter()
    for lang, source in groups:
        kept = [w for (x, w), n in df.items() if x == lang and n >= 10]
        sources = sorted(s for x, s in groups if x == lang)
        n = {s: {w: count[lang, s, w] for w in kept} for s in sources}
        n[None] = {w: sum(n[s][w] for s in sources) for w in kept}
        p = {s: {w: 1 + 10**9 * (c + 2) // (sum(by.values()) + 2 * len(kept)) for w, c in by.items()} for s, by in n.items()}
        f = lambda w, other: (p[source][w] - p[other][w]) ** 2 // (p[source][w] + p[other][w])
        pairs = sorted((-sum(f(w, s) for w in kept), s.encode()) for s in sources if s != source)
        terms = sorted((-f(w, None), w.encode()) for w in kept if n[source][w] and p[source][w] > p[None][w])[:10]
        for part, found in (("pair", pairs), ("term", terms)):
            out.update((lang, source, part, item.decode(), -v, r) for r, (v, item) in enumerate(found, 1))
    return out


def test_divergence_is_that_of_plain_counts(spark):
    docs = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    docs += [(1, None, "en", "none"), (2, "", None, None), (3, "12 34", "xx", "a"), (4, "\U00010400 \U0001f600 É é ÀB c", "xx", "b"), (5, "x " * 60_000, "en", "long"), (5, "x " * 60_000, "en", "long"), (6, "Tie tie", None, "t")]
    docs += [(None, "Tie tie One", None, s) for s in ("s", "t", "Ü") for _ in range(6)]
    extra = "term string, n int, item string, p long, v long, rank int"
    table = spark.createDataFrame([(*r, *([None] * 6)) for r in docs], f"doc_id long, text string, lang string, source string, {extra}").repartition(4)
    got = Counter(map(tuple, source_divergence.divergence(table).collect()))
    assert got == plain_divergence(docs)
    assert got == in_sql(source_divergence.SQL, documents=("doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR", docs))
    assert source_divergence.divergence(table.limit(0)).collect() == []


def test_divergence_lowers_ascii_in_one_pass(spark):
    docs = spark.createDataFrame([("l", "s", "AbC Éa abc İ \U00010400Z")], "lang string, source string, text string")
    counts = source_divergence.counted(docs)
    assert "replace(" not in counts._jdf.queryExecution().optimizedPlan().toString()
    assert {(r["term"], r["n"], r["n_docs"]) for r in counts.collect()} == {("abc", 2, 1), ("Éa", 1, 1), ("İ", 1, 1), ("\U00010400z", 1, 1)}
