"""How far the sources of a language differ in their words: smoothed shares in whole numbers, summed for each two sources, ranked.

Terms are counted for each language and source on the way into the one shuffle of terms, with the documents that hold them. A
language keeps the terms of at least `min_docs` documents. Its sources are crossed with that vocabulary, in parts by a hash of the
term, so every source has every kept term, with zeros. A self-join on language and term gives each two sources' shares side by side.

All arithmetic is exact: p = 1 + floor(SCALE * (count + 2) / (N + 2 * V)) is divided as decimals of 38 digits; differences are squared
as longs, since p is at most SCALE + 1. The value of a pair is the same both ways, so it is summed once.

Nulls in text, lang and source are empty strings, and those are a language or source like any other. Texts without terms still make
their source occur. Repeated rows count as documents of their own. Ties of value stand by the bytes of the item. Empty table: empty
result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._scratch import written

#: What a term is, and what shares are multiples of.
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
GAP = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
SCALE = 1_000_000_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Parts into which a language's vocabulary is dealt before its sources are crossed with it.
PARTS = 64


def counted(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, n_docs): a term's occurrences in a source of a language, and how many of its documents hold it. A text is lower-cased in one pass, then parted at what no term holds; its list of terms and that of its distinct terms are counted side by side."""
    text = F.translate("text", UPPER, LOWER)
    lists = docs.select("lang", "source", F.split(text, GAP).alias("words")).select("lang", "source", F.posexplode(F.array("words", F.array_distinct("words"))).alias("k", "words"))
    terms = lists.select("lang", "source", "k", F.explode("words").alias("term")).filter("term <> ''")
    return terms.groupBy("lang", "source", "term").agg(F.count_if(F.col("k") == 0).alias("n"), F.count_if(F.col("k") == 1).alias("n_docs"))


def share(n: str, total: str, v: str) -> Column:
    return F.expr(f"1 + CAST({SCALE} AS DECIMAL(10,0)) * CAST({n} + 2 AS DECIMAL(19,0)) div CAST({total} + 2 * {v} AS DECIMAL(19,0))").cast("long")


def apart(p: str, q: str) -> Column:
    return F.expr(f"({p} - {q}) * ({p} - {q}) div ({p} + {q})")


def divergence(docs: DataFrame, min_docs: int = 10, most_terms: int = 10, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(lang, source, part, item, value, rank): for each source of a language, every other source by its distance from it (part pair), and the `most_terms` terms that the source has more of than the language, by their share of the distance from it (part term)."""
    col = lambda c, name: F.coalesce(F.col("`" + c.replace("`", "``") + "`"), F.lit("")).alias(name)
    docs = docs.select(col(lang_col, "lang"), col(source_col, "source"), col(text_col, "text"))
    counts = written(counted(docs), "terms")
    groups = written(docs.select("lang", "source").distinct(), "sources")
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs")).filter(F.col("n_docs") >= min_docs).drop("n_docs")
    kept = written(kept, "vocabulary")
    sizes = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("n").alias("all_n"))
    held = counts.join(kept.select("lang", "term", F.col("n").alias("lang_n")), ["lang", "term"]).select("lang", "source", "term", "n", "lang_n")
    totals = held.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = groups.join(totals, ["lang", "source"], "left").join(sizes, "lang", "left").select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("v", F.lit(0)).alias("v"), F.coalesce("all_n", F.lit(0)).alias("all_n"))
    groups = written(groups, "sources")

    # every source with every kept term of its language: a vocabulary's part meets all sources, so no task gets a whole language
    dealt = kept.select("lang", "term", F.pmod(F.xxhash64("term"), F.lit(PARTS)).alias("deal"))
    crossed = dealt.join(groups.select("lang", "source", "total", "v", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(PARTS - 1).cast("long"))).alias("deal")), ["lang", "deal"])
    dense = crossed.join(held.select("lang", "source", "term", "n"), ["lang", "source", "term"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    dense = written(dense.select("lang", "term", "source", share("n", "total", "v").alias("p")), "shares")
    both = dense.select("lang", "term", F.col("source").alias("a"), "p").join(dense.select("lang", "term", F.col("source").alias("b"), F.col("p").alias("q")), ["lang", "term"]).filter("a < b")
    sums = both.groupBy("lang", "a", "b").agg(F.sum(apart("p", "q")).alias("value"))
    ways = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    sums = sums.select("lang", ways.alias("w"), "value").select("lang", "w.*", "value")
    others = groups.select("lang", "source").join(groups.select("lang", F.col("source").alias("item")), "lang").filter("source <> item")
    ranked = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = others.join(sums, ["lang", "source", "item"], "left").withColumn("value", F.coalesce("value", F.lit(0)))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(ranked).alias("rank"))

    more = held.join(groups, ["lang", "source"]).select("lang", "source", F.col("term").alias("item"), share("n", "total", "v").alias("p"), share("lang_n", "all_n", "v").alias("q"))
    terms = more.filter("p > q").withColumn("value", apart("p", "q")).withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= most_terms)
    return pairs.unionByName(terms.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))


def op13_source_divergence(spark, sf_dir: str) -> DataFrame:
    """Every source of every language of documents, against the other sources and against the language."""
    return divergence(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
t AS (SELECT id, lang, source, translate(unnest(regexp_extract_all(text, '{TERM}')), '{UPPER}', '{LOWER}') AS term FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM t GROUP BY ALL),
k AS (SELECT lang, term, count(*) AS n FROM t GROUP BY ALL HAVING count(DISTINCT id) >= 10),
g AS (SELECT DISTINCT lang, source FROM d),
l AS (SELECT lang, count(*) AS v, sum(n) AS total FROM k GROUP BY lang),
x AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.n AS lang_n FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
s AS (SELECT lang, source, sum(n) AS total FROM x GROUP BY ALL),
p AS (SELECT lang, source, term, x.n, CAST(1 + CAST({SCALE} AS HUGEINT) * (x.n + 2) // CAST(s.total + 2 * l.v AS HUGEINT) AS HUGEINT) AS p, CAST(1 + CAST({SCALE} AS HUGEINT) * (x.lang_n + 2) // CAST(l.total + 2 * l.v AS HUGEINT) AS HUGEINT) AS q FROM x JOIN s USING (lang, source) JOIN l USING (lang)),
b AS (SELECT a.lang, a.source, o.source AS item, sum((a.p - o.p) * (a.p - o.p) // (a.p + o.p)) AS value FROM p a JOIN p o ON a.lang = o.lang AND a.term = o.term AND a.source <> o.source GROUP BY ALL),
r AS (SELECT g.lang, g.source, 'pair' AS part, o.source AS item, coalesce(b.value, 0) AS value FROM g JOIN g o ON g.lang = o.lang AND g.source <> o.source LEFT JOIN b ON b.lang = g.lang AND b.source = g.source AND b.item = o.source
  UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p WHERE n > 0 AND p > q),
w AS (SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM r)
SELECT * FROM w WHERE part = 'pair' OR rank <= 10
"""
