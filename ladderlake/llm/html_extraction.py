"""The main text of web pages by composite text density.

A page becomes a tree of blocks in one pass over its tags. A block is an element that browsers set apart, or a run of text and inline elements between
two of these. Scripts, forms, navigation, footers, sidebars and elements whose class, id or role says that they are adverts,
notices, comments or the like are left out of all counts, and so are sections headed as comments or the like. For each block of the rest, with C characters, T tags, and LC and LT
of them in links (b: of the body; K = C - LC; zeros count as 1):

    density = C / T * log((C / LC) * (T / LT)) / log(log(C / K * LC + LC_b / C_b * C + e))

and a block's sum is that of its children's densities. The block of the largest sum, sought inside `article` and `main` where a page
has such with text, is the seed. The least density on the way from the seed to the body is the threshold. The result is the seed's
`article`, or without one every block that reaches the threshold, cut to the block of the largest sum inside it, and headings
beside the way.

Text is whole: character references are decoded, white space inside a block becomes one space, blocks are joined by one. Null or
empty pages, and those without main text, give ''. Broken markup is closed as browsers do, roughly. Every page is one row, repeated pages too, whatever its id or url; other
columns are ignored, whatever their names. Time and memory grow with a page's length.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._text import slices

TOKEN = re.compile(r"""<!--(?:.*?-->|.*+)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]|=\s*+(?:"[^"]*+"|'[^']*+')|=)*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)""", re.S)
NAMED = re.compile(r"""(?:^|[\s"'/])(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?(?=[\s/>]|$)""", re.I)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose text is no markup.
RAW = {t: re.compile(rf"</{t}(?=[\s/>]|\Z)", re.I) for t in "script style title textarea xmp iframe noembed noframes".split()}
BLOCKS = HEADINGS | frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split())
HEAD = frozenset("head base link meta noscript script style template title".split())
DROPPED = frozenset("aside button canvas datalist dialog footer form head input label menu nav noscript object audio option search select svg math template video".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search status tablist toolbar tooltip".split())
#: Words of class and id that name what isn't the article; the second kind as beginnings of words.
HINTS = frozenset("ad ads adv adbox adslot adsense banner callout comment comments cta disqus dfp foot gdpr login menu modal nav navbar notice pager popup popover promo prefs rail reply replies respond share sharing shop sidebar sidenav signin signup skip social teaser toast toc toolbar topbar tracking widget".split())
BEGINNINGS = ("advert", "breadcrumb", "comment", "consent", "cookie", "copyright", "disclaimer", "discussion", "footer", "masthead", "navigation", "newsletter", "notification", "pagination", "paywall", "recommend", "related", "sidebar", "sponsor", "subscri")
#: Headings of a part that isn't the article, where nothing stands before them in that part.
OTHERS = re.compile(r"\W*(?:\d+\s+)?(?:reader |user )?(?:comments?|responses?|replies|discussion|leave a (?:reply|comment)|related (?:articles?|stories|posts)|you may also like|newsletter|advertisement)\W*\d*\W*", re.I)
CONTENT = frozenset("article content entry main post story".split())
#: An element of these kinds ends an open one of those, where nothing of the third stands between.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th", "caption"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tbody": ({"tbody", "thead", "tfoot", "caption"}, {"table"}), "thead": ({"tbody", "caption"}, {"table"}), "tfoot": ({"tbody", "thead"}, {"table"}), "option": ({"option"}, {"select"})}
NONE, HEADER, OUT = 0, 1, 2


@lru_cache(1 << 14)
def judged(tag: str, attributes: str) -> tuple[int, bool]:
    """(NONE, HEADER or OUT, whether names say that it holds an article) by the element's kind and attributes."""
    out, content = OUT if tag in DROPPED else HEADER if tag == "header" else NONE, tag in ("article", "main")
    for m in NAMED.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "role":
            content |= value.lower() == "main"
            out = OUT if value.lower() in ROLES else out
        elif name == "style":
            out = OUT if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I) else out
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            out = OUT
        elif name in ("class", "id"):
            for part in value.split():
                words = [w.lower() for w in WORD.findall(part)]
                content |= bool(CONTENT & set(words)) and tag not in ("body", "html")
                if words and words[0] not in ("has", "no", "with", "without"):
                    if any(w in HINTS or w.startswith(BEGINNINGS) for w in words):
                        out = OUT
                    elif "header" in words:
                        out = max(out, HEADER)
    return (NONE if tag in ("html", "body", "main") else out), content


class Page:
    """Blocks in page order, each with its parent, kind and counts; the pieces of text with the block of each."""

    def __init__(self, source: str) -> None:
        self.parent, self.kind, self.own, self.content = [-1], ["html"], [NONE], [False]
        self.c, self.t, self.lc, self.lt = [0], [0], [0], [0]
        self.pieces: list[tuple[int, str]] = []
        self._open: list[tuple[str, int, int, int]] = [("html", 0, 0, 0)]  # kind, block, links around, inline elements around that are left out
        self._count = Counter(["html"])  # open elements by kind
        self._run = -1
        self._read(source)

    def _block(self, kind: str, own: int = NONE, content: bool = False) -> int:
        self.parent.append(self._open[-1][1])
        self.kind.append(kind)
        self.own.append(own)
        self.content.append(content)
        for counts in (self.c, self.t, self.lc, self.lt):
            counts.append(0)
        return len(self.parent) - 1

    def _here(self) -> int:
        """The run that text and inline elements join."""
        if self._run < 0:
            self._run = self._block("#run")
        return self._run

    def _apart(self) -> None:
        self._run = -1
        self.pieces.append((self._open[-1][1], " "))

    def _text(self, text: str) -> None:
        _, _, links, out = self._open[-1]
        if out:
            return
        if text.isspace():
            self.pieces.append((self._run if self._run >= 0 else self._open[-1][1], " "))
            return
        if "&" in text:
            text = html.unescape(text)
        at = self._here()
        n = len(text) if len(text) < 32 else len(" ".join(text.split()))
        self.c[at] += n
        if links:
            self.lc[at] += n
        self.pieces.append((at, text))

    def _close(self, keep: int) -> None:
        gone = [k for k, *_ in self._open[keep:]]
        blocks = any(k in BLOCKS or "-" in k for k in gone)
        self._count.subtract(gone)
        del self._open[keep:]
        if blocks:
            self._apart()

    def _last(self, kinds: set[str], stops: set[str] | frozenset[str]) -> int:
        """Place of the innermost open element of these kinds, if none of the others is in it; else 0."""
        for k in range(len(self._open) - 1, 0, -1):
            if self._open[k][0] in kinds:
                return k
            if self._open[k][0] in stops:
                return 0
        return 0

    def _start(self, tag: str, attributes: str) -> None:
        if tag in ("html", "body"):
            if tag == "html" or self._count["body"]:
                return
            self._close(1)
        elif self._count["head"] and tag not in HEAD:
            self._close(self._last({"head"}, frozenset()))
        block = tag in BLOCKS or "-" in tag
        if block and self._count["p"] and (k := self._last({"p"}, BLOCKS)):
            self._close(k)
        if tag in CLOSES:
            ends, stops = CLOSES[tag]
            while any(self._count[x] for x in ends) and (k := self._last(ends, stops)):
                self._close(k)
        own, content = judged(tag, attributes if NAMED.search(attributes) else "")
        _, inside, links, out = self._open[-1]
        if block:
            self._apart()
            at = self._block(tag, own, content)
            self.t[inside] += 1
        else:
            if tag == "br":
                self.pieces.append((self._run if self._run >= 0 else inside, " "))
            if not out and tag not in HEAD and own != OUT:
                self.t[self._here()] += 1
                self.lt[self._run] += tag == "a"
            at, out = inside, out + (own == OUT)
        if tag not in VOID:
            self._open.append((tag, at, links + (tag == "a"), out))
            self._count[tag] += 1

    def _end(self, tag: str) -> None:
        block = tag in BLOCKS or "-" in tag
        for k in range(len(self._open) - 1, 0, -1) if self._count[tag] else ():
            name = self._open[k][0]
            if name == tag:
                return self._close(k)
            if not block and (name in BLOCKS or "-" in name) or name in ("td", "th") and tag not in ("table", "tr", "tbody", "thead", "tfoot"):
                break
        if tag == "p":
            self._apart()

    def _read(self, source: str) -> None:
        at = 0
        while m := TOKEN.search(source, at):
            if m.start() > at:
                self._text(source[at : m.start()])
            at = m.end()
            if not m[2]:
                continue
            tag = m[2].lower()
            if m[1]:
                if tag not in ("html", "body", "br"):
                    self._end(tag)
            elif m[0][-1] == ">" or at < len(source):
                if tag in RAW:
                    if e := RAW[tag].search(source, at):
                        at = source.find(">", e.end()) + 1 or len(source)
                    else:
                        at = len(source)
                else:
                    self._start(tag, m[3])
        if at < len(source):
            self._text(source[at:])


def states(p: Page) -> list[int]:
    """What of the page is left out. A named block that holds every article of the page isn't; of headers inside an article, headings stay."""
    n = len(p.parent)
    holds = [0] * n
    for v in range(n):
        holds[v] = int(p.kind[v] in ("article", "main") and p.own[v] != OUT)
    every = sum(holds)
    for v in range(n - 1, 0, -1):
        holds[p.parent[v]] += holds[v]
    titles: dict[int, list[str]] = {v: [] for v in range(n) if p.kind[v] in HEADINGS and p.parent[v] == v - 1 and p.kind[v - 1] in ("section", "div")}
    for at, text in p.pieces if titles else ():
        if p.parent[at] in titles:
            titles[p.parent[at]].append(text)
    others = {p.parent[v] for v, texts in titles.items() if OTHERS.fullmatch("".join(texts))}
    state, inside = [NONE] * n, [False] * n
    for v in range(1, n):
        u, own = p.parent[v], OUT if v in others else p.own[v]
        inside[v] = inside[u] or p.content[v]
        if own and every and holds[v] == every and p.kind[v] != "article":
            own = NONE
        if own == HEADER and not inside[u]:
            own = OUT
        state[v] = max(state[u], own)
        if state[v] == HEADER and p.kind[v] in HEADINGS:
            state[v] = NONE
    return state


def density(c: int, t: int, lc: int, lt: int, c_b: int, lc_b: int) -> float:
    if not c:
        return 0.0
    t, l, k, lt = max(t, 1), max(lc, 1), max(c - lc, 1), max(lt, 1)
    return c / t * math.log(max(c / l * t / lt, 1.0)) / math.log(math.log(c / k * l + lc_b / max(c_b, 1) * c + math.e))


def chosen(p: Page, state: list[int]) -> list[bool]:
    """Which blocks' text is the result."""
    n = len(p.parent)
    c, t, lc, lt = ([x if not s else 0 for x, s in zip(counts, state)] for counts in (p.c, p.t, p.lc, p.lt))
    for v in range(n - 1, 0, -1):
        u = p.parent[v]
        for counts in (c, t, lc, lt):
            counts[u] += counts[v]
    picked = [False] * n
    if not c[0]:
        return picked
    dense = [0.0 if s else density(c[v], t[v], lc[v], lt[v], c[0], lc[0]) for v, s in enumerate(state)]
    sums = [0.0] * n
    for v in range(1, n):
        sums[p.parent[v]] += dense[v]
    for v in range(n):
        if p.kind[v] == "#run":
            sums[v] = dense[v]
    within = [0] * n  # in an article 2, in main 1
    for v in range(1, n):
        within[v] = max(within[p.parent[v]], 0 if state[v] else 2 if p.kind[v] == "article" else 1 if p.kind[v] == "main" else 0)
    region = max((w for v, w in enumerate(within) if c[v] and not state[v]), default=0)
    seed = max((v for v in range(n) if within[v] >= region and not state[v] and c[v]), key=lambda v: (sums[v], v))
    way = [seed]
    while way[-1]:
        way.append(p.parent[way[-1]])
    threshold = min(dense[v] for v in way)
    if article := [v for v in way if p.kind[v] == "article"]:
        picked[article[-1]] = True  # the outermost
    else:
        top = list(range(n))  # the block of the largest sum in each subtree
        for v in range(n - 1, 0, -1):
            u = p.parent[v]
            if (sums[top[v]], top[v]) > (sums[top[u]], top[u]):
                top[u] = top[v]
        beside = set(way)
        for v in range(n):
            if state[v] or region and not within[v]:
                continue
            if c[v] and dense[v] >= threshold:
                picked[top[v]] = True
            if p.kind[v] in HEADINGS and p.parent[v] in beside and v < seed:
                picked[v] = True
    for v in range(1, n):
        picked[v] = picked[v] or picked[p.parent[v]]
    return [x and not s for x, s in zip(picked, state)]


def main_text(source: str | None) -> str:
    if not source:
        return ""
    p = Page(source)
    here = chosen(p, states(p))
    return " ".join("".join([s if here[at] else " " if s == " " else "" for at, s in p.pieces]).split())


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi in slices(batch.column("html"), 8 << 20):
            part = batch.slice(lo, hi - lo)
            texts = [main_text(x) for x in part.column("html").to_pylist()]
            yield pa.record_batch([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page: one pass, no shuffle."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return rows.mapInArrow(_extracted, "page_id long, url string, text string, n_chars long")


def op11_html_extraction(spark, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
