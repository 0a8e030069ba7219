"""Main text of web pages by site style trees.

The pages of a host are merged into one tree: elements that have the same path of
tags and classes are one node.  A node's importance comes from entropy over the
host's pages.  Presentation: the distribution of the node's child sequences (many
different ones: important).  Content: for each text of the node, the spread over
the pages (the same text on every page: unimportant).  Both are measured in logs
to the base of the node's page count, so they lie in 0 ... 1.  An inner node mixes
its own presentation importance with the mean of its children.  Branches below
``THRESHOLD`` are removed from each page.  Hosts with under ``MIN_PAGES`` pages of a
node use the tree of all hosts; nodes that are rare there too are kept.

Elements whose tag, role, class or id says that they are no article text (menus,
footers, forms, scripts, ...) have importance 0.  Where a page has ``article`` or
``main`` elements, text outside them is dropped.  If importance would leave a page
without text, only the marked elements go (a host that repeats one article).

A word in a class or id is a weak mark, as layout wrappers carry such words too.
Names that tell a state (``has-sidebar``, ``no-comments``) mark nothing.  While no
unmarked ``article`` has text, the word marks of an element yield if it holds more
text outside links than the rest of the page, or, with an ``article`` or ``main`` in
it, more than all unmarked elements; those of comments and related items do not.
If word marks leave a page without text, importance and the other marks decide.

The text of a block is joined with single spaces, blocks with line feeds, in page
order; character references are decoded.  Null and empty pages give the empty
text, as do pages that hold only elements marked by tag, role or as hidden.  Broken markup (unclosed tags,
cut pages) is read as browsers do in outline.  Pages without a host form one host.
Each page is a row by itself, so repeated rows and ids are kept; extra columns
pass through; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import html as html_module
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import aside, ships_by_value, to_table, whole
from .records import _slices

THRESHOLD, MIN_PAGES, DECAY = 0.2, 8, 0.9

TAG = (r"<!--.*?(?:-->|\Z)|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)"
       r"(?P<rest>(?:\"[^\"]*\"|'[^']*'|[^'\">])*|[^>]*)>|<[!?][^>]*>|<[a-zA-Z/!?][^<>]*\Z")
ATTRIBUTE = r"([a-zA-Z_:][-\w:.]*)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|([a-zA-Z_:][-\w:.]*)"

# Element names and marks (fixed values).
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea xmp noembed noframes iframe".split())
INLINE = set("a abbr acronym b bdi bdo big cite code del dfn em font i ins kbd label mark q s samp "
             "small span strike strong sub sup time tt u var br img wbr".split())
NOISE_TAGS = set("head nav footer aside form script style noscript template title textarea iframe "
                 "button select option input svg math canvas object dialog menu audio video map".split())
NOISE_ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog menu "
                  "menubar toolbar form".split())
NOISE_WORDS = set("ad ads adv advert adverts advertisement advertising adsense adbox banner sponsor sponsored "
                  "promo promotion sidebar side rail nav navbar navigation menu topbar breadcrumb "
                  "breadcrumbs footer foot masthead header cookie cookies consent gdpr notice notices "
                  "popup modal overlay newsletter subscribe subscription signup login comment comments "
                  "comentarios kommentare disqus respond replies related recommended share sharing social "
                  "widget toolbar pagination pager skip search form disclaimer alert".split())
#: Names with one of these parts tell how a page is laid out, not what the element is.
STATE_WORDS = set("has no with without enabled disabled open closed".split())
#: Elements with these often hold articles and much text that is not the page's own.
OTHERS_WORDS = set("comment comments comentarios kommentare disqus respond replies related recommended".split())
CONTENT_TAGS = ("article", "main")
#: A start tag of the key closes an open element among the values.
_BLOCKS = ("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 "
           "h4 h5 h6 header hr main menu nav ol p pre section table ul").split()
CLOSES = {**{t: {"p"} for t in _BLOCKS}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"},
          "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"},
          "th": {"td", "th", "p"}, "option": {"option"}}
#: The search for an element to close ends at these.
SCOPE = set("article main section div table ul ol dl body aside nav footer form td th blockquote".split())


def _digest(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(),
                          "little", signed=True)


@dataclass
class Node:
    parent: int
    tag: str
    sign: str
    path: int
    noise: bool
    #: words of the class or id that mark it
    words: frozenset[str] = frozenset()
    children: list[int] = field(default_factory=list)


class Page:
    """Elements in page order, and blocks of ``(element, text)`` pieces."""

    def __init__(self, source: str):
        self.nodes = [Node(-1, "#root", "", 0, False)]
        self.blocks: list[list[tuple[int, str]]] = []
        self._open, self._piece, self._paths = [0], [], {"": 0}
        self._path_text = [""]
        self._read(source)
        self._end_block()

    def _read(self, source: str) -> None:
        tag, at = re.compile(TAG, re.S), 0
        while at < len(source):
            m = tag.search(source, at)
            if m is None:
                self._text(source[at:])
                return
            if m.start() > at:
                self._text(source[at:m.start()])
            at = m.end()
            name = m["name"]
            if not name:
                continue
            name = name.lower()
            if m["close"]:
                self._close(name)
                continue
            self._start(name, m["rest"])
            if name in RAW and not m["rest"].endswith("/"):
                end = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(source, at)
                at = end.end() if end else len(source)
                self._pop(len(self._open) - 1)

    def _text(self, text: str) -> None:
        if text:
            self._piece.append((self._open[-1], text))

    def _end_block(self) -> None:
        if self._piece:
            self.blocks.append(self._piece)
            self._piece = []

    def _pop(self, to: int) -> None:
        if any(self.nodes[i].tag not in INLINE for i in self._open[to:]):
            self._end_block()
        del self._open[to:]

    def _start(self, name: str, rest: str) -> None:
        if name in CLOSES:
            for k in range(len(self._open) - 1, 0, -1):
                open_tag = self.nodes[self._open[k]].tag
                if open_tag in CLOSES[name]:
                    self._pop(k)
                    break
                if open_tag in SCOPE:
                    break
        parent = self._open[-1]
        if name == "br":
            self._text(" ")
            return
        if name not in INLINE:
            self._end_block()
        marks, noise, words = _marks(name, rest)
        if name == "header" and not noise and not words:
            # a header of an article may hold its title; a page's header is no text
            noise = not any(self.nodes[i].tag in CONTENT_TAGS for i in self._open)
        sign = name + marks
        path = f"{self._path_text[parent]}>{sign}"
        if path not in self._paths:
            self._paths[path] = _digest(path)
        self.nodes.append(Node(parent, name, sign, self._paths[path], noise, words))
        self._path_text.append(path)
        if name not in INLINE:
            while self.nodes[parent].tag in INLINE:
                parent = self.nodes[parent].parent
            self.nodes[parent].children.append(len(self.nodes) - 1)
        if name not in VOID and not rest.endswith("/"):
            self._open.append(len(self.nodes) - 1)

    def _close(self, name: str) -> None:
        for k in range(len(self._open) - 1, 0, -1):
            if self.nodes[self._open[k]].tag == name:
                self._pop(k)
                return
        if name in ("p", "br"):
            self._end_block() if name == "p" else self._text(" ")

    def content(self) -> dict[int, list[str]]:
        """Texts of each element that holds text of its own; inline elements are part
        of the element around them."""
        out: dict[int, list[str]] = {}
        for block in self.blocks:
            per: dict[int, list[str]] = {}
            for i, text in block:
                while self.nodes[i].tag in INLINE:
                    i = self.nodes[i].parent
                per.setdefault(i, []).append(text)
            for i, parts in per.items():
                text = _clean(parts)
                if text:
                    out.setdefault(i, []).append(text)
        return out

    def features(self) -> set[tuple[int, bool, int]]:
        """``(path, is content, feature)``: child sequences and texts."""
        found = {(n.path, False, _digest(",".join(self.nodes[c].sign for c in n.children)))
                 for n in self.nodes[1:] if n.children and n.tag not in INLINE}
        for i, texts in self.content().items():
            found |= {(self.nodes[i].path, True, _digest(t)) for t in texts}
        return found

    def _marked(self, worded: list[bool]) -> list[bool]:
        """Elements inside marked ones, or outside the article where there is one."""
        noise = [False] * len(self.nodes)
        inside = [False] * len(self.nodes)
        for i, n in enumerate(self.nodes[1:], 1):
            noise[i] = n.noise or worded[i] or noise[n.parent]
            inside[i] = (n.tag in CONTENT_TAGS and not noise[i]) or inside[n.parent]
        return [a or not b for a, b in zip(noise, inside)] if any(inside) else noise

    def _worded(self) -> list[bool]:
        """Elements marked by words that do not yield to the text they hold."""
        words = [bool(n.words) for n in self.nodes]
        if not any(words):
            return words
        hard, soft, article, linked = ([False] * len(self.nodes) for _ in range(4))
        for i, n in enumerate(self.nodes[1:], 1):
            hard[i] = n.noise or hard[n.parent]
            soft[i] = words[i] or soft[n.parent]
            article[i] = n.tag == "article" or article[n.parent]
            linked[i] = n.tag == "a" or linked[n.parent]
        weight, plain = [0] * len(self.nodes), 0
        for block in self.blocks:
            for i, text in block:
                size = 0 if hard[i] or linked[i] else len("".join(text.split()))
                weight[i] += size
                if size and not soft[i]:
                    if article[i]:
                        return words
                    plain += size
        holds = [n.tag in CONTENT_TAGS and not h for n, h in zip(self.nodes, hard)]
        for i in range(len(self.nodes) - 1, 0, -1):
            weight[self.nodes[i].parent] += weight[i]
            holds[self.nodes[i].parent] = holds[self.nodes[i].parent] or holds[i]
        return [w and (bool(n.words & OTHERS_WORDS) or weight[i] <= (plain if holds[i] else weight[0] - weight[i]))
                for i, (w, n) in enumerate(zip(words, self.nodes))]

    def _unimportant(self, imp: dict[tuple[int, bool], float], threshold: float) -> list[bool]:
        texts = self.content()
        holds = [n.tag in CONTENT_TAGS for n in self.nodes]
        score, drop = [1.0] * len(self.nodes), [False] * len(self.nodes)
        for i in range(len(self.nodes) - 1, 0, -1):  # children come after their parents
            n = self.nodes[i]
            below = [score[c] for c in n.children]
            if i in texts:
                below.append(imp.get((n.path, True), 1.0))
            mean = sum(below) / len(below) if below else 1.0
            if n.children:
                own, part = imp.get((n.path, False), 1.0), DECAY ** len(n.children)
                mean = max(mean, (1 - part) * own + part * mean)
            score[i] = mean
            holds[n.parent] = holds[n.parent] or holds[i]
        for i, n in enumerate(self.nodes[1:], 1):
            low = score[i] < threshold and not holds[i] and n.tag not in ("html", "body", *INLINE)
            drop[i] = low or drop[n.parent]
        return drop

    def text(self, imp: dict[tuple[int, bool], float], threshold: float = THRESHOLD) -> str:
        worded, low = self._worded(), self._unimportant(imp, threshold)
        marked = self._marked(worded)
        text = self._join([a or b for a, b in zip(marked, low)]) or self._join(marked)
        if text or not any(worded):
            return text
        return self._join([a or b for a, b in zip(self._marked([False] * len(worded)), low)])

    def _join(self, drop: list[bool]) -> str:
        lines = (_clean([t for i, t in block if not drop[i]]) for block in self.blocks)
        return "\n".join(x for x in lines if x)


def _clean(parts: list[str]) -> str:
    return " ".join(html_module.unescape("".join(parts)).split())


def _marks(name: str, rest: str) -> tuple[str, bool, frozenset[str]]:
    """Class part of a signature, whether the element is marked as no text by other
    than words, and the words of its class and id that mark it."""
    noise, words = name in NOISE_TAGS, frozenset()
    if not rest.strip(" /"):
        return "", noise, words
    got: dict[str, str] = {}
    for m in re.finditer(ATTRIBUTE, rest):
        key = (m[1] or m[5] or "").lower()
        got.setdefault(key, m[2] or m[3] or m[4] or "")
    names = f"{got.get('class', '')} {got.get('id', '')}".lower().split()
    if name not in ("html", "body", *CONTENT_TAGS):
        parts = [set(re.split(r"[^a-z]+", x)) for x in names]
        words = frozenset().union(*(x & NOISE_WORDS for x in parts if not x & STATE_WORDS))
    noise = (noise or got.get("role", "").lower() in NOISE_ROLES or "hidden" in got
             or got.get("aria-hidden", "").lower() == "true"
             or re.search(r"display\s*:\s*none", got.get("style", "").lower()) is not None)
    kept = sorted(re.sub(r"\d+", "0", x) for x in got.get("class", "").lower().split())
    return "".join(f".{x}" for x in kept), noise, words


def host(url):
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][^:/]*://(?:[^/@?#]*@)?([^/:?#]+)", 1), F.lit("")))


def tree(pages: DataFrame, *, min_pages: int = MIN_PAGES) -> DataFrame:
    """The merged trees: ``host`` and its nodes ``(path, content, importance)``.

    Pages send distinct (path, feature) pairs, which are counted before and after
    the shuffle; hot hosts therefore cost no more than their distinct features."""
    def extract(batches):
        for batch in batches:
            for piece in _slices(batch, "html"):
                out = [(h, *f) for h, s in zip(piece.column("host").to_pylist(),
                                               piece.column("html").to_pylist())
                       for f in Page(s).features()]
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*out), (pa.string(), pa.int64(), pa.bool_(), pa.int64()))],
                        names=["host", "path", "content", "feature"])

    rows = pages.select(host(F.col("url")).alias("host"), whole(F.col("html")).alias("html"))
    counts = to_table(
        rows.mapInArrow(extract, "host string, path bigint, content boolean, feature bigint")
        .groupBy("host", "path", "content", "feature").agg(F.count("*").alias("k")), "style-tree")

    def importance(table: DataFrame, *keys: str) -> DataFrame:
        """With k pages of m holding feature i: presentation, the entropy of k/sum(k);
        content, 1 - the mean of log k."""
        stats = (table.groupBy(*keys, "path", "content").agg(
            F.sum("k").alias("total"), F.sum(F.col("k") * F.log(F.col("k").cast("double"))).alias("klogk"),
            F.avg(F.log(F.col("k").cast("double"))).alias("logk"), F.max("k").alias("top")))
        # A page may hold several texts of a node, so the page count is estimated from
        # presentation where there is one (one child sequence per element).
        m = F.greatest("total", F.lit(2))
        entropy = F.log(F.col("total").cast("double")) - F.col("klogk") / F.col("total")
        value = F.when(F.col("content"), 1 - F.col("logk") / F.log(m.cast("double"))).otherwise(
            entropy / F.log(m.cast("double")))
        return stats.select(*keys, "path", "content", "total", value.alias("importance"))

    own = importance(counts, "host")
    every = importance(counts.groupBy("path", "content", "feature").agg(F.sum("k").alias("k"))).select(
        "path", "content", F.col("total").alias("all_total"), F.col("importance").alias("all_importance"))
    chosen = (F.when(F.col("total") >= min_pages, F.col("importance"))
              .when(F.col("all_total") >= min_pages, F.col("all_importance")).otherwise(1.0))
    return (own.join(every, ["path", "content"], "left")
            .withColumn("importance", chosen).where(F.col("importance") < 1.0)
            .groupBy("host").agg(F.collect_list(F.struct("path", "content", "importance")).alias("nodes")))


def extract(pages: DataFrame, *, threshold: float = THRESHOLD, min_pages: int = MIN_PAGES) -> DataFrame:
    """``pages`` with the column ``text``.  The trees are a table of one row per host,
    which Spark broadcasts when small and joins by host otherwise."""
    trees = to_table(tree(pages, min_pages=min_pages), "style-trees")
    plain, back = aside(pages, "page_id", "url", "html", made=("text",))
    names = plain.columns

    def run(batches):
        for batch in batches:
            for piece in _slices(batch, "_html"):
                texts = []
                for source, nodes in zip(piece.column("_html").to_pylist(), piece.column("_nodes").to_pylist()):
                    imp = {(n["path"], n["content"]): n["importance"] for n in nodes or ()}
                    texts.append(Page(source).text(imp, threshold))
                yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in names), pa.array(texts, pa.string())],
                                                 names=[*names, "text"])

    joined = (plain.withColumn("_host", host(F.col("url"))).withColumn("_html", whole(F.col("html")))
              .join(trees.select(F.col("host").alias("_host"), F.col("nodes").alias("_nodes")), "_host", "left")
              .select(*names, "_html", "_nodes"))
    return back(joined.mapInArrow(run, T.StructType([*plain.schema.fields, T.StructField("text", T.StringType())])))


ships_by_value(__name__)
