"""Main text of web pages: boosted trees over DOM nodes, decoded along the tree.

Every block element of a page is a node with features of its own, its subtree, its siblings and its
ancestors, and of the words in its attributes. Boosted trees give the odds that its subtree holds main
text. Decoding picks the labels with the highest total odds under one rule, no kept node below a
dropped one, so ancestors and descendants never contradict each other.

The trees are fitted to generated page layouts (``layouts``), whose labels are known. Their number and
seed are parameters; nothing is learned from the pages a query reads, so a page's text never
depends on other pages.
"""

from __future__ import annotations

import html as entities
import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lakeops.llm.boosting import Boosted, fit
from lakeops.llm.common import query, table, text_slices

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template iframe svg title textarea select".split())
BLOCK = frozenset(
    "html head body article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd nav header footer aside form fieldset table caption "
    "thead tbody tfoot tr td th blockquote pre figure figcaption address details summary dialog menu hgroup center button label legend".split()
)
ENDS_P = BLOCK - {"button", "label", "legend"} | {"hr"}
#: An opening tag closes an open element of its group, up to the nearest of the fence.
GROUPS = [
    ({"li"}, {"ul", "ol", "menu"}), ({"dt", "dd"}, {"dl"}), ({"tr"}, {"table", "tbody", "thead", "tfoot"}), ({"td", "th"}, {"tr", "table"}),
    ({"thead", "tbody", "tfoot"}, {"table"}), ({"option"}, {"select"}),
]
TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^"'>]|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*>""", re.S)
ATTRIBUTE = re.compile(r"""(?:class|id|role|itemprop|aria-label)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass(slots=True)
class Node:
    tag: str
    parent: int
    depth: int
    words: frozenset
    chars: int = 0  # of the subtree from here on
    linked: int = 0
    marks: int = 0
    blocks: int = 0
    tags: int = 0
    children: list = field(default_factory=list)


def parse(page: str) -> tuple[list[Node], list[tuple[int, str]]]:
    """Block elements in page order (the first is the page itself), and (node, text) blocks."""
    nodes, blocks = [Node("page", -1, 0, frozenset())], []
    stack: list[tuple[str, int]] = [("page", 0)]  # open elements with the node their text belongs to
    parts: list[str] = []
    linked = links = at = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                node = nodes[stack[-1][1]]
                blocks.append((stack[-1][1], text))
                node.chars += len(text)
                node.linked += min(linked, len(text))
                node.marks += sum(map(text.count, ".,;:!?"))
                node.blocks += 1
            parts.clear()
        linked = 0

    def close(index: int) -> None:
        nonlocal links
        flush() if any(name in BLOCK for name, _ in stack[index:]) else None
        links -= sum(name == "a" for name, _ in stack[index:])
        del stack[index:]

    def text_to(end: int) -> None:
        nonlocal linked
        if end > at:
            parts.append(page[at:end])
            if links:
                linked += end - at

    while match := TAG.search(page, at):
        text_to(match.start())
        at = match.end()
        closing, name, rest = (match[1], match[2], match[3]) if match[2] else (match[4], match[5], match[6])
        if not name:
            continue
        name = name.lower()
        nodes[stack[-1][1]].tags += 1
        if closing:
            found = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == name), 0)
            if found and not (name not in BLOCK and any(stack[i][0] in BLOCK for i in range(found, len(stack)))):
                close(found)
            elif name == "br":
                parts.append(" ")
            continue
        if name in RAW:
            if not rest.endswith("/"):
                end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
                at = end.end() if end else len(page) if name in ("script", "style") else at
            continue
        if name in ENDS_P:
            found = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] in ("p", "button", "td", "th", "table")), 0)
            if found and stack[found][0] == "p":
                close(found)
        for group, fence in GROUPS:
            if name in group:
                found = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] in group or stack[i][0] in fence), 0)
                if found and stack[found][0] in group:
                    close(found)
        if name in VOID:
            if name == "hr":
                flush()
            elif name in ("br", "wbr"):
                parts.append(" " if name == "br" else "")
            continue
        if rest.endswith("/") and name in BLOCK:
            rest = rest[:-1]
        if name == "a":
            links += 1
        if name not in BLOCK:
            stack.append((name, stack[-1][1]))
            continue
        flush()
        words = frozenset(w.lower() for value in ATTRIBUTE.findall(rest) for w in WORD.findall(value)) if rest else frozenset()
        parent = stack[-1][1]
        nodes.append(Node(name, parent, nodes[parent].depth + 1, words))
        nodes[parent].children.append(len(nodes) - 1)
        stack.append((name, len(nodes) - 1))
    text_to(len(page))
    flush()
    return nodes, blocks


TAGS = "page html head body article main section div p h1 h2 h3 h4 ul ol li nav header footer aside form table td blockquote pre figure address".split()
TAG_AT = {tag: i for i, tag in enumerate(TAGS)}


def features(nodes: list[Node], vocabulary: dict[str, int]) -> np.ndarray:
    """One row a node: sizes, link and mark density, depth, siblings, shares, tags and attribute words, own and of ancestors."""
    n, width = len(nodes), len(vocabulary)
    own = np.array([(x.chars, x.linked, x.marks, x.blocks, x.tags, x.depth, len(x.children)) for x in nodes], float)
    parent = np.array([x.parent for x in nodes])
    total = own[:, :5].copy()
    size = np.ones(n)
    for i in range(n - 1, 0, -1):  # children come after their parents
        total[parent[i]] += total[i]
        size[parent[i]] += size[i]
    up = np.maximum(parent, 0)
    rank, count = np.zeros(n), np.ones(n)
    for x in nodes:
        for k, child in enumerate(x.children):
            rank[child], count[child] = k, len(x.children)
    tag = np.zeros((n, len(TAGS) + 1))
    tag[np.arange(n), [TAG_AT.get(x.tag, len(TAGS)) for x in nodes]] = 1
    word = np.zeros((n, width))
    for i, x in enumerate(nodes):
        for w in x.words:
            if w in vocabulary:
                word[i, vocabulary[w]] = 1
    above_tag, above_word = np.zeros_like(tag), np.zeros_like(word)
    for i in range(1, n):
        above_tag[i] = np.maximum(above_tag[parent[i]], tag[parent[i]])
        above_word[i] = np.maximum(above_word[parent[i]], word[parent[i]])
    chars, linked, marks, blocks, tags = total.T
    some = np.maximum(chars, 1)
    plain = np.stack([
        np.log1p(chars), np.log1p(own[:, 0]), linked / some, marks / some, np.log1p(blocks), chars / np.maximum(blocks, 1), tags / some,
        own[:, 5], own[:, 6], np.log1p(size), rank / np.maximum(count - 1, 1), count, chars / max(chars[0], 1), chars / np.maximum(chars[up], 1),
        linked[up] / some[up], marks[up] / some[up],
    ], axis=1)
    return np.hstack([plain, tag, above_tag, word, above_word]).astype(np.float32)


def decode(nodes: list[Node], odds: np.ndarray) -> np.ndarray:
    """Kept nodes: the labels of highest total log odds with no kept node below a dropped one."""
    drop, keep = np.zeros(len(nodes)), np.array(odds, float)
    for i in range(len(nodes) - 1, 0, -1):
        keep[nodes[i].parent] += max(keep[i], drop[i])
    kept = np.zeros(len(nodes), bool)
    for i, x in enumerate(nodes):
        kept[i] = keep[i] > 0 if i == 0 else kept[x.parent] and keep[i] > 0
    return kept


def layouts(n: int, seed: int) -> list[tuple[str, set[str]]]:
    """Generated pages with the words of their main text: menus, notices, adverts, forms, sidebars and comments in many shapes."""
    r = random.Random(seed)
    serial = iter(range(10**9))

    def word(main: bool) -> str:
        return f"{'m' if main else 'x'}{next(serial)}" + "".join(r.choice("abcdeilnorstu") for _ in range(r.randint(0, 6)))

    def text(low: int, high: int, main: bool = False) -> str:
        words = [word(main) for _ in range(r.randint(low, high))]
        return "".join(w + r.choice([" "] * 8 + [", ", ". "]) for w in words).strip() + r.choice([".", "", "!"])

    def attr(*names: str) -> str:
        shapes = ["", f' class="{r.choice(names)}"', f' id="{r.choice(names)}"', f' class="{r.choice(names)} {r.choice(["box", "clear", "wide", "row"])}"']
        return r.choice(shapes[1:])

    def maybe(chance: float, make) -> str:
        return make() if r.random() < chance else ""

    def links(low: int, high: int) -> str:
        return "".join(f'<li><a href="/{k}">{text(1, 3)}</a></li>' for k in range(r.randint(low, high)))

    def menu() -> str:
        tag = r.choice(["nav", "nav", "div", "ul"])
        name = "" if tag == "nav" and r.random() < 0.6 else attr("menu", "nav", "navigation", "navbar", "breadcrumb", "topmenu")
        return f"<{tag}{name}>{links(3, 9) if tag == 'ul' else '<ul>' + links(3, 9) + '</ul>'}</{tag}>"

    def advert() -> str:
        tag = r.choice(["div", "div", "aside", "section"])
        return f"<{tag}{attr('ad', 'ads', 'advert', 'advertisement', 'banner', 'sponsored', 'promo', 'ad-slot')}>{r.choice(['', '<p>'])}{text(2, 25)}</{tag}>"

    def notice() -> str:
        return f"<div{attr('cookie', 'cookie-notice', 'notice', 'consent', 'alert', 'popup', 'newsletter', 'subscribe', 'modal')}><p>{text(5, 30)}</p>{r.choice(['', '<button>' + text(1, 2) + '</button>'])}</div>"

    def share() -> str:
        return f"<div{attr('share', 'social', 'related', 'tags', 'meta', 'byline', 'recommended', 'pagination')}>{r.choice(['<ul>' + links(2, 6) + '</ul>', '<p>' + text(2, 8) + '</p>', text(2, 6)])}</div>"

    def form() -> str:
        return f"<form{r.choice(['', attr('search', 'login', 'contact', 'signup')])}><label>{text(1, 3)}</label><input name='q'><p>{text(1, 12)}</p><button>{text(1, 2)}</button></form>"

    def comments() -> str:
        each = "".join(f"<{t}{attr('comment', 'reply', 'comment-body')}><p>{text(3, 40)}</p></{t}>" for t in [r.choice(["div", "li", "article"])] * r.randint(1, 6))
        tag = r.choice(["div", "section", "ol"])
        return f"<{tag}{attr('comments', 'comment-list', 'discussion', 'disqus', 'responses')}>{r.choice(['', '<h3>' + text(1, 3) + '</h3>'])}{each}</{tag}>"

    def sidebar() -> str:
        tag = r.choice(["aside", "div"])
        name = "" if tag == "aside" and r.random() < 0.5 else attr("sidebar", "side", "widget", "rail", "aside")
        return f"<{tag}{name}>{r.choice(['<h3>' + text(1, 4) + '</h3>', ''])}{r.choice(['<ul>' + links(2, 7) + '</ul>', '<p>' + text(5, 40) + '</p>'])}</{tag}>"

    def head() -> str:
        tag = r.choice(["header", "div"])
        name = "" if tag == "header" and r.random() < 0.6 else attr("header", "masthead", "top", "site-header", "logo")
        return f"<{tag}{name}>{r.choice(['<h1>' + text(1, 4) + '</h1>', '<p>' + text(1, 6) + '</p>', text(1, 4)])}{maybe(0.4, menu)}</{tag}>"

    def foot() -> str:
        tag = r.choice(["footer", "footer", "div"])
        name = "" if tag == "footer" and r.random() < 0.6 else attr("footer", "copyright", "bottom", "site-footer", "legal")
        return f"<{tag}{name}>{r.choice(['&copy; ', ''])}{r.choice([text(2, 40), '<p>' + text(2, 30) + '</p>', '<ul>' + links(2, 5) + '</ul>'])}</{tag}>"

    def body() -> str:
        out = maybe(0.8, lambda: f"<h1>{text(1, 12, True)}</h1>") or f"<p>{text(1, 90, True)}{r.choice(['</p>', ''])}"
        for _ in range(r.choice([0, 1, 1, 2, 3, 5, 8])):
            kind = r.random()
            if kind < 0.72:
                words = text(1, r.choice([2, 15, 60, 120]), True)
                inner = r.choice([words, f"<b>{words}", f"<b>{words}<br>", words, f"{words} <a href='/x'>{text(1, 2, True)}</a> {text(1, 9, True)}"])
                out += f"<p>{inner}{r.choice(['</p>', '</p>', ''])}"
            elif kind < 0.8:
                out += f"<h2>{text(1, 7, True)}</h2>"
            elif kind < 0.88:
                out += "<ul>" + "".join(f"<li>{text(1, 12, True)}</li>" for _ in range(r.randint(1, 5))) + "</ul>"
            elif kind < 0.92:
                out += f"<blockquote><p>{text(4, 30, True)}</p></blockquote>"
            elif kind < 0.95:
                out += f"<table><tr><td>{text(1, 4, True)}</td><td>{text(1, 4, True)}</td></tr></table>"
            elif kind < 0.97:
                out += f"<pre>{text(3, 20, True)}</pre>"
            out += maybe(0.06, advert) + maybe(0.03, share)
        return out + maybe(0.15, share) + maybe(0.05, form)

    pages = []
    for _ in range(n):
        tag = r.choice(["article", "article", "article", "main", "div", "div", "section"])
        name = attr("content", "article", "post", "entry", "story", "main", "article-body", "post-content", "text") if tag in ("div", "section") or r.random() < 0.3 else ""
        main = f"<{tag}{name}>{body()}{maybe(0.06, comments)}</{tag}>"
        around = [maybe(0.4, head), maybe(0.8, menu), maybe(0.25, notice), maybe(0.5, advert), maybe(0.15, form), main, maybe(0.3, share), maybe(0.35, comments), maybe(0.35, sidebar), maybe(0.15, advert), maybe(0.8, foot), maybe(0.1, notice)]
        if r.random() < 0.3:
            at = around.index(main)
            around[at - 1 : at + 3] = [f"<div{attr('wrapper', 'container', 'page', 'layout', 'content')}>" + "".join(around[at - 1 : at + 3]) + "</div>"]
        if r.random() < 0.2:
            around.insert(1, around.pop(-4))
        page = "<!DOCTYPE html><html><head><title>t</title><script>var t='</p>';</script></head><body>" + "".join(around) + r.choice(["</body></html>", ""])
        pages.append(page)
    return pages


@dataclass
class Extractor:
    vocabulary: dict[str, int]
    trees: Boosted

    def extract(self, pages: list[str | None]) -> list[str]:
        """Main texts: kept blocks in page order, white space inside a block as one space, blocks apart by an empty line."""
        parsed = [parse(page or "") for page in pages]
        if not parsed:
            return []
        odds = self.trees.log_odds(np.vstack([features(nodes, self.vocabulary) for nodes, _ in parsed]))
        out, at = [], 0
        for nodes, blocks in parsed:
            kept = decode(nodes, odds[at : at + len(nodes)])
            at += len(nodes)
            out.append("\n\n".join(text for node, text in blocks if kept[node]))
        return out


@lru_cache(maxsize=2)
def trained(pages: int = 600, seed: int = 7, most_words: int = 60) -> Extractor:
    """An extractor fitted to ``pages`` generated layouts with the ``most_words`` most frequent attribute words."""
    rows, wanted, parsed = [], [], [parse(page) for page in layouts(pages, seed)]
    seen = Counter(word for nodes, _ in parsed for x in nodes for word in x.words)
    vocabulary = {word: i for i, (word, _) in enumerate(sorted(seen.items(), key=lambda kv: (-kv[1], kv[0]))[:most_words])}
    for nodes, blocks in parsed:
        label = np.zeros(len(nodes), bool)
        for node, text in blocks:
            while node >= 0 and text.startswith("m") and not label[node]:
                label[node] = True
                node = nodes[node].parent
        rows.append(features(nodes, vocabulary))
        wanted.append(label)
    return Extractor(vocabulary, fit(np.vstack(rows), np.concatenate(wanted).astype(float)))


def extract_main_text(pages: DataFrame, html: str = "html") -> DataFrame:
    """All rows and columns as a struct ``row``, with text: the main text, empty if there is none.

    A null page is empty. Whole pages of any length; unclosed and stray tags are read as browsers do.
    """
    extractor = pages.sparkSession.sparkContext.broadcast(trained())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, part in text_slices(batch.column("html"), 2_000_000):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(start, len(part)), pa.array(extractor.value.extract(part), pa.string())], names=["row", "text"]
                )

    given = pages.select(F.struct(*[pages[c] for c in pages.columns]).alias("row"), pages[html].alias("html"))
    return given.mapInArrow(run, T.StructType([given.schema["row"], T.StructField("text", T.StringType())]))


@query("op3_main_text")
def op3_main_text(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    rows = extract_main_text(pages.withColumn("_keep", F.struct("page_id", "url")).select("_keep", "html"))
    return rows.select(
        F.col("row._keep.page_id").alias("page_id"), F.col("row._keep.url").alias("url"), "text", F.length("text").cast("long").alias("n_chars")
    )
