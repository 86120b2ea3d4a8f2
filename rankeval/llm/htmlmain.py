"""Main-text extraction by minimum-cut labelling of a page's blocks.

The page is read into blocks (text between block-level tags) with their place in the element tree.  A linear
classifier over text and tree features gives each block a log-odds score; its positive part is the capacity
from the source (cost of dropping the block), its negative part the capacity to the sink (cost of keeping it).
The container is one feature of several: a link or a fragment in an article scores as boilerplate by itself.
Smoothness edges join neighbours in page order and the nearest earlier block under the same parent, the stronger
the closer the two stand in the tree, and weak across the border of a labelled container.  A maximum flow
separates content from boilerplate: blocks still reachable from the source are content, so a doubtful block goes with
the blocks around it.

One pass in Arrow batches, no shuffle: a page is one row, its reading is linear in its length whatever the nesting, and the
graph of a page has at most two edges per block.

Defined cases: a null or empty page has an empty text; malformed markup (unclosed or stray tags, unterminated
quotes, pages cut short) is read on as far as it goes; very long pages are read whole; a block on which both sides of
the cut cost the same is boilerplate; repeated rows give equal rows; an empty table gives an empty result; extra columns,
whatever their names, are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from math import log1p

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import struct_of, table

#: Classifier weights (log-odds): nearest labelled container, tags and text shape.
WEIGHTS = {
    "bias": -0.6, "container_content": 2.2, "container_boilerplate": -5.5, "hidden": -9.0, "paragraph": 0.8,
    "heading": 0.8, "list_item": -0.2, "link_density": -3.5, "log_words": 0.45, "sentence_end": 0.6, "legal": -2.5,
}
ADJACENT, SIBLING, CROSSING = 1.2, 0.8, 0.15

_ATTRS = r"""(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)"""
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    rf"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*){_ATTRS}>|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)(?:>|\Z)", re.S)
RAW = {t: re.compile(rf"</{t}\s*>", re.I) for t in (
    "script", "style", "title", "textarea", "noscript", "template", "iframe", "svg", "select")}
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol
optgroup option p pre section summary table tbody td tfoot th thead tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
CONTENT_TAGS, BOILERPLATE_TAGS = frozenset(("article", "main")), frozenset(
    ("nav", "aside", "footer", "form", "menu", "button", "dialog", "head", "label", "fieldset"))
BOILERPLATE_ROLES = frozenset(
    ("navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "menu", "form", "alertdialog"))
ATTRIBUTE = re.compile(r"""(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
BOILERPLATE_NAME = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|adv|adbox|advert\w*|banner|sponsor\w*|promo\w*|sidebar|side|menu|nav\w*|footer|header|topbar"
    r"|masthead|cookie\w*|consent|gdpr|notices?|popup|modal|overlay|newsletter|subscri\w*|signup|social|share|sharing"
    r"|related|recommend\w*|breadcrumbs?|pagination|pager|comments?|commentlist|disqus|repl(?:y|ies)|respond|form|login"
    r"|search|toolbar|widgets?|copyright|legal|disclaimer|skip|alert)(?:$|[\s_-])", re.I)
CONTENT_NAME = re.compile(
    r"(?:^|[\s_-])(?:article\w*|content|main\w*|post|entry|story|maintext|body|text)(?:$|[\s_-])", re.I)
#: Names that tell of a container elsewhere, or of its absence: has-sidebar, no-ads, ad-free.
ABOUT_OTHERS = re.compile(r"(?:has|have|no|not|non|with|without|hide|hides|show|toggle)[-_]|.*[-_](?:free|less|off|hidden)$", re.I)
SCALE = 1000


def name_vote(value: str) -> int:
    """1 if the names of a class or id tell of content, -1 of boilerplate, 0 of neither or of both."""
    votes = 0
    for name in value.split():
        if not ABOUT_OTHERS.match(name):
            votes += -1 if BOILERPLATE_NAME.search(name) else 1 if CONTENT_NAME.search(name) else 0
    return (votes > 0) - (votes < 0)


class Node:
    __slots__ = ("tag", "parent", "depth", "kind", "hidden", "link", "block")

    def __init__(self, tag: str, attributes: str, parent: Node | None):
        self.tag, self.parent = tag, parent
        self.depth = parent.depth + 1 if parent else 0
        self.block = self if tag in BLOCKS or parent is None else parent.block
        self.link = tag == "a" or (parent is not None and parent.link)
        self.hidden = parent is not None and parent.hidden
        self.kind = parent.kind if parent else None  # (label, depth) of the nearest labelled ancestor
        label = "content" if tag in CONTENT_TAGS else "boilerplate" if tag in BOILERPLATE_TAGS else None
        if tag == "header" and not (self.kind and self.kind[0] == "content"):
            label = "boilerplate"
        if attributes:
            votes = 0
            for name, *values in ATTRIBUTE.findall(attributes):
                name, value = name.lower(), "".join(values)
                if name == "hidden" or name == "aria-hidden" and value == "true" or \
                        name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                    self.hidden = True
                elif name == "role":
                    label = "boilerplate" if value in BOILERPLATE_ROLES else \
                        "content" if value in ("main", "article") else label
                elif name in ("class", "id") and tag not in ("html", "body"):
                    votes += name_vote(value) * (2 if name == "id" else 1)
            # names are evidence where no tag or role tells the kind; boilerplate inside boilerplate stays it
            if votes < 0 and label != "content":
                label = "boilerplate"
            elif votes > 0 and label is None and (not self.kind or self.kind[0] == "content"):
                label = "content"
        if label:
            self.kind = (label, self.depth)


class Block:
    __slots__ = ("text", "node", "linked")

    def __init__(self, text: str, node: Node, linked: int):
        self.text, self.node, self.linked = text, node, linked


def blocks_of(html: str) -> list[Block]:
    """Blocks in page order: character references decoded, white space runs as one space, trimmed."""
    here = Node("html", "", None)
    opened: dict[str, list[Node]] = {}
    out, parts, linked, at, n = [], [], 0, 0, len(html)

    def text(raw: str) -> None:
        nonlocal linked
        if raw:
            decoded = unescape(raw) if "&" in raw else raw
            parts.append(decoded)
            if here.link:
                linked += len(decoded.strip())

    def flush() -> None:
        nonlocal linked
        if parts:
            joined = " ".join("".join(parts).split())
            if joined:
                out.append(Block(joined, here.block, linked))
            parts.clear()
            linked = 0

    def innermost(tags: frozenset | tuple) -> int:
        """Depth of the innermost open element of ``tags``, 0 for none."""
        return max((opened[t][-1].depth for t in tags if opened.get(t)), default=0)

    def close(tags: frozenset | tuple, stop: frozenset | tuple = ()) -> None:
        """Close the innermost open element of ``tags``, unless one of ``stop`` stands before it."""
        nonlocal here
        depth = innermost(tags)
        if depth and depth > innermost(stop):
            while here.depth >= depth:  # every element is closed once
                opened[here.tag].pop()
                here = here.parent

    while at < n:
        m = TOKEN.search(html, at)
        if not m:
            text(html[at:])
            break
        text(html[at: m.start()])
        at = m.end()
        if m["cdata"] is not None:
            text(m["cdata"])
            continue
        tag = m["tag"] or m["tag2"]
        if tag is None:
            continue
        ending, tag = m["end"] or m["end2"], tag.lower()
        if ending:
            if tag in BLOCKS:
                flush()
            close((tag,))
            continue
        if tag in RAW:
            end = RAW[tag].search(html, at)
            if not (m[0].endswith("/>") and tag in ("svg", "iframe")):
                at = end.end() if end else n
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag in BLOCKS:
            flush()
            close(("p",), ("table", "button", "body"))
            if tag == "li":
                close(("li",), ("ul", "ol", "menu", "dir"))
            elif tag in ("dd", "dt"):
                close(("dd", "dt"), ("dl",))
            elif tag in ("td", "th"):
                close(("td", "th"), ("tr", "table"))
            elif tag == "tr":
                close(("tr",), ("table", "tbody"))
        if tag not in VOID and not m[0].endswith("/>") or tag in BLOCKS and tag not in VOID:
            here = Node(tag, m["attrs"] if m["tag"] else m["attrs2"], here)
            opened.setdefault(tag, []).append(here)
    flush()
    return out


def score(block: Block) -> float:
    """Log-odds of content."""
    w, text, node = WEIGHTS, block.text, block.node
    words = text.count(" ") + 1
    s = w["bias"] + w["log_words"] * log1p(words) + w["link_density"] * min(1.0, block.linked / len(text))
    if node.kind:
        s += w["container_" + node.kind[0]]
    if node.hidden:
        s += w["hidden"]
    if node.tag == "p":
        s += w["paragraph"]
    elif node.tag in HEADINGS:
        s += w["heading"]
    elif node.tag == "li":
        s += w["list_item"]
    if text[-1] in ".!?…\"”»:;,)":
        s += w["sentence_end"]
    if text[0] == "©" or (words <= 30 and "all rights reserved" in text.lower()):
        s += w["legal"]
    return s


def proximity(a: Node, b: Node) -> float:
    """Depth of the deepest common ancestor over the greater depth, 1 for the same element."""
    deep = max(a.depth, b.depth, 1)
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
    return (a.depth + 1) / (deep + 1)


def minimum_cut(capacity: list[int], pairs: list[tuple[int, int, int]]) -> list[bool]:
    """Source side of a minimum cut.  ``capacity[i]`` > 0 runs from the source to i, < 0 from i to the sink;
    ``pairs`` are undirected (i, j, capacity).  Dinic's algorithm with an explicit stack."""
    n = len(capacity)
    source, sink = n, n + 1
    head: list[list[int]] = [[] for _ in range(n + 2)]
    to: list[int] = []
    room: list[int] = []

    def edge(a: int, b: int, forth: int, back: int) -> None:
        head[a].append(len(to))
        to.append(b)
        room.append(forth)
        head[b].append(len(to))
        to.append(a)
        room.append(back)

    for i, c in enumerate(capacity):
        if c > 0:
            edge(source, i, c, 0)
        elif c < 0:
            edge(i, sink, -c, 0)
    for i, j, c in pairs:
        if c > 0:
            edge(i, j, c, c)
    while True:
        level = [-1] * (n + 2)
        level[source], queue = 0, [source]
        for a in queue:
            for e in head[a]:
                if room[e] > 0 and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [x >= 0 for x in level[:n]]
        turn, path, a = [0] * (n + 2), [], source
        while True:
            if a == sink:
                least = min(room[e] for e in path)
                for e in path:
                    room[e] -= least
                    room[e ^ 1] += least
                full = next(i for i, e in enumerate(path) if not room[e])
                a = to[path[full] ^ 1]
                del path[full:]
                continue
            while turn[a] < len(head[a]):
                e = head[a][turn[a]]
                if room[e] > 0 and level[to[e]] == level[a] + 1:
                    break
                turn[a] += 1
            else:
                if a == source:
                    break
                level[a] = -1
                a = to[path.pop() ^ 1]
                continue
            path.append(e)
            a = to[e]


def label(blocks: list[Block]) -> list[bool]:
    """True for content."""
    capacity = [round(SCALE * score(b)) for b in blocks]
    pairs, last = [], {}
    for i, b in enumerate(blocks):
        before = last.get(id(b.node.parent))
        if i:
            a = blocks[i - 1]
            same = (a.node.kind or ())[:1] == (b.node.kind or ())[:1]
            weight = ADJACENT if same else CROSSING
            pairs.append((i - 1, i, round(SCALE * weight * proximity(a.node, b.node))))
        if before is not None and before != i - 1 and blocks[before].node.kind == b.node.kind:
            pairs.append((before, i, round(SCALE * SIBLING * proximity(blocks[before].node, b.node))))
        last[id(b.node.parent)] = i
    return minimum_cut(capacity, pairs)


def main_text(html: str | None) -> str:
    blocks = blocks_of(html or "")
    return "\n".join(b.text for b, keep in zip(blocks, label(blocks)) if keep) if blocks else ""


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars per page."""
    types = {f.name: f.dataType.simpleString() for f in pages.schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h.as_py()) for h in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", F.col("html").cast("string").alias("html")).mapInArrow(run, struct_of(
        ("page_id", types["page_id"]), ("url", types["url"]), ("text", "string"), ("n_chars", "bigint")))


def op3_minimum_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
