"""Main text of web pages by site style trees.

The DOMs of a host's pages are merged: elements with the same path of tags and classes are one element
node. A node records on how many pages it occurs, the distribution of its presentation (the sequence of
its children, runs counted once) and of its content (all text below it). The entropies of both, in units
of the logarithm of the number of pages, give its importance: the greater of the two, that of presentation
scaled by ``1 - gamma ** looks``. Menus, notices and footers look and read alike on every page, articles do
not. Hosts with few pages borrow from the tree of all hosts, weighted by ``borrow`` pages.

What an element's tag, class, id and role say is a weight added to its importance:

* ``article`` and ``main`` +0.6;
* tags, roles and names of menus, forms, adverts, notices, comments and the like -0.7, which is below the
  threshold at any importance; on a paragraph, heading, cell or inline element such a name weighs -0.35, so
  that a branch which reads differently on every page stays;
* a name that only states a setting (``with-sidebar``, ``comments-open``) says nothing.

Branches whose sum is below ``threshold`` are removed from each page, inside articles as well as around them,
and the rest is its text. Inside an article the tree asks blocks only, not headings or inline elements, and
tells numbers apart. ``html``, ``body``, ``main`` and what stands around an article stay, whatever their names
(only ``nav``, ``aside``, ``footer`` and other tags of that kind do not stay for an article in them).

Copies count once: pages whose articles (without any: whose whole texts) read alike but for digits are one
page of their host, and one page of the tree of all hosts. Else a host that mostly holds copies of one page
would look like a host of notices.

Trees are counts by (host, node, value), summed before and after each shuffle, so a host with a third of
all pages is no group of pages anywhere. A host's pages meet only the list of its removed nodes.

Defined results: null and empty pages, and pages without main text, give an empty text. Pages without a
host in their url share one tree. Malformed markup is read as browsers do in the common cases (missing end
tags, stray end tags, unquoted or unclosed attributes). Repeated rows give repeated results.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.stage import stage
from .common import fresh, strings


@dataclass(frozen=True)
class Rules:
    threshold: float = 0.4
    gamma: float = 0.9
    #: The tree of all hosts counts as so many pages of each host.
    borrow: int = 20


#: Elements without end tags, whose text is no markup, that end an open block, that hold no
#: main text, and that end an open element of the given kinds.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|noscript|template|textarea|title|iframe|svg|math|xmp"
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
                  "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th "
                  "thead title tr ul".split())
NOT_TEXT = frozenset("nav footer aside form head button select option dialog menu object canvas audio video label input".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Words in a class or id that state what an element is for.
NOISE_WORDS = frozenset("ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion cookie cookies consent gdpr "
                        "notice notices alert popup modal overlay newsletter subscribe signup login paywall nav navbar navigation menu menus breadcrumb "
                        "breadcrumbs pagination pager sidebar sidebars rail widget widgets header masthead topbar footer footers copyright legal "
                        "comment comments commentlist disqus respond replies reply share sharing social related recommended trending tags toolbar "
                        "search skip".split())
#: Words that make a name state a setting of the page instead of a purpose.
SETTINGS = frozenset("with without has no not is open opened closed enabled disabled on off".split())
#: Elements of running text, whose names weigh less.
TEXTUAL = frozenset("p h1 h2 h3 h4 h5 h6 td th dd dt blockquote pre figcaption caption span a b i em strong small u s q cite code abbr time mark sub sup font".split())
CONTENT = frozenset(("article", "main"))
WHOLE = frozenset(("html", "body", "main"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})\b(?:\"[^\"]*\"|'[^']*'|[^'\">])*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^'\">])*+|[^>]*)>|<[!?/][^>]*>", re.S | re.I)
_CLASS = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORD = re.compile(r"[A-Za-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_DIGITS = re.compile(r"\d+")


#: Weights in hundredths, as they are stored with the nodes.
KEEP, NOISE, FAINT = 60, -70, -35


class Element:
    __slots__ = ("tag", "path", "key", "weight", "content", "low", "children", "last", "holds")

    def __init__(self, tag: str, path: str, key: int, weight: int, content: bool, low: tuple[Element, ...], removed: bool):
        self.tag, self.path, self.key, self.weight, self.content = tag, path, key, weight, content
        self.low = (*low, self) if removed else low  #: the open elements, this one included, that are removed unless they hold an article
        self.children, self.last = 0, ""
        self.holds = tag in WHOLE  #: whether it must stay: its tag, or an article or main element found in it


def stays(low: tuple[Element, ...]) -> bool:
    """Whether text below these elements stays; known once the page has been read to its end."""
    return all(e.holds and e.tag not in NOT_TEXT for e in low)


_NODES: dict[tuple[str, str, str, bool], tuple[str, int, int, str]] = {}


def _node(parent: str, tag: str, attrs: str, inside: bool) -> tuple[str, int, int, str]:
    """(path, its hash, the weight of its names, its signature); remembered, since sites repeat."""
    known = _NODES.get((parent, tag, attrs, inside))
    if known is None:
        names = {m[0].lower(): m[1] or m[2] or m[3] for m in _CLASS.findall(attrs)} if "=" in attrs else {}
        kinds = sorted(set(names.get("class", "").split()))
        signature = _DIGITS.sub("0", tag + "".join(f".{c}" for c in kinds) + (f"#{names['id']}" if names.get("id") else ""))
        path = f"{parent}>{signature}"
        said = [{w.lower() for w in _WORD.findall(_CAMEL.sub(" ", x))} for x in (*kinds, names.get("id", ""))]
        named = any(words & NOISE_WORDS and not words & SETTINGS for words in said)
        role = names.get("role", "").lower() in ("navigation", "banner", "complementary", "contentinfo", "search")
        if tag in WHOLE or tag == "article" and not (named or role):
            weight = KEEP
        elif tag in NOT_TEXT or role or tag == "header" and not inside:
            weight = NOISE
        else:
            weight = (FAINT if tag in TEXTUAL else NOISE) if named else 0
        known = (path, xxhash.xxh64_intdigest(path) - (1 << 63), weight, signature)
        if len(_NODES) > 100_000:
            _NODES.clear()
        _NODES[parent, tag, attrs, inside] = known
    return known


def events(html: str, closed: Callable[[Element], None] = lambda e: None,
           removed: frozenset[int] = frozenset()) -> Iterator[tuple[list[Element], str | None]]:
    """(open elements, text) for each run of text, and (open elements, None) where a block may begin or end.

    The list of open elements is one object that changes between events. ``closed`` gets every element that ends.
    """
    stack = [Element("", "", 0, 0, False, (), False)]
    at = 0

    def close_from(i: int) -> None:
        while len(stack) > i:
            closed(stack.pop())

    def push(tag: str, attrs: str) -> Element:
        parent = stack[-1]
        path, key, weight, signature = _node(parent.path, tag, attrs, parent.content)
        if tag in CONTENT and weight == KEEP:
            for e in stack:
                e.holds = True
        if parent.last != signature:
            parent.children = xxhash.xxh64_intdigest(signature, seed=parent.children)
            parent.last = signature
        inside = parent.content or tag in CONTENT and weight == KEEP
        return Element(tag, path, key, weight, inside, parent.low, weight == NOISE or weight != KEEP and key in removed)

    for m in _TOKEN.finditer(html):
        if m.start() > at:
            yield stack, html[at:m.start()]
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if m["end"]:
            block = tag in BLOCK
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    if block:
                        yield stack, None
                    close_from(i)
                    break
                if not block and stack[i].tag in BLOCK:  # a stray end tag closes nothing around it
                    break
            continue
        if tag == "br":
            yield stack, " "
        if tag in BLOCK:
            yield stack, None
        ends = CLOSES.get(tag, ())
        if tag in BLOCK and tag not in ("html", "head", "body"):
            for i in range(len(stack) - 1, 0, -1):  # a block ends an open paragraph, an item the one before it
                t = stack[i].tag
                if t == "p" or t in ends or t == "head":
                    close_from(i)
                    if not ends:
                        break
                elif t in ("table", "ul", "ol", "dl", "div", "section", "article", "main", "body"):
                    break
        elif tag == "body":
            close_from(2 if len(stack) > 1 and stack[1].tag == "html" else 1)
        new = push(tag, m["attrs"] or "")
        if tag not in VOID and not (m["attrs"] or "").endswith("/"):
            stack.append(new)
    if at < len(html):
        yield stack, html[at:]
    yield stack, None
    close_from(1)


def profile(html: str) -> tuple[int, dict[int, list[int]]]:
    """The hash of what the page says, and for each node of the page that the tree judges: hashes of its presentation
    and of its content, and the weight of its names. Branches that their names remove have no nodes below them."""
    nodes: dict[int, list[int]] = {}
    said: list[tuple[int, bool, tuple[Element, ...]]] = []

    def judged(e: Element) -> bool:
        return e.weight != NOISE and not (e.content and (e.tag not in BLOCK or e.tag in HEADINGS))

    def closed(e: Element) -> None:
        if judged(e):
            at = nodes.setdefault(e.key, [0, 0, e.weight])
            at[0] = (at[0] + e.children) & 0xFFFFFFFFFFFFFFFF

    for stack, text in events(html, closed):
        if text is not None and (words := text.split()):
            line, top = " ".join(words), stack[-1]
            h = xxhash.xxh64_intdigest(_DIGITS.sub("0", line))
            said.append((h, top.content, top.low))
            own = xxhash.xxh64_intdigest(line) if top.content else h
            for e in {e.key: e for e in stack[1:] if judged(e)}.values():
                at = nodes.setdefault(e.key, [0, 0, e.weight])
                at[1] = (at[1] + (own if e.content else h)) & 0xFFFFFFFFFFFFFFFF
    article = sum(h for h, content, low in said if content and stays(low))
    return (article or sum(h for h, _, _ in said)) & 0xFFFFFFFFFFFFFFFF, nodes


def main_text(html: str, removed: frozenset[int] = frozenset()) -> str:
    """Blocks of text outside the removed branches."""
    blocks, now = [], []
    for stack, text in events(html, removed=removed):
        if text is None:
            if now:
                blocks.append(now)
                now = []
        else:
            now.append((text, stack[-1].low))  # whether an element holds an article shows later in the page
    lines = (" ".join(entities.unescape("".join(text for text, low in block if not low or stays(low))).split()) for block in blocks)
    return "\n\n".join(line for line in lines if line)


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url.cast("string"), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1), F.lit("")))


def _profiles(pages: DataFrame) -> DataFrame:
    """``(host, page, nodes)``: for each page the hash of what it says, and (node, look, content, weight) of its nodes, packed."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                says, nodes = [], []
                for page in strings(part.column(1)):
                    h, found = profile(page)
                    says.append(h - (1 << 63))
                    nodes.append(np.array([(key, a - (1 << 63), b - (1 << 63), w) for key, (a, b, w) in sorted(found.items())], np.int64).tobytes())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(says, pa.int64()), pa.array(nodes, pa.binary())], ["host", "page", "nodes"])

    return pages.mapInArrow(read, "host string, page long, nodes binary")


def _counts(pages: DataFrame, keys: list[str]) -> DataFrame:
    """``(keys, kind, value, n)`` from distinct pages ``(keys without node, nodes)``."""
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = batch.column("nodes").to_pylist()
            rows = np.frombuffer(b"".join(packed), np.int64).reshape(-1, 4)
            each = np.repeat(np.arange(len(packed)), [len(x) // 32 for x in packed])
            yield pa.RecordBatch.from_arrays([batch.column("host").take(pa.array(each)), *(pa.array(rows[:, i]) for i in range(4))], ["host", "node", "look", "content", "weight"])

    seen = pages.select("host", "nodes").mapInArrow(unpack, "host string, node long, look long, content long, weight long").select(*keys, F.explode(F.array(
        F.struct(F.lit("look").alias("kind"), F.col("look").alias("value")), F.struct(F.lit("content").alias("kind"), F.col("content").alias("value")))).alias("x"))
    return seen.groupBy(*keys, "x").agg(F.count("*").alias("n")).select(*keys, "x.*", "n")


def _importance(counts: DataFrame, keys: list[str], rules: Rules) -> DataFrame:
    """``(keys, pages, imp)``: pages of each node and the greater entropy of its looks and contents, from ``(keys, kind, value, n)``."""
    per = counts.groupBy(*keys, "kind").agg(F.sum("n").alias("m"), F.sum(F.col("n") * F.log("n")).alias("s"), F.count("*").alias("k"))
    h = F.when(F.col("m") > 1, (F.log("m") - F.col("s") / F.col("m")) / F.log("m")).otherwise(1.0)
    scaled = F.when(F.col("kind") == "look", (1 - F.pow(F.lit(rules.gamma), F.col("k"))) * h).otherwise(h)
    return per.groupBy(*keys).agg(F.max("m").alias("pages"), F.max(scaled).alias("imp"))


def removed_nodes(pages: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """``(host, removed array<long>)`` from ``pages(host, html)``; hosts that lose nothing by the tree are left out."""
    # of pages that say the same, the greatest profile stands for all
    distinct = stage(_profiles(pages).groupBy("host", "page").agg(F.max("nodes").alias("nodes")), "site-pages")
    counts = _counts(distinct, ["host", "node", "weight"])
    everywhere = _counts(distinct.groupBy("page").agg(F.max("nodes").alias("nodes")).withColumn("host", F.lit("")), ["node"])
    own = _importance(counts, ["host", "node", "weight"], rules)
    # the tree of all hosts knows nothing about nodes that one page has
    all_hosts = stage(_importance(everywhere, ["node"], rules).select("node", F.col("pages").alias("all_pages"), F.col("imp").alias("all_imp")), "site-all")
    mixed = own.join(all_hosts, "node").withColumn("imp", (
        F.col("imp") * F.col("pages") + F.col("all_imp") * rules.borrow) / (F.col("pages") + rules.borrow))
    low = mixed.filter((F.col("imp") + F.col("weight") / 100 < rules.threshold) & (F.col("all_pages") > 1))
    return stage(low.groupBy("host").agg(F.collect_set("node").alias("removed")), "site-removed")


def text_of(html: Column, removed: Column) -> Column:
    @F.arrow_udf("string")
    def extract(column: pa.Array, lists: pa.Array) -> pa.Array:
        out, last, nodes = [], None, frozenset()
        for page, low in zip(strings(column), lists):
            if low != last:
                last, nodes = low, frozenset(low.as_py() or ())
            out.append(main_text(page, nodes))
        return pa.array(out, pa.string())

    return extract(html.cast("string"), removed)


def with_text(df: DataFrame, out: str = "main_text", html: str = "html", url: str = "url", rules: Rules = Rules()) -> DataFrame:
    """``df`` with the main text of each page in the new column ``out``."""
    if out.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"column {out} exists already")
    host, key, low = (fresh(df, f"{out}_{x}") for x in ("host", "key", "low"))
    page = F.col(f"`{html}`")
    at = df.withColumn(host, host_of(F.col(f"`{url}`")))
    lists = removed_nodes(at.select(F.col(host).alias("host"), page.cast("string").alias("html")), rules)
    lists = lists.select(F.col("host").alias(key), F.col("removed").alias(low))
    joined = at.join(lists, F.col(host) == F.col(key), "left")
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], text_of(page, F.col(low)).alias(out))
