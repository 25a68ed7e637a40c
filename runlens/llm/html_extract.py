"""Main text of web pages by site style trees (operator 10).

The pages of a host are merged into one tree. A node is a path of containers (tag and class names, digits as #);
each page adds to it the sequence of child styles (presentation) and the text blocks it holds (content). Pages of a host
whose text by role is the same (copies, print views) count as one. Per node, m being all pages of the host with text:

- presentation importance: entropy to the base m of its child-style sequences;
- content importance: 1 - mean entropy of its text blocks. A block seen on n of m pages has
  entropy log_m(n): one that is on every page tells nothing, one that is on a single page is content;
- importance: ``(1 - GAMMA) * presentation + GAMMA * content``. A node seen on one page only has importance 1.

Branches under ``THRESHOLD`` are removed from the host's pages. Elements whose role HTML states are
not left to statistics: navigation, page header and footer, asides, forms, scripts, styles and elements whose
class, id or role says advert, menu, notice, comments and so on go, articles of that kind too; a form that wraps most of a page's text loses only its
controls and labels. Of the parts a page marks (article, main, role=main) and the text outside them, the one with the
most text outside low branches is read (the only marked part of a page counts twice). Inside a marked part a branch goes only if it is low and as common as the
site's frame: on at least ``COMMON_PAGES`` pages and half of the host's. Single paragraphs and headings are never judged by entropy, so a text that
many pages quote stays.

The tree is built in Spark: tasks list (host, path, feature, content digest), distinct ones are counted by key, and a host's low branches
(a few paths) are joined to its pages; pages of one host are never gathered.

Defined cases: null or empty html gives an empty text; a null or odd URL makes a host of its own name (the
empty name); unclosed elements end with their parent; if the low branches of a page hold all its
text they stay; containers nested deeper than ``MAX_DEPTH`` belong to the one at that depth; near copies that
differ in a kept block count as pages of their own; an empty table gives an empty table; columns named like the added ones are replaced.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runlens.llm.common import as_row, cut, from_row

GAMMA = 0.9
THRESHOLD = 0.5
COMMON_PAGES = 5
MAX_DEPTH = 64

# The roles HTML gives its elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section "
    "summary table tbody td tfoot th thead title tr ul".split())
CONTAINER = frozenset(
    "article aside center details dialog div dl fieldset figure footer form header main menu nav ol section table ul".split())
DROPPED = frozenset(
    "head title script style noscript template nav footer aside button select textarea input label iframe object "
    "svg canvas audio video map menu dialog search".split())
MAIN = frozenset(("article", "main"))
DROPPED_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
DROPPED_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox adsbygoogle banner breadcrumb breadcrumbs byline-share "
    "comment comments commentlist comment-list discussion disqus replies reader-comments cookie cookies consent gdpr footer "
    "site-footer page-footer header site-header page-header masthead login menu nav navbar navigation newsletter notice notices "
    "pager pagination popup modal overlay promo promoted promotion related recommended share sharing sidebar side-bar signup "
    "social sponsor sponsored subscribe subscription toolbar topbar widget widgets".split())
# Names that also count as the first or last part of a longer one (cookie-banner, ad_slot, reader-comments) ...
NAME_ENDS = frozenset(
    "ad ads advert adverts advertisement breadcrumb breadcrumbs comment comments cookie cookies consent disqus footer menu nav "
    "navbar navigation newsletter pagination popup promo sidebar sponsor sponsored subscribe".split())
# ... unless the first part only says whether a page has one.
STATES = frozenset("with without has no not is show hide".split())
# Which open elements a start tag ends.
ENDS = {
    **{t: frozenset(("p",)) for t in BLOCK - {"option", "td", "th", "tr", "li", "dd", "dt"}},
    "li": frozenset(("li", "p")), "dd": frozenset(("dd", "dt", "p")), "dt": frozenset(("dd", "dt", "p")),
    "tr": frozenset(("tr", "td", "th", "p")), "td": frozenset(("td", "th", "p")), "th": frozenset(("td", "th", "p")),
    "option": frozenset(("option",)), "body": frozenset(("head",)),
}
# An implied end does not reach past these.
FENCES = {"li": frozenset(("ul", "ol", "menu")), "dd": frozenset(("dl",)), "dt": frozenset(("dl",)),
          "tr": frozenset(("table",)), "td": frozenset(("table",)), "th": frozenset(("table",))}
DIGITS = re.compile(r"\d+")
NAME_PARTS = re.compile(r"[\s]+")


def _names(attrs: dict[str, str | None]) -> list[str]:
    return [x for a in ("class", "id") for x in NAME_PARTS.split((attrs.get(a) or "").lower()) if x]


def _says_dropped(tag: str, attrs: dict, in_main: bool) -> bool:
    if tag in DROPPED or tag == "header" and not in_main:
        return True
    if tag in ("html", "body"):
        return False
    if (attrs.get("role") or "").strip().lower() in DROPPED_ROLES or "hidden" in attrs:
        return True
    return any(map(_names_dropped, _names(attrs)))


def _names_dropped(name: str) -> bool:
    name = name.replace("_", "-")
    parts = name.split("-")
    return name in DROPPED_NAMES or (
        len(parts) > 1 and parts[0] not in STATES and (parts[0] in NAME_ENDS or parts[-1] in NAME_ENDS))


class _Open:
    """An open element; ``block`` is the block element its text belongs to (itself or the nearest outside), ``part`` the number of
    the outermost marked part it is in, ``form`` whether it is in a form."""

    __slots__ = ("tag", "path", "dropped", "part", "form", "children", "block")

    def __init__(self, tag, path, dropped, part, form, parent=None):
        self.tag, self.path, self.dropped, self.part, self.form, self.children = tag, path, dropped, part, form, []
        self.block = self if parent is None or tag in BLOCK else parent.block


class Page(HTMLParser):
    """Blocks of one page, (container path, dropped by role, number of the marked part or 0, text), and the
    child styles of each container."""

    def __init__(self, html: str | None):
        super().__init__(convert_charrefs=True)
        self.stack = [_Open("", (), False, 0, False)]
        self.blocks: list[tuple[tuple, bool, int, str]] = []
        self.in_form: list[bool] = []
        self.parts = 0
        self.styles: list[tuple[tuple, tuple]] = []
        self.text: list[str] = []
        self.feed(html or "")
        self.close()
        self._end_block()
        while len(self.stack) > 1:
            self._pop()
        # A form goes, unless it holds most of what the roles leave.
        sizes = [len(b[3]) * (not b[1]) for b in self.blocks]
        if 2 * sum(n for n, form in zip(sizes, self.in_form) if form) <= sum(sizes):
            self.blocks = [(p, dropped or form, part, t) for (p, dropped, part, t), form in zip(self.blocks, self.in_form)]

    def _end_block(self) -> None:
        if self.text:
            text = " ".join("".join(self.text).split())
            self.text = []
            if text:
                own = self.stack[-1].block
                self.blocks.append((own.path, own.dropped, own.part, text))
                self.in_form.append(own.form)

    def _pop(self) -> None:
        top = self.stack.pop()
        if top.tag in CONTAINER:
            self.styles.append((top.path, tuple(top.children)))

    def _close_to(self, at: int) -> None:
        if any(x.tag in BLOCK for x in self.stack[at:]):
            self._end_block()
        while len(self.stack) > at:
            self._pop()

    def handle_starttag(self, tag, attrs):
        ends, fences = ENDS.get(tag), FENCES.get(tag, CONTAINER)
        if ends:
            for at in range(len(self.stack) - 1, 0, -1):
                if self.stack[at].tag in ends:
                    low = at
                    # A cell ends with its row: take the outermost that ends before a fence.
                    while low > 1 and self.stack[low - 1].tag in ends:
                        low -= 1
                    self._close_to(low)
                    break
                if self.stack[at].tag in fences:
                    break
        if tag in BLOCK:
            self._end_block()
        elif tag == "br":
            self.text.append(" ")
        if tag in VOID:
            return
        given = dict(attrs)
        top = self.stack[-1]
        dropped = top.dropped or _says_dropped(tag, given, top.part > 0)
        part = top.part
        if not part and not dropped and (tag in MAIN or (given.get("role") or "").strip().lower() == "main"):
            self.parts += 1
            part = self.parts
        path = top.path
        if tag in CONTAINER:
            style = ".".join([tag, *sorted(DIGITS.sub("#", n) for n in _names(given))])
            if not top.children or top.children[-1] != style:
                top.children.append(style)
            if len(path) < MAX_DEPTH:
                path = (*path, style)
        self.stack.append(_Open(tag, path, dropped, part, top.form or tag == "form", top))

    def handle_endtag(self, tag):
        for at in range(len(self.stack) - 1, 0, -1):
            if self.stack[at].tag == tag:
                # The end of an inline element does not end the blocks opened inside it, unless their text is dropped.
                if tag not in BLOCK and not self.stack[at].dropped and any(x.tag in BLOCK for x in self.stack[at:]):
                    del self.stack[at]
                else:
                    self._close_to(at)
                return
        if tag in ("p", "br"):
            self._end_block() if tag == "p" else self.text.append(" ")

    def handle_data(self, data):
        # A script, button or advert inside a line of text is no part of the line.
        top = self.stack[-1]
        if not top.dropped or top.block.dropped:
            self.text.append(data)


def _by_role(blocks: list[tuple]) -> list[tuple]:
    """The blocks that no role rules out."""
    return [b for b in blocks if not b[1]]


def main_text(html: str | None, low: frozenset[str] = frozenset(), common: frozenset[str] = frozenset()) -> str:
    """The main part of a page without what roles and low branches (paths, joined by /) rule out; inside marked parts only the
    ``common`` ones among them count."""
    blocks = _by_role(Page(html).blocks)

    def under(path: tuple, branches: frozenset[str]) -> bool:
        return any("/".join(path[:i]) in branches for i in range(1, len(path) + 1))

    left = [b for b in blocks if not under(b[0], common if b[2] else low)] if low else blocks
    if not left:
        left = blocks
    size: dict[int, int] = {}
    for _, _, part, text in left:
        size[part] = size.get(part, 0) + len(text)
    # The first of the largest, a marked part before the text outside; a page's only marked part counts twice.
    alone = 2 if len(size) == 2 and 0 in size else 1
    best = max(size, key=lambda part: (size[part] * (alone if part else 1), part > 0, -part), default=0)
    return "\n".join(b[3] for b in left if b[2] == best)


def host_of(url) -> F.Column:
    return F.coalesce(F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1), F.lit(""))


def _told(blocks: list[tuple]) -> list[tuple]:
    """What tells a page from another: the blocks that no role rules out, of a page with marked parts those inside them."""
    kept = _by_role(blocks)
    return [b for b in kept if b[2]] or kept or blocks


def _features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        seen: set[tuple] = set()
        for host, html in zip(batch["host"], batch["html"]):
            page = Page(html)
            # What the page says; one without any text is told apart by nothing and is no page of the host.
            content = xxhash.xxh64_intdigest("\n".join(b[3] for b in _told(page.blocks))) >> 1
            if page.blocks:
                seen.add((host, "", "page", 0, content))
            seen.update((host, "/".join(p), "style", xxhash.xxh64_intdigest("\n".join(c)) >> 1, content) for p, c in page.styles)
            seen.update((host, "/".join(p), "text", xxhash.xxh64_intdigest(t) >> 1, content) for p, _, _, t in page.blocks if p)
            seen.update((host, "/".join(p), "page", 0, content) for p, _ in page.styles)
        if seen:
            yield pd.DataFrame(list(seen), columns=["host", "path", "kind", "feature", "content"])


def style_tree(pages: DataFrame, gamma: float = GAMMA) -> DataFrame:
    """(host, path, pages, importance) per container path of (host, html) rows."""
    counted = (pages.mapInPandas(_features, "host string, path string, kind string, feature long, content long").distinct()
               .groupBy("host", "path", "kind", "feature").agg(F.count("*").alias("n")))
    # Per node: pages, number and log-sum of its style sequences, of its blocks.
    n, log_n = F.col("n"), F.log("n")
    is_style, is_text = F.col("kind") == "style", F.col("kind") == "text"
    nodes = cut(counted.groupBy("host", "path").agg(
        F.sum(F.when(F.col("kind") == "page", n)).alias("pages"),
        F.sum(F.when(is_style, n)).alias("styles"), F.sum(F.when(is_style, n * log_n)).alias("style_logs"),
        F.count(F.when(is_text, 1)).alias("texts"), F.sum(F.when(is_text, log_n)).alias("text_logs")), "style-nodes")
    # The node without a path is the host. A branch's content is the content of all nodes in it: every node counts for its ancestors too.
    hosts = nodes.where("path = ''").select("host", F.log("pages").alias("base"))
    nodes = nodes.where("path != ''")
    parts = F.split("path", "/")
    up = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), "/"))
    branches = (nodes.select("host", F.explode(up).alias("path"), "texts", F.coalesce("text_logs", F.lit(0.0)).alias("text_logs"))
                .groupBy("host", "path").agg(F.sum("texts").alias("texts"), F.sum("text_logs").alias("text_logs")))
    own = nodes.select("host", "path", F.coalesce("pages", F.lit(0)).alias("pages"), "styles", "style_logs")
    t = branches.join(own, ["host", "path"], "left").join(hosts, "host", "left")
    base = F.col("base")
    presentation = (F.log("styles") - F.col("style_logs") / F.col("styles")) / base
    content = F.when(F.col("texts") > 0, 1 - F.col("text_logs") / F.col("texts") / base).otherwise(0.0)
    importance = F.when((F.col("pages") > 1) & (base > 0), (1 - gamma) * F.coalesce(presentation, F.lit(0.0)) + gamma * content).otherwise(1.0)
    # Half of the host's pages, and at least COMMON_PAGES.
    common = (F.col("pages") >= COMMON_PAGES) & (2 * F.col("pages") >= F.round(F.exp(base)))
    return t.select("host", "path", "pages", importance.alias("importance"), F.coalesce(common, F.lit(False)).alias("common"))


def _texts(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    sets: dict[tuple, frozenset] = {}

    def as_set(paths) -> frozenset:
        key = tuple(paths) if paths is not None else ()
        if key not in sets:
            if len(sets) > 1000:
                sets.clear()
            sets[key] = frozenset(key)
        return sets[key]

    for html, low, common in batches:
        yield pd.Series([main_text(h, as_set(a), as_set(b)) for h, a, b in zip(html, low, common)])


def extract(df: DataFrame, url: str, html: str, threshold: float = THRESHOLD, gamma: float = GAMMA) -> DataFrame:
    """``df`` with ``text``: the main text of each page."""
    rows = as_row(df).withColumn("host", host_of(F.col("row").getField(url)))
    tree = style_tree(rows.select("host", F.col("row").getField(html).alias("html")), gamma)
    low = cut(tree.where(F.col("importance") < threshold).groupBy("host").agg(
        F.sort_array(F.collect_set("path")).alias("low"), F.sort_array(F.collect_set(F.when(F.col("common"), F.col("path")))).alias("common")), "style-low")

    @F.pandas_udf("string")
    def text(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        return _texts(batches)

    out = rows.join(low, "host", "left").withColumn("text", text(F.col("row").getField(html), F.col("low"), F.col("common")))
    return from_row(out, "text")


def entropy(counts: list[int], pages: int) -> float:
    """Entropy of a distribution, to the base of the number of pages (0 for one page)."""
    total = sum(counts)
    return 0.0 if pages < 2 else -sum(c / total * math.log(c / total) for c in counts) / math.log(pages)
