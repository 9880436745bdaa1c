"""Main-text extraction with a site style tree.

The DOMs of all pages of a host are merged into one style tree: nodes with
the same path of presentation labels (tag, classes, role of main) are one
style node. Ids are no part of a label, since an id names one element, nor
are the classes of html and body, which a page has once. Two things are
counted per style node over the whole host:

* presentation: which sequences of child labels its occurrences have; the
  node importance is the entropy of that distribution, to the base of the
  number of occurrences (a node that always looks the same has importance 0);
* content: which texts its blocks have, with the entropy likewise, where a page
  counts once for each text that it has.

The importance of a branch combines both from the leaves up, weighted by
GAMMA ** children as in the published style-tree method. A branch of a page
is removed if its importance and that of all branches in it are below LEAST,
and so is a block whose text stands on MIN_PAGES pages at least and on more
than half of those that have its style node, however often a page says it. This decides inside and outside of an article alike.

Entropy alone cannot tell page furniture that varies from page to page
(rotating adverts, link lists to other pages, reader comments) from an
article, which varies too: elements and class names that by their meaning are
furniture are removed before the entropy is asked. Article and main elements
are a weight only: where nothing in one is important, it stays whole. So what
repeats inside of articles that differ is removed, while an article that is
itself the same on many pages stays. Style nodes that fewer than MIN_PAGES pages of a host
have carry no evidence and keep importance 1, however large the host is.

Nothing of a host's tree is collected. Statistics are rows by (host, path);
importances are summed up the tree by pointer doubling (a round halves the
depth that is left). The pages' distinct layouts (sets of paths) are joined
with them by key, which gives per layout the paths to remove; no row is larger
than one page.

Text: character references are decoded, white space inside a block becomes
one blank, blocks are trimmed, empty ones dropped, the rest joined by one
newline in page order. Inline elements and br do not end a block.

Defined results: null or empty html gives an empty text; markup that does
not nest is closed by the nearest matching rule and never fails; a url
without a host belongs to the host ''; a page without furniture and
landmarks on a host of its own is returned whole; repeated rows are
extracted each; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tallyframe.llm.common import prepare, written

GAMMA = 0.9
LEAST = 0.3
MIN_PAGES = 8
REPEATED = 0.5

# Elements by their meaning in HTML.
FURNITURE_TAGS = set(
    "nav header footer aside form script style noscript template iframe object embed svg canvas button select "
    "option textarea input label menu dialog head title meta link audio video map".split()
)
LANDMARK_TAGS = {"article", "main"}
VOID_TAGS = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE_TAGS = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
# Opening one of these ends an open p; the second group ends its own kind.
BLOCK_CLOSES_P = set(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr main menu nav ol p pre section table ul".split()
)
CLOSES_ITSELF = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"},
}
# Words of class names, ids and roles that name page furniture.
FURNITURE_WORDS = set(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar "
    "navigation menu breadcrumb breadcrumbs sidebar rail footer header masthead topbar cookie cookies consent gdpr "
    "notice alert popup modal overlay newsletter subscribe subscription signup login search share sharing social "
    "related recommended recommendations comment comments respond reply replies discussion disqus widget pagination "
    "pager toolbar skip toc contentinfo complementary paywall outbrain taboola".split()
)
_WORD = re.compile(r"[a-z]+")
_HOST = re.compile(r"^\s*(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/:?#]+)", re.I)


def host_of(url: str | None) -> str:
    found = _HOST.match(url or "")
    return found.group(1).lower() if found else ""


# Comments and declarations; a tag, with quoted values or without; a tag that the page ends in.
_MARK = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*))""")
# Their content is text without markup, and never main text.
_RAW = {t: re.compile(rf"</{t}(?=[\s/>])|\Z", re.I) for t in ("script", "style", "title", "textarea", "noscript", "iframe")}


def _mix(*parts: object) -> int:
    """A 63-bit hash of the parts."""
    return xxh64_intdigest("\x1f".join(map(str, parts)).encode("utf-8", "replace"), 11) >> 1


@lru_cache(maxsize=20_000)
def _label(tag: str, classes: str, name: str, role: str) -> tuple[str, bool, bool]:
    """Presentation label of an element, whether it is a landmark, and
    whether its tag (True) or its names say that it is furniture."""
    words = set(_WORD.findall(f"{classes} {name} {role}".lower()))
    label = tag if tag in ("html", "body") else f"{tag}.{'.'.join(sorted(set(classes.split())))}"
    if role == "main":
        label += "@main"
    furniture = tag not in ("html", "body") and (tag in FURNITURE_TAGS or bool(words & FURNITURE_WORDS))
    if tag == "header" and not words & FURNITURE_WORDS:
        furniture = None  # only outside of an article
    return label, tag in LANDMARK_TAGS or role == "main", furniture


@lru_cache(maxsize=50_000)
def _path(parent: int, label: str) -> int:
    """The style path of a child."""
    return _mix(parent, label)


class Page:
    """The DOM of one page as lists: per element its parent, style path and
    prior; per text block its element and text."""

    def __init__(self, html: str | None):
        self.tags, self.parents, self.paths = ["#page"], [-1], [_path(0, "#page")]
        self.prior: list[int | None] = [None]  # 0 furniture, 1 landmark, None undecided
        self.main_roles: set[int] = set()
        self.children: list[list[str]] = [[]]
        self.open = [0]
        self.n_open: Counter = Counter()  # open elements by tag
        self.holders = [0]  # open elements that are not inline
        self.blocks: list[tuple[int, str]] = []
        self._text: list[str] = []
        self._at = 0
        html = html or ""
        done = 0
        while (mark := _MARK.search(html, done)) is not None:
            if mark.start() > done:
                self._data(html[done : mark.start()])
            done = mark.end()
            closing, tag, rest, loose_closing, loose_tag, loose_rest = mark.groups()
            tag = (tag or loose_tag or "").lower()
            if not tag:
                continue
            if closing or loose_closing:
                self._end_tag(tag)
                continue
            self._start_tag(tag, rest if rest is not None else loose_rest)
            if tag in _RAW:
                done = _RAW[tag].search(html, done).start()
        self._data(html[done:])
        self._end_block()

    def _end_block(self) -> None:
        text = " ".join("".join(self._text).split())
        if text:
            self.blocks.append((self._at, text))
        self._text = []

    def _block_of(self) -> int:
        """The nearest open element that is not inline."""
        return self.holders[-1]

    def _close(self, names: set[str], until: set[str]) -> None:
        """Close the nearest open element of ``names``, if no element of
        ``until`` is nearer."""
        if not any(self.n_open[x] for x in names):
            return
        for depth in range(len(self.open) - 1, 0, -1):
            tag = self.tags[self.open[depth]]
            if tag in names:
                self.n_open.subtract(self.tags[n] for n in self.open[depth:])
                while self.holders[-1] >= self.open[depth]:
                    self.holders.pop()
                del self.open[depth:]
                return
            if tag in until:
                return

    def _start_tag(self, tag: str, rest: str) -> None:
        if tag not in INLINE_TAGS:
            self._end_block()
        elif tag == "br":
            self._text.append(" ")
        if tag in BLOCK_CLOSES_P:
            self._close({"p"}, {"table", "td", "div", "section", "article", "li"})
        if tag in CLOSES_ITSELF:
            self._close(CLOSES_ITSELF[tag], {"ul", "ol", "dl", "table", "select"})
        if tag in VOID_TAGS:
            return
        classes = name = role = ""
        if "class" in rest or "id" in rest or "role" in rest or not rest.islower():
            found = {k.lower(): unescape(a or b or c) for k, a, b, c in reversed(_ATTRIBUTE.findall(rest))}
            classes, name, role = found.get("class", ""), found.get("id", ""), found.get("role", "")
        parent = self.open[-1]
        label, landmark, furniture = _label(tag, classes, name, role)
        prior = self.prior[parent]
        if prior != 0:
            if landmark:
                prior = 1
            elif furniture or furniture is None and prior != 1:
                prior = 0
        node = len(self.tags)
        if role == "main":
            self.main_roles.add(node)
        self.tags.append(tag)
        self.parents.append(parent)
        self.paths.append(_path(self.paths[parent], label))
        self.prior.append(prior)
        self.children.append([])
        if not self.children[parent] or self.children[parent][-1] != label:
            self.children[parent].append(label)  # runs of one label count as one
        self.open.append(node)
        self.n_open[tag] += 1
        if tag not in INLINE_TAGS:
            self.holders.append(node)
            self._at = node

    def _end_tag(self, tag: str) -> None:
        if tag in VOID_TAGS:
            if tag == "br":
                self._text.append(" ")
            return
        if tag not in INLINE_TAGS:
            if not self.n_open[tag]:
                return
            self._end_block()
            self._close({tag}, set())
        else:
            self._close({tag}, BLOCK_CLOSES_P | {"td", "li"})
        self._at = self._block_of()

    def _data(self, data: str) -> None:
        if self._text or not data.isspace():
            if not self._text:
                self._at = self._block_of()
            self._text.append(unescape(data) if "&" in data else data)

    def facts(self) -> Iterator[tuple[int, int, int, int]]:
        """(path, parent path, kind, value) of every element (kind 0: its
        child labels) and of every block (kind 1: its text)."""
        for node in range(len(self.tags)):
            above = self.paths[self.parents[node]] if node else 0
            yield self.paths[node], above, 0, _mix(*self.children[node])
        for node, text in self.blocks:
            above = self.paths[self.parents[node]] if node else 0
            yield self.paths[node], above, 1, _mix(text)

    def candidates(self) -> list[tuple[int, str]]:
        """Path and text of the blocks that are no furniture."""
        return [(self.paths[node], text) for node, text in self.blocks if self.prior[node] != 0]

    def layout(self) -> tuple[int, dict[int, tuple[int, bool]]]:
        """The candidates' paths and those above them, as path -> (parent
        path, landmark), and one number that names this set."""
        found: dict[int, tuple[int, bool]] = {}
        for node, _ in self.blocks:
            while self.prior[node] != 0 and self.paths[node] not in found:
                up = self.parents[node]
                landmark = self.tags[node] in LANDMARK_TAGS or node in self.main_roles
                found[self.paths[node]] = (self.paths[up] if node else 0, landmark)
                if not node:
                    break
                node = up
        return _mix(*sorted(found)), found

    def main_text(self, tree: StyleTree) -> str:
        """The blocks that are neither furniture nor of low importance."""
        return "\n".join(
            text for path, text in self.candidates() if path not in tree.gone and _mix(path, _mix(text)) not in tree.repeated
        )


class StyleTree:
    """What one layout loses: the paths ``gone`` and the repeated blocks, as
    hashes of path and text. An entry has path, parent, landmark, importance
    and repeated (the hash of a text); both are null without evidence."""

    def __init__(self, entries: list[dict] | None):
        nodes = {e["path"]: e for e in entries or []}
        order: list[int] = []  # parents before children
        seen = {0}
        for path in nodes:
            chain = []
            while path not in seen:
                seen.add(path)
                chain.append(path)
                path = nodes[path]["parent"]
            order += reversed(chain)
        # The greatest importance in a branch, and in the landmark around a node.
        own = {p: 1.0 if e["importance"] is None else e["importance"] for p, e in nodes.items()}
        best = dict(own)
        for path in reversed(order):
            up = nodes[path]["parent"]
            if up:
                best[up] = max(best[up], best[path])
        kept: dict[int, bool] = {0: False}  # in a landmark that would go as a whole
        holds = {p: e["landmark"] for p, e in nodes.items()}
        for path in reversed(order):
            up = nodes[path]["parent"]
            if up and holds[path]:
                holds[up] = True
        self.gone: set[int] = set()
        self.repeated: set[int] = set()
        for path in order:
            node = nodes[path]
            kept[path] = best[path] < LEAST if node["landmark"] else kept[node["parent"]]
            if kept[path]:
                continue
            if best[path] < LEAST and not holds[path]:
                self.gone.add(path)
            elif node["repeated"] is not None:
                self.repeated.add(_mix(path, node["repeated"]))


FACTS = "host string, path long, parent long, kind int, value long, n long, pages long, having long"


def page_facts(pages: DataFrame) -> DataFrame:
    """FACTS of the pages (url, html), counted: kind 0 and 1 as in
    ``Page.facts``; kind 2, or 3 for a landmark, the paths of each layout,
    named by value. ``pages`` counts a page once per path and kind, ``having``
    once per value of these."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[tuple, list[int]] = {}
            for url, html in zip(batch["url"].to_pylist(), batch["html"].to_pylist(), strict=True):
                host, page, seen, values = host_of(url), Page(html), set(), set()
                for fact in page.facts():
                    entry = counts.setdefault((host, *fact), [0, 0, 0])
                    entry[0] += 1
                    if fact not in values:
                        values.add(fact)
                        entry[2] += 1
                    if (fact[0], fact[2]) not in seen:
                        seen.add((fact[0], fact[2]))
                        entry[1] += 1
                name, layout = page.layout()
                for path, (parent, landmark) in layout.items():
                    counts.setdefault((host, path, parent, 3 if landmark else 2, name), [0, 0, 0])
            columns = list(zip(*((*k, *v) for k, v in counts.items()), strict=True)) or [()] * 8
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                ["host", "path", "parent", "kind", "value", "n", "pages", "having"],
            )

    return (
        pages.mapInArrow(run, FACTS)
        .groupBy("host", "path", "parent", "kind", "value")
        .agg(*[F.sum(c).alias(c) for c in ("n", "pages", "having")])
    )


def importances(facts: DataFrame) -> DataFrame:
    """host, path, importance, repeated of the style nodes with evidence."""
    node = ["host", "path", "parent", "kind"]
    # A page says a text once, however often it repeats it.
    stats = (
        facts.where("kind < 2")
        .withColumn("n", F.when(F.col("kind") == 1, F.col("having")).otherwise(F.col("n")))
        .groupBy(*node)
        .agg(
            F.sum("n").alias("n"),
            F.sum("pages").alias("pages"),
            F.sum(F.col("n") * F.ln("n")).alias("nlogn"),
            F.max(F.struct("having", "value")).alias("top"),
        )
        .where(F.col("pages") >= MIN_PAGES)
        .select(
            *node,
            "n",
            # -sum p log p to the base of the number of occurrences.
            (1 - F.col("nlogn") / F.col("n") / F.ln("n")).alias("entropy"),
            F.when(
                (F.col("kind") == 1) & (F.col("top.having") >= MIN_PAGES) & (F.col("top.having") > F.col("pages") * REPEATED),
                F.col("top.value"),
            ).alias("repeated"),
        )
    )
    stats = written(stats, "style-nodes")
    # The parts of a branch: its child branches, and its blocks.
    own = stats.where("kind = 0").select("host", "path", "parent", "n", "entropy")
    blocks = stats.where("kind = 1").select("host", "path", F.col("n").alias("n_text"), F.col("entropy").alias("h_text"), "repeated")
    below = own.where("parent != 0").groupBy("host", F.col("parent").alias("path")).agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("n_below"))
    whole = F.coalesce("n_below", F.lit(0)) + F.coalesce("n_text", F.lit(0))
    parts = F.coalesce("k", F.lit(0)) + F.when(F.col("n_text").isNotNull(), 1).otherwise(0)
    weight = F.when(parts > 0, F.pow(F.lit(GAMMA), parts)).otherwise(F.lit(0.0))
    nodes = own.join(below, ["host", "path"], "left").join(blocks, ["host", "path"], "left")
    nodes = nodes.withColumns({"weight": weight, "whole": whole}).withColumn(
        "x", (1 - F.col("weight")) * F.col("entropy") + F.coalesce(F.col("weight") * F.col("n_text") * F.col("h_text") / F.col("whole"), F.lit(0.0))
    )
    nodes = written(nodes.select("host", "path", "parent", "n", "weight", "whole", "x", "repeated"), "style-tree")
    # A branch adds share * x to the branch above: x is summed over all
    # branches below by doubling the distance of ``up`` each round.
    above = nodes.select("host", F.col("path").alias("parent"), F.col("weight").alias("w"), F.col("whole").alias("s"))
    tree = nodes.join(above, ["host", "parent"], "left").select(
        "host", "path", "x", "repeated", F.when(F.col("w").isNotNull(), F.col("parent")).alias("up"), (F.col("w") * F.col("n") / F.col("s")).alias("share")
    )
    tree = written(tree, "style-tree")
    while not tree.where("up is not null").isEmpty():
        added = tree.where("up is not null").groupBy("host", F.col("up").alias("path")).agg(F.sum(F.col("share") * F.col("x")).alias("more"))
        further = tree.select("host", F.col("path").alias("up"), F.col("up").alias("up2"), F.col("share").alias("share2"))
        tree = tree.join(added, ["host", "path"], "left").join(further, ["host", "up"], "left")
        tree = written(
            tree.select(
                "host", "path", (F.col("x") + F.coalesce("more", F.lit(0.0))).alias("x"), "repeated",
                F.col("up2").alias("up"), (F.col("share") * F.col("share2")).alias("share"),
            ),
            "style-tree",
        )
    # Rounded: the order of the sums decides nothing.
    return tree.select("host", "path", F.round("x", 9).alias("importance"), "repeated")


def layout_losses(facts: DataFrame) -> DataFrame:
    """host, layout, gone, repeated (see StyleTree) of the layouts that lose
    something."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            trees = [StyleTree(x) for x in batch["nodes"].to_pylist()]
            lists = [pa.array([sorted(getattr(t, k)) for t in trees], pa.list_(pa.int64())) for k in ("gone", "repeated")]
            yield pa.RecordBatch.from_arrays([batch["host"], batch["layout"], *lists], ["host", "layout", "gone", "repeated"])

    layouts = facts.where("kind >= 2").select(
        "host", F.col("value").alias("layout"), "path", "parent", (F.col("kind") == 3).alias("landmark")
    )
    return (
        layouts.join(importances(facts), ["host", "path"], "left")
        .groupBy("host", "layout")
        .agg(F.collect_list(F.struct("path", "parent", "landmark", "importance", "repeated")).alias("nodes"))
        .mapInArrow(run, "host string, layout long, gone array<bigint>, repeated array<bigint>")
        .where("size(gone) > 0 or size(repeated) > 0")
    )


BLOCKS = pa.list_(pa.struct([("path", pa.int64()), ("mark", pa.int64()), ("text", pa.string())]))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """id, url, text (the main text) of every page."""
    prepare(pages.sparkSession)
    slim = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    facts = written(page_facts(slim.select("url", "html")), "style-facts")
    # Written, so that its size is known to the planner: few layouts are
    # broadcast, many are joined by shuffle.
    losses = written(layout_losses(facts), "style-losses")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, layouts, blocks = [], [], []
            for url, html in zip(batch["url"].to_pylist(), batch["html"].to_pylist(), strict=True):
                page = Page(html)
                hosts.append(host_of(url))
                layouts.append(page.layout()[0])
                blocks.append([{"path": p, "mark": _mix(p, _mix(t)), "text": t} for p, t in page.candidates()])
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["url"], pa.array(hosts, pa.string()), pa.array(layouts, pa.int64()), pa.array(blocks, BLOCKS)],
                ["id", "url", "host", "layout", "blocks"],
            )

    id_type = slim.schema["id"].dataType.simpleString()
    read = slim.mapInArrow(
        run, f"id {id_type}, url string, host string, layout long, blocks array<struct<path:bigint,mark:bigint,text:string>>"
    )

    def stays(block: Column) -> Column:
        return ~F.array_contains("gone", block["path"]) & ~F.array_contains("repeated", block["mark"])

    kept = F.when(F.col("gone").isNull(), F.col("blocks")).otherwise(F.filter("blocks", stays))
    return read.join(losses, ["host", "layout"], "left").select(
        "id", "url", F.array_join(F.transform(kept, lambda x: x["text"]), "\n").alias("text")
    )
