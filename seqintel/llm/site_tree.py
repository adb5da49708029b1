"""Main text of web pages by site style trees.

The pages of one host are built from the same parts. Each page is parsed into
elements; elements of all pages of a host that have the same path (tags, class
and id from the root down) are one node of the host's tree. A node gathers

* its *styles*: the sequences of child elements that it has on the pages, whose
  entropy is the importance of its presentation, and
* its *contents*: the text blocks directly in it. A block that k of the node's
  m pages share has the entropy log k / log m; a node whose pages all say the
  same has importance 0, one whose pages each say something else 1.

Entropies are to the base of the page count, as in the method. Nodes of few
pages lean on the tree of all hosts together, and that one on 1 (``PRIOR``
pages' worth each), so little is removed where little is known. Of pages with the
same title and the same longest block only one feeds the tree, so copies of an
article do not make it look like a menu.

On each page the importance of a branch is the mean importance of its blocks,
weighted by their length, or that of its presentation if it is higher. Branches
below ``THRESHOLD`` go, and so do those whose element or class names say that
they are no part of the article. What is left is joined in page order.

The tree is made of grouped counts of 64-bit hashes: a host with a third of all
pages arrives as partial counts, and no page's text is stored or shuffled for it.
Pages are parsed twice, once for the tree and once for their text.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, text_of

THRESHOLD = 0.5
#: Pages that the wider tree (and 1, beyond it) counts for.
PRIOR = 8
#: Weight of a node's presentation grows with its number of styles l as 1 - GAMMA ** l.
GAMMA = 0.9
#: A tree of at most so many nodes is broadcast.
TREE_NODES = 1 << 20

# Elements of HTML by their role in the flow of text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript object ol optgroup option p pre search "
    "section select summary svg table tbody td template tfoot th thead tr ul".split())
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), "optgroup": ("option", "optgroup"),
    "tr": ("td", "th", "tr"), "td": ("td", "th"), "th": ("td", "th"), "tbody": ("td", "th", "tr", "tbody", "thead"),
    "tfoot": ("td", "th", "tr", "tbody", "thead"), "thead": ("td", "th", "tr", "tbody"), "body": ("head",)}
SCOPES = frozenset("html body table ul ol dl select menu dir article section div td th".split())
# Elements, roles and class words that name parts beside the article.
ASIDE = frozenset("nav footer aside form menu dialog template noscript button select svg object search head".split())
ASIDE_ROLES = frozenset("navigation contentinfo complementary search form alert dialog".split())
ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments cookie cookies disqus footer login menu modal nav "
    "navbar navigation newsletter notice notices notification popup promo related share sharing sidebar signup social sponsor sponsored "
    "subscribe toolbar".split())
# Outside an article or main part only: there, a header is the page's and not the article's.
PAGE_HEAD = frozenset(["header", "masthead"])
ARTICLE = frozenset(["article", "main"])

_TAG = re.compile(r"<([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)>")
_RAW_END = {tag: re.compile(f"</{tag}", re.I) for tag in RAW}
_ATTR = re.compile(r"(?:^|[\s\"'/])(class|id|role|hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|(?=[\s/]|$))", re.I)
_WORD = re.compile(r"[a-z]+|[A-Z][a-z]*")
_HOST = re.compile(r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)")


def host_of(url: str) -> str:
    found = _HOST.match(url)
    return found.group(1).lower() if found else ""


class Page:
    """The text blocks of a page, and its elements with the blocks [lo, hi) inside them."""

    def __init__(self, text: str):
        self.texts, self.owner, self.title = [], [], ""
        self.key, self.lo, self.hi, self.style, self.named, self.parent = [0], [0], [0], [0], [False], [False]
        self.tags, self.own = [""], [False]  # own: an article, a main part or a first heading is inside
        self.open, self.count, self.children, self.buffer = [0], {}, {0: []}, []
        self._read(text)
        self._flush()
        while len(self.open) > 1:
            self._close()
        self.hi[0] = len(self.texts)
        self.style[0] = self._style(0)
        self.named = [n and not o for n, o in zip(self.named, self.own)]

    def _style(self, node: int) -> int:
        return xxhash.xxh3_64_intdigest(" ".join(self.children.pop(node, ())).encode("utf-8", "replace"))

    def _flush(self) -> None:
        if self.buffer:
            block = " ".join("".join(self.buffer).split())
            self.buffer = []
            if block:
                self.texts.append(block)
                self.owner.append(self.open[-1])

    def _close(self) -> None:
        node = self.open.pop()
        self.count[self.tags[node]] -= 1
        self.hi[node] = len(self.texts)
        self.style[node] = self._style(node)
        if self.own[node] or self.tags[node] in ("article", "main", "h1"):
            self.own[self.open[-1]] = True

    def _close_to(self, tag: str) -> None:
        while True:
            last = self.tags[self.open[-1]]
            self._close()
            if last == tag:
                return

    def _start(self, tag: str, attributes: str) -> None:
        self._flush()
        if self.count.get("p") and self.tags[self.open[-1]] == "p":
            self._close()
        ends = CLOSES.get(tag, ())
        while ends and len(self.open) > 1:
            last = self.tags[self.open[-1]]
            if last in ends:
                self._close()
                if tag in ("li", "dt", "dd", "option", "td", "th"):
                    break
            elif last in SCOPES or not any(self.count.get(e) for e in ends):
                break
            else:
                self._close()
        if tag in VOID:
            return
        words, name, hidden = [], [], False
        for found in _ATTR.finditer(attributes) if attributes else ():
            kind, value = found.group(1).lower(), found.group(2) or found.group(3) or found.group(4) or ""
            if kind == "hidden":
                hidden = True
            elif kind == "role":
                hidden |= value.strip().lower() in ASIDE_ROLES or (value.strip().lower() == "banner" and not self._inside())
            else:
                words += [w.lower() for w in _WORD.findall(value)]
                name.append(f"{kind}={re.sub(r'[0-9]+', '#', value)}")
        sign = " ".join((tag, *sorted(name)))
        parent, node = self.open[-1], len(self.key)
        self.children[parent].append(sign)
        self.parent[parent] = True
        self.parent.append(False)
        self.key.append(xxhash.xxh3_64_intdigest(sign.encode("utf-8", "replace"), self.key[parent]))
        named = hidden or tag in ASIDE or (tag not in ("html", "body", *ARTICLE) and not ASIDE_WORDS.isdisjoint(words))
        if not named and (tag in PAGE_HEAD or not PAGE_HEAD.isdisjoint(words)) and tag not in ("html", "body", *ARTICLE):
            named = not self._inside()
        self.named.append(named)
        # what only a container's class names say is not believed where the article itself is inside
        self.own.append(False)
        self.tags.append(tag)
        self.lo.append(len(self.texts))
        self.hi.append(0)
        self.style.append(0)
        self.open.append(node)
        self.children[node] = []
        self.count[tag] = self.count.get(tag, 0) + 1

    def _inside(self) -> bool:
        return any(self.count.get(t) for t in ARTICLE)

    def _end(self, tag: str) -> None:
        if tag in BLOCK:
            self._flush()
            if self.count.get(tag):
                self._close_to(tag)

    def _read(self, text: str) -> None:
        pos = 0
        while True:
            at = text.find("<", pos)
            if at < 0:
                self._text(text[pos:])
                return
            if at > pos:
                self._text(text[pos:at])
            nxt = text[at + 1:at + 2]
            if nxt.isascii() and nxt.isalpha():
                found = _TAG.match(text, at)
                if not found:  # the page ends inside a tag
                    return
                tag, attributes, pos = found.group(1).lower(), found.group(2), found.end()
                if tag in RAW:
                    end = _RAW_END[tag].search(text, pos)
                    if not end:
                        return
                    if tag == "title" and not self.title:
                        self.title = " ".join(entities.unescape(text[pos:end.start()]).split())
                    stop = text.find(">", end.end())
                    if stop < 0:
                        return
                    pos = stop + 1
                elif tag in BLOCK:
                    self._start(tag, attributes)
                elif tag == "br":
                    self.buffer.append(" ")
            elif nxt == "/":
                stop = text.find(">", at)
                if stop < 0:
                    return
                self._end(text[at + 2:stop].split("/")[0].strip().lower())
                pos = stop + 1
            elif text.startswith("<!--", at):
                stop = text.find("-->", at + 2 if text.startswith("<!-->", at) else at + 4)
                if stop < 0:
                    return
                pos = stop + 3
            elif nxt in ("!", "?"):
                stop = text.find(">", at)
                if stop < 0:
                    return
                pos = stop + 1
            else:
                self._text("<")
                pos = at + 1

    def _text(self, text: str) -> None:
        self.buffer.append(entities.unescape(text) if "&" in text else text)

    def identity(self) -> int:
        longest = max(self.texts, key=len, default="")
        return xxhash.xxh3_64_intdigest(f"{self.title}\n{longest}".encode("utf-8", "replace"))

    def print(self) -> int:
        return xxhash.xxh3_64_intdigest(np.array([(self.key[o], xxhash.xxh3_64_intdigest(_bytes(t))) for o, t in zip(self.owner, self.texts)], "<u8").tobytes())


def _bytes(text: str) -> bytes:
    return text.encode("utf-8", "replace")


def _signed(values) -> np.ndarray:
    return np.array(list(values), "<u8").view("<i8")


def _lists(parts, hashed: bool) -> pa.ListArray:
    parts = list(parts)
    flat = [v for p in parts for v in p]
    values = pa.array(_signed(flat)) if hashed else pa.array(flat, pa.string())
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, parts)], dtype=np.int32)), values)


def _place(hosts, nodes):
    """A node of one host's tree: the node's path and the host in one number."""
    return nodes ^ hosts


def features(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """What the tree is made of, without texts: one row per page, its distinct (node, block) and (node, style) pairs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [Page(h.as_py()) for h in batch.column(1)]
            said = [list({(p.key[o], xxhash.xxh3_64_intdigest(_bytes(t))) for o, t in zip(p.owner, p.texts)}) for p in found]
            shown = [list({(k, s) for k, s, c in zip(p.key, p.style, p.parent) if c}) for p in found]
            yield pa.RecordBatch.from_arrays([
                pa.array(_signed(xxhash.xxh3_64_intdigest(_bytes(host_of(u or ""))) for u in batch.column(0).to_pylist())),
                pa.array(_signed(p.identity() for p in found)), pa.array(_signed(p.print() for p in found)),
                _lists(([n for n, _ in x] for x in said), True), _lists(([f for _, f in x] for x in said), True),
                _lists(([n for n, _ in x] for x in shown), True), _lists(([f for _, f in x] for x in shown), True)],
                names=["host", "identity", "print", "owner", "said", "node", "style"])

    return pages.select(F.col(url_col).cast("string").alias("url"), text_of(html_col).alias("html")).mapInArrow(
        run, "host long, identity long, print long, owner array<long>, said array<long>, node array<long>, style array<long>")


def tree(rows: DataFrame) -> DataFrame:
    """(place, content, presentation): the importance of each node of each host's tree, from stored features with a row number."""
    lead = rows.groupBy("host", "identity").agg(F.min(F.struct("print", "row")).alias("lead"))
    first = lead.groupBy("identity").agg(F.min("lead").alias("first"))
    lead = lead.join(first, "identity").select(F.col("lead.row").alias("row"), (F.col("lead") == F.col("first")).alias("first"))
    led = rows.join(lead, "row")

    def counted(found: DataFrame, node: str, feature: str) -> DataFrame:
        """(place, node, m, total, spread) of each node: pages, features and the sum of k log k."""
        pairs = found.select("host", F.explode(F.arrays_zip(node, feature)).alias("e")).select(
            _place_of(F.col(f"e.{node}")).alias("place"), F.col(f"e.{feature}").alias("feature"))
        k = pairs.groupBy("place", "feature").agg(F.count("*").alias("k")).groupBy("place").agg(
            F.sum("k").alias("total"), F.sum(F.col("k") * F.log("k")).alias("spread"), F.count("*").alias("l"))
        m = found.select("host", F.explode(F.array_distinct(node)).alias("node")).groupBy(
            _place_of(F.col("node")).alias("place")).agg(F.count("*").alias("m"), F.min("node").alias("node"))
        return k.join(m, "place")

    def _place_of(node):
        return node.bitwiseXOR(F.col("host"))

    unequal = F.when(F.col("m") > 1, 1 - F.col("spread") / (F.col("total") * F.log("m"))).otherwise(1.0)
    wide = counted(led.filter("first").withColumn("host", F.lit(0).cast("long")), "owner", "said").select(
        "node", ((F.col("m") * unequal + PRIOR) / (F.col("m") + PRIOR)).alias("wide"))
    said = counted(led, "owner", "said").join(wide, "node", "left").select(
        "place", ((F.col("m") * unequal + PRIOR * F.coalesce("wide", F.lit(1.0))) / (F.col("m") + PRIOR)).alias("content"))
    shown = counted(led, "node", "style").select("place", F.when(F.col("m") > 1, (F.log("total") - F.col("spread") / F.col("total")) / F.log("m")
                                                 * (1 - F.pow(F.lit(GAMMA), "l")) * F.col("m") / (F.col("m") + PRIOR)).otherwise(0.0).alias("presentation"))
    return said.join(shown, "place", "full").select("place", F.coalesce("content", F.lit(1.0)).alias("content"),
                                                    F.coalesce("presentation", F.lit(0.0)).alias("presentation"))


def _main(page: Page, content: np.ndarray, shown: np.ndarray, threshold: float) -> str:
    """The blocks of one page that lie in no branch of low importance."""
    size = np.array([len(t) for t in page.texts], float)
    mass = np.concatenate(([0.0], np.cumsum(size * content)))
    upto = np.concatenate(([0.0], np.cumsum(size)))
    lo, hi = np.array(page.lo), np.array(page.hi)
    held = np.maximum(upto[hi] - upto[lo], 1.0)
    low = (np.maximum((mass[hi] - mass[lo]) / held, shown) < threshold) | np.array(page.named, bool)
    low[0] = False  # the page itself
    gone = np.zeros(len(page.texts) + 1, np.int64)
    np.add.at(gone, lo[low], 1)
    np.add.at(gone, hi[low], -1)
    return "\n".join(t for t, g in zip(page.texts, np.cumsum(gone)) if not g)


def _pruned(page: Page, host: str, places: np.ndarray, content: np.ndarray, shown: np.ndarray, threshold: float) -> str:
    """``places``: sorted, with the importance of each; a place that is not among them counts as important."""
    mine = _place(np.int64(_signed([xxhash.xxh3_64_intdigest(_bytes(host))])[0]), _signed(page.key))
    at = np.searchsorted(places, mine)
    at[at == len(places)] = 0
    known = places[at] == mine if len(places) else np.zeros(len(mine), bool)
    value = np.where(known, content[at], 1.0) if len(places) else np.ones(len(mine))
    style = np.where(known, shown[at], 0.0) if len(places) else np.zeros(len(mine))
    return _main(page, value[page.owner] if page.owner else np.zeros(0), style, threshold)


def main_text(spark: SparkSession, pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
              threshold: float = THRESHOLD, tree_bound: int = TREE_NODES) -> DataFrame:
    """One row per page: page_id, url, text.

    Character references are decoded, white space inside a block is one space,
    blocks are joined by a line feed. Null and empty pages give an empty text; a
    null address or one without a host belongs to the host ''. Rows that repeat
    an id or a whole page are pages of their own. A page of any length and depth
    is read whole, in time and memory in proportion to it; unclosed elements end
    where HTML ends them, a page that ends inside a tag, comment or script ends
    there. An empty table gives an empty result; other columns are not read.

    The tree is broadcast if it has ``tree_bound`` nodes at most (24 bytes
    each); a larger one is joined to the pages, with the same result.
    """
    rows = stored(spark, features(pages, url_col, html_col).withColumn("row", F.monotonically_increasing_id()), "site-features")
    nodes = stored(spark, tree(rows), "site-tree")
    kind = pages.schema[id_col].dataType.simpleString()
    schema, names = f"page_id {kind}, url string, text string", ["page_id", "url", "text"]
    texts = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), text_of(html_col).alias("html"))

    if nodes.count() <= tree_bound:
        table = nodes.toPandas().sort_values("place")
        whole = [table[c].to_numpy() for c in ("place", "content", "presentation")]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = [_pruned(Page(h.as_py()), host_of(u.as_py() or ""), *whole, threshold) for u, h in zip(batch.column(1), batch.column(2))]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string())], names=names)

        return texts.mapInArrow(run, schema)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for u, h in zip(batch.column(1), batch.column(2)):
                host = _signed([xxhash.xxh3_64_intdigest(_bytes(host_of(u.as_py() or "")))])[0]
                found.append(np.unique(_place(host, _signed(Page(h.as_py()).key))).view("<u8").tolist())
            yield pa.RecordBatch.from_arrays([*batch.columns, _lists(found, True)], names=[*names[:2], "html", "row", "places"])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for u, h, known in zip(*(batch.column(c) for c in ("url", "html", "known"))):
                known = sorted((k["place"], k["content"], k["presentation"]) for k in known.as_py() or ())
                mine = [np.array(c) for c in zip(*known)] or [np.zeros(0, np.int64), np.zeros(0), np.zeros(0)]
                out.append(_pruned(Page(h.as_py()), host_of(u.as_py() or ""), *mine, threshold))
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(out, pa.string())], names=names)

    placed = stored(spark, texts.withColumn("row", F.monotonically_increasing_id()).mapInArrow(
        places, f"page_id {kind}, url string, html string, row long, places array<long>"), "site-pages")
    known = placed.select("row", F.explode("places").alias("place")).join(nodes, "place").groupBy("row").agg(
        F.collect_list(F.struct("place", "content", "presentation")).alias("known"))
    return placed.join(known, "row", "left").select("page_id", "url", "html", "known").mapInArrow(joined, schema)
