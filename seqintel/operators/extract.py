"""Pages -> links (K3, E8) and pages -> posts (K2); reply join.

Links are pulled with built-in regex functions (no Python). Post extraction
needs elements and their nesting, so an Arrow UDF reads each page with the
standard-library ``html.parser`` and returns the elements that a selector
names (the selector lists are data, see ``dictionaries``); which of them
makes up a post is then chosen by built-in expressions.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .. import dictionaries as D
from ..functions import text as TX

ATTR_LINK = r"""(?i)<(?:a|link|iframe)\b[^>]*?\s{attr}\s*=\s*["']?([^"'\s>]*)"""
TEXT_ONION_URL = r"""https?://[^\s"']+\.onion[^\s"']*"""
ORIGIN = r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)"
VISIBLE_DROP = r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->"


def visible_text(html) -> F.Column:
    """Tag-stripped text (script / style / comments removed), runs of
    whitespace collapsed."""
    h = F.col(html) if isinstance(html, str) else html
    t = F.regexp_replace(h, VISIBLE_DROP, " ")
    t = F.regexp_replace(t, r"(?s)<[^>]*>", " ")
    return F.trim(F.regexp_replace(t, TX.WS_RUN, " "))


def resolve(href, base_url) -> F.Column:
    """Resolve a link against the page: absolute kept, ``//x`` gets ``http:``,
    ``/x`` gets the page origin."""
    h = F.col(href) if isinstance(href, str) else href
    b = F.col(base_url) if isinstance(base_url, str) else base_url
    origin = F.regexp_extract(b, ORIGIN, 1)
    return (F.when(h.rlike(r"(?i)^https?://"), h)
            .when(h.startswith("//"), F.concat(F.lit("http:"), h))
            .when(h.startswith("/") & (origin != ""), F.concat(origin, h))
            .otherwise(h))


def page_links(pages: DataFrame, marker: str = ".onion", resolve_relative: bool = False,
               id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """K3 + E8: one row per (page, distinct normalised link) from href/src of
    a, link, iframe plus URLs in the visible text."""
    h = F.col(html_col)
    raw = F.concat(F.regexp_extract_all(h, F.lit(ATTR_LINK.format(attr="href")), 1),
                   F.regexp_extract_all(h, F.lit(ATTR_LINK.format(attr="src")), 1),
                   F.regexp_extract_all(visible_text(h), F.lit(TEXT_ONION_URL), 0))
    if resolve_relative:
        raw = F.transform(raw, lambda u: resolve(u, F.col(url_col)))
    links = F.array_distinct(F.transform(raw, lambda u: TX.normalize_url(u, marker)))
    return pages.select(id_col, F.explode(links).alias("link")).where(F.col("link").isNotNull())


def page_link_sets(pages: DataFrame, marker: str = ".onion", resolve_relative: bool = False,
                   id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per page the distinct union of attribute and text links (array)."""
    h = F.col(html_col)
    attr = F.concat(F.regexp_extract_all(h, F.lit(ATTR_LINK.format(attr="href")), 1),
                    F.regexp_extract_all(h, F.lit(ATTR_LINK.format(attr="src")), 1))
    txt = F.regexp_extract_all(visible_text(h), F.lit(TEXT_ONION_URL), 0)

    def norm(arr):
        r = F.transform(arr, lambda u: resolve(u, F.col(url_col))) if resolve_relative else arr
        return F.filter(F.transform(r, lambda u: TX.normalize_url(u, marker)), lambda u: u.isNotNull())

    return pages.select(id_col, F.array_sort(F.array_union(F.array_distinct(norm(attr)),
                                                           F.array_distinct(norm(txt)))).alias("links"))


# -- K2 -----------------------------------------------------------------------
# The page is read once, in document order, by a flat event reader: each
# element gets a position, the position of its last descendant and the interval
# of text pieces inside it. Pieces leave Python once, and of the elements those
# that some selector names, as intervals: what leaves is in proportion to the
# page, however deep its posts are nested. Which element is a post's author,
# time, body or quote is chosen by Spark expressions, and its text put together
# from the pieces in the post's own row.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ROLES = {"container": D.POST_CONTAINER_SELECTORS, "title": D.TITLE_SELECTORS, "author": D.AUTHOR_SELECTORS,
         "clock": ["time"], "time": D.TIME_SELECTORS, "body": D.BODY_SELECTORS, "quote": D.QUOTE_SELECTORS,
         "page": ["body"]}
KEPT_ATTRIBUTES = ("data-post-id", "data-id", "id", "data-parent-id", "data-reply-to", "datetime")
INNER = ("author", "clock", "time", "body", "quote")
#: Bytes of html that are parsed at a time.
PART_BYTES = 1 << 20


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


_INT = T.IntegerType()
_SPAN = dict(pos=_INT, last=_INT, first=_INT, end=_INT, attrs=T.MapType(T.StringType(), T.StringType()))
PAGE = _struct(pieces=T.ArrayType(T.StringType()),
               spots=T.ArrayType(_struct(idx=_INT, depth=_INT, **_SPAN, **{r: _struct(low=_INT, n=_INT) for r in INNER})),
               **{r: T.ArrayType(_struct(rank=_INT, **_SPAN)) for r in (*INNER, "title")})
_SELECTOR = re.compile(r"(?P<tag>[a-z][a-z0-9]*)|\.(?P<cls>[\w-]+)|\[(?P<attr>[\w-]+)(?:(?P<op>[\^*]?=)'(?P<val>[^']*)')?\]")


def _predicate(selector: str):
    """A test (tag, attributes) -> bool for a tag, class or attribute selector."""
    m = _SELECTOR.fullmatch(selector)
    if m is None:
        raise ValueError(f"selector not supported: {selector}")
    tag, cls, attr, op, val = m.group("tag", "cls", "attr", "op", "val")
    if tag:
        return lambda t, a: t == tag
    if cls:
        return lambda t, a: cls in a.get("class", "").split()
    compare = {None: lambda v: True, "=": lambda v: v == val, "^=": lambda v: v.startswith(val), "*=": lambda v: val in v}[op]
    return lambda t, a: attr in a and compare(a[attr])


_TESTS = [(role, rank, _predicate(sel)) for role, sels in ROLES.items() for rank, sel in enumerate(sels)]


class _Reader(HTMLParser):
    """Flat list of elements [tag, attributes, last descendant, first piece, end of pieces] and of text pieces."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.elements, self.pieces, self.open, self.mute = [], [], [], 0

    def handle_starttag(self, tag, attrs):
        at = len(self.elements)
        self.elements.append([tag, {k: v or "" for k, v in attrs}, at, len(self.pieces), len(self.pieces)])
        if tag not in VOID:
            self.open.append(at)
            self.mute += tag in ("script", "style")

    def handle_startendtag(self, tag, attrs):
        at = len(self.elements)
        self.elements.append([tag, {k: v or "" for k, v in attrs}, at, len(self.pieces), len(self.pieces)])

    def shut(self):
        e = self.elements[self.open.pop()]
        e[2], e[4] = len(self.elements) - 1, len(self.pieces)
        self.mute -= e[0] in ("script", "style")

    def handle_endtag(self, tag):
        if any(self.elements[i][0] == tag for i in reversed(self.open)):
            while self.elements[self.open[-1]][0] != tag:
                self.shut()
            self.shut()

    def handle_data(self, data):
        words = data.strip()
        if words and not self.mute:
            self.pieces.append(words)

    def finish(self):
        self.close()
        while self.open:
            self.shut()


def page_elements(html: str | None) -> dict | None:
    """Pieces of one page, its post containers (the body, if there are none) and the
    elements that selectors name; None for a page that cannot be read.

    All are in document order, so the elements inside a container are one run
    (``low``, ``n``) of each role's list."""
    reader = _Reader()
    try:
        reader.feed(html or "")
        reader.finish()
    except Exception:  # noqa: BLE001 - a broken page is marked, the job goes on
        return None
    roles = {role: [] for role in ROLES}
    for pos, (tag, attrs, last, first, end) in enumerate(reader.elements):
        named = [(role, rank) for role, rank, test in _TESTS if test(tag, attrs)]
        if named:
            kept = [(k, attrs[k]) for k in KEPT_ATTRIBUTES if k in attrs]
            for role, rank in named:
                roles[role].append({"rank": rank, "pos": pos, "last": last, "first": first, "end": end, "attrs": kept})
    spots, above = [], []
    for e in roles["container"] or roles["page"][:1]:
        if spots and spots[-1]["pos"] == e["pos"]:  # named by several selectors
            continue
        while above and above[-1] < e["pos"]:
            above.pop()
        spots.append({**e, "idx": len(spots), "depth": len(above)})
        above.append(e["last"])
    for role in INNER:
        at = [e["pos"] for e in roles[role]]
        for spot in spots:
            low = bisect_right(at, spot["pos"])
            spot[role] = {"low": low, "n": bisect_right(at, spot["last"]) - low}
    return {"pieces": reader.pieces, "spots": spots, **{r: roles[r] for r in (*INNER, "title")}}


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about PART_BYTES of html (the last column), a longer page on its own:
    what a worker holds of parsed pages follows the page, not the batch."""
    size = pc.fill_null(pc.binary_length(batch.columns[-1]), 0).to_numpy(zero_copy_only=False)
    start = held = 0
    for i, n in enumerate(size.tolist()):
        if i > start and held + n > PART_BYTES:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if batch.num_rows > start:
        yield batch.slice(start)


def _read(pages: DataFrame) -> DataFrame:
    """``pages`` (with html last) with the fields of ``page_elements`` instead of the html."""
    kept = pages.columns[:-1]
    schema = T.StructType([*pages.schema.fields[:-1], *PAGE.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = to_arrow_type(PAGE)
        for batch in batches:
            for part in _parts(batch):
                found = pa.array([page_elements(h.as_py()) for h in part.column(len(kept))], kind)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *found.flatten()], names=schema.names)

    return pages.mapInArrow(run, schema)


def _text(span: F.Column) -> F.Column:
    return F.when(span.isNotNull(), F.array_join(F.slice("pieces", span["first"] + 1, span["end"] - span["first"]), " "))


def _first_text(role: str, candidates: F.Column) -> F.Column:
    """Text of the first element of the best selector whose first element has text; null if there is none."""
    def of_rank(r):
        return lambda e: e["rank"] == r

    def pick(found):
        firsts = F.array(*[F.get(F.filter(found, of_rank(r)), 0) for r in range(len(ROLES[role]))])
        return F.get(F.filter(firsts, lambda e: e["end"] > e["first"]), 0)

    return _text(TX.let(candidates, pick))


def _inside(role: str) -> F.Column:
    return F.slice(role, F.col(f"c.{role}.low") + 1, F.col(f"c.{role}.n"))


def _attr(of: str, *names: str) -> F.Column:
    return F.coalesce(*[F.nullif(F.element_at(F.col(f"{of}.attrs"), n), F.lit("")) for n in names])


def raw_posts(pages: DataFrame, min_body: int = D.MIN_RAW_BODY) -> DataFrame:
    """One row per post container with the fields as the page writes them."""
    read = _read(pages.select(F.col("page_id").cast("long").alias("page_id"), "url",
                              TX.infer_thread_id("url", "html").alias("thread_id"), "html"))
    posts = read.withColumn(
        "title", F.coalesce(_first_text("title", F.col("title")), F.lit(D.UNTITLED))).withColumn("c", F.explode("spots")).drop("spots")
    # times are in document order: the first one inside
    posts = posts.withColumn("k", F.get(_inside("clock"), 0))
    return posts.select(
        "page_id", F.col("c.idx").alias("idx"), F.col("c.depth").alias("depth"),
        F.coalesce(_attr("c", "data-post-id", "data-id", "id"),
                   F.concat_ws("_", "thread_id", F.col("c.idx").cast("string"))).alias("raw_id"),
        _attr("c", "data-parent-id", "data-reply-to").alias("parent_raw"),
        F.coalesce(_first_text("author", _inside("author")), F.lit(D.UNKNOWN_USER)).alias("author"),
        F.coalesce(_attr("k", "datetime"), F.nullif(_text(F.col("k")), F.lit("")), _first_text("time", _inside("time")),
                   F.lit("")).alias("ts_raw"),
        "title", F.coalesce(_first_text("body", _inside("body")), _text(F.col("c"))).alias("body"),
        _first_text("quote", _inside("quote")).alias("quoted"), "url", "thread_id").where(F.char_length("body") >= min_body)


def unreadable_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url) of the pages that could not be read; they have no posts."""
    return _read(pages.select("page_id", "url", "html")).where(F.col("pieces").isNull()).select("page_id", "url")


def extract_posts(pages: DataFrame, ingest_ts=None, outermost_only: bool = False,
                  min_body: int = D.MIN_RAW_BODY) -> DataFrame:
    """K2: pages -> raw posts with ids (B3/B4), time (B5) and fingerprint.

    ``ingest_ts`` replaces the wall clock for unparseable times (default: the
    job's current timestamp); ``ts_imputed`` marks those rows.
    """
    raw = raw_posts(pages, min_body)
    if outermost_only:
        raw = raw.where(F.col("depth") == 0)
    ing = F.current_timestamp() if ingest_ts is None else F.lit(ingest_ts).cast("timestamp")
    parsed = TX.parse_timestamp_or_null(F.col("ts_raw"))
    return raw.select(
        TX.message_id("url", "raw_id", "idx").alias("message_id"),
        TX.content_fingerprint("body", "title", "author", "thread_id").alias("fingerprint"),
        "thread_id", TX.parent_id("url", "parent_raw").alias("parent_id"), "parent_raw", "raw_id",
        "author", F.coalesce(parsed, ing).alias("ts"), parsed.isNull().alias("ts_imputed"),
        "title", "body", "quoted", "url", "page_id", "idx", "depth")


def reply_pairs(posts: DataFrame) -> DataFrame:
    """Child -> parent post on the same page (``parent_raw = raw_id``)."""
    child = posts.select("url", "raw_id", "parent_raw", "message_id", "author")
    parent = posts.select(F.col("url").alias("_u"), F.col("raw_id").alias("_r"),
                          F.col("message_id").alias("parent_message_id"),
                          F.col("author").alias("parent_author"))
    return child.join(parent, (child["url"] == parent["_u"]) & (child["parent_raw"] == parent["_r"]),
                      "left").drop("_u", "_r")
