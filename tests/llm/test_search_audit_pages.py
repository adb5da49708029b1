"""Lexical search, divergence audit and page extraction against brute force, and their cases at the edges."""
import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from seqintel.llm import divergence, lexical_search, site_tree
from test_llm_operators import EDGES, LONG, table

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LETTERS = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def found(pattern, text):
    return pattern.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


# lexical search --------------------------------------------------------------
def brute_search(docs, items, k):
    words = [found(ALNUM, t) for _, t in docs]
    n_docs, n_terms = sum(bool(w) for w in words), sum(map(len, words))
    df = Counter(t for w in words for t in set(w))
    out = []
    for item, text in items:
        rows = []
        for (doc, _), w in zip(docs, words):
            tf, score = Counter(w), 0
            for t, times in Counter(found(ALNUM, text)).items():
                if tf[t]:
                    weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    m = 75 + 25 * len(w) * n_docs // n_terms
                    score += times * weight * (1000000000 * tf[t] // (1000 * tf[t] + 12 * m))
            if score > 0:
                rows.append((-score, doc is None, doc or 0))
        out += [(item, i + 1, None if none else doc, -score) for i, (score, none, doc) in enumerate(sorted(rows)[:k])]
    return sorted(out, key=repr)


ITEMS = [(1, "three FOUR five five"), (2, None), (3, "no such-Words"), (3, "word1 other2 straße"), (4, ""), (5, "x one 🙂"), (6, LONG[:4000])]


@pytest.mark.parametrize("k", [1, 3, 20])
def test_search_edges(spark, k, monkeypatch):
    docs = table(spark, EDGES * 2)
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumns({c: F.lit(c) for c in ("score", "query", "doc_id")})
    got = lexical_search.rank(spark, docs, items, k)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_search([(i, t) for i, t, _ in EDGES * 2], ITEMS, k)


@pytest.mark.parametrize("limits", [{}, {"BLOCK_DOCS": 7, "FIRST": 1}, {"PASS_ITEMS": 2, "BLOCK_POSTINGS": 5}])
def test_search_many_ties_blocks_and_long_items(spark, limits, monkeypatch):
    for name, value in limits.items():
        monkeypatch.setattr(lexical_search, name, value)
    rng = random.Random(3)
    vocabulary = [f"t{i}" for i in range(90)]
    docs = [(i, " ".join(rng.choices(vocabulary, [1 / (j + 1) for j in range(90)], k=rng.randint(0, 40)))) for i in range(300)]
    docs += [(1000 + i, docs[5][1]) for i in range(60)]  # equal scores
    items = [(1, docs[5][1]), (2, " ".join(vocabulary)), (3, "t0"), (4, "t89 t88 t0 t0 t0")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = lexical_search.rank(spark, frame, spark.createDataFrame(items, "item_id long, text string"))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_search(docs, items, 20)


def test_search_scores_only_what_can_win(spark):
    """With masks in order of their bounds, rare terms are found without scoring all documents."""
    n = 4000
    text = [(i, "common" + " rare" * (i < 30)) for i in range(n)]
    vocabulary = {b"common": 0, b"rare": 1}
    row = lexical_search.index(spark.createDataFrame(text, "doc_id long, text string").coalesce(1), vocabulary).collect()[0].asDict()
    block = lexical_search.Block(row, 2 * n, n, 2)
    scored = []
    plain = block.scores
    block.scores = lambda docs: scored.append(len(docs)) or plain(docs)
    import numpy as np
    best = lexical_search._Best(20)
    block.search(np.array([0, 1]), np.array([10, 5000]), best)
    assert sum(scored) == 30 and len(best.score) == 20


def test_search_empty(spark):
    docs, items = table(spark, EDGES), spark.createDataFrame(ITEMS, "item_id long, text string")
    assert lexical_search.rank(spark, docs.limit(0), items).count() == 0
    assert lexical_search.rank(spark, docs, items.limit(0)).count() == 0
    assert lexical_search.rank(spark, table(spark, [(1, None, "a"), (2, "--", "a")]), items).count() == 0


# divergence audit ------------------------------------------------------------
def brute_audit(docs, least=3, ranks=200):
    rows = [(lang or "", source or "", found(LETTERS, text)) for lang, source, text in docs]
    inside, total = defaultdict(Counter), defaultdict(Counter)
    group = defaultdict(Counter)
    for lang, source, words in rows:
        inside[lang].update(set(words))
        total[lang].update(words)
        group[lang, source].update(words)
    out = []
    for lang, source in group:
        kept = [t for t, n in inside[lang].items() if n >= least]
        size = {s: sum(group[lang, s][t] for t in kept) for x, s in group if x == lang}
        whole = sum(total[lang][t] for t in kept)

        def share(count, n):
            return 1 + 1000000000 * (count + 1) // (n + len(kept))

        pair = [(-sum((p - q) ** 2 // q for p, q in ((share(group[lang, source][t], size[source]), share(group[lang, s][t], size[s])) for t in kept)), s)
                for s in size if s != source]
        term = [(-((p - q) ** 2 // q), t) for t, p, q in ((t, share(group[lang, source][t], size[source]), share(total[lang][t], whole))
                                                         for t in kept if group[lang, source][t]) if p > q]
        for part, values in (("pair", pair), ("term", term)):
            values.sort(key=lambda v: (v[0], v[1].encode()))
            out += [(lang, source, part, item, -value, i + 1) for i, (value, item) in enumerate(values[:ranks if part == "term" else None])]
    return sorted(out)


def audit_rows(spark, docs, **options):
    frame = spark.createDataFrame(docs, "lang string, source string, text string").withColumns(
        {c: F.lit(c) for c in ("digest", "term", "n", "docs", "value", "id", "p", "split")})
    return sorted(tuple(r) for r in divergence.audit(spark, frame, **options).collect())


def audit_docs():
    rng = random.Random(5)
    words = [f"{a}{b}" for a in ("na", "ño", "zz", "École", "ÉCOLE", "x") for b in "abcdefghij"] + ["it's", "a1b"]
    docs = [(rng.choice(["en", "de"]), f"s{min(int(rng.expovariate(0.5)), 6)}", " ".join(rng.choices(words, k=rng.randint(0, 30)))) for _ in range(150)]
    return docs + [(None, None, "alone alone alone"), (None, "b", None), ("", "", "alone"), ("", None, "alone x"), ("fr", "only", "deux mots"),
                   ("en", "none", ""), ("en", "long", " ".join(rng.choices(words, k=40_000)))] + [("en", "s0", "the same text")] * 20


@pytest.mark.parametrize("options", [{}, {"bits": 5}, {"bits": 3, "held": 40}, {"ranks": 3}, {"least_docs": 1000}, {"least_docs": 1, "bits": 4}])
def test_audit(spark, options):
    docs = audit_docs()
    want = brute_audit(docs, options.get("least_docs", 3), options.get("ranks", 200))
    assert audit_rows(spark, docs, **options) == want and any(r[2] == "pair" for r in want)


def test_audit_empty(spark):
    assert audit_rows(spark, [("a", "b", "c")][:0]) == []


def test_audit_count_shuffle_has_no_strings(spark):
    raw = divergence.counts(spark.createDataFrame(audit_docs(), "lang string, source string, text string"))
    rows = divergence._summed(raw.select("digest", "group", "n", "docs"), "digest", least=3)
    assert {kind for _, kind in rows.dtypes} == {"bigint"}


# page extraction -------------------------------------------------------------
def brute_pages(pages, threshold=site_tree.THRESHOLD):
    """The same tree, gathered page by page in dictionaries."""
    read = [(site_tree.host_of(u or ""), site_tree.Page(h or "")) for u, h in pages]
    leads, first = {}, {}
    for i, (host, p) in enumerate(read):
        rank = (site_tree._signed([p.print()])[0], i)
        leads[host, p.identity()] = min(leads.get((host, p.identity()), rank), rank)
        first[p.identity()] = min(first.get(p.identity(), rank), rank)
    said, shown = defaultdict(lambda: defaultdict(set)), defaultdict(lambda: defaultdict(set))
    for i in {i for _, i in leads.values()}:
        host, p = read[i]
        trees = [host] + [None] * (first[p.identity()][1] == i)
        for t, o in zip(p.texts, p.owner):
            for tree in trees:
                said[tree, p.key[o]][t].add(i)
        for node, style, inner in zip(p.key, p.style, p.parent):
            if inner:
                shown[host, node][style].add(i)

    def content(tree, node):
        ks, m = [len(v) for v in said[tree, node].values()], len(set().union(*said[tree, node].values()))
        return m, sum(k * (1 - math.log(k) / math.log(m)) if m > 1 else k for k in ks) / sum(ks)

    def importance(host, node):
        if (host, node) not in said:
            return 1.0
        m, own = content(host, node)
        n, wide = content(None, node) if (None, node) in said else (0, 1.0)
        wide = (n * wide + site_tree.PRIOR) / (n + site_tree.PRIOR)
        return (m * own + site_tree.PRIOR * wide) / (m + site_tree.PRIOR)

    def presentation(host, node):
        if (host, node) not in shown:
            return 0
        ks, m = [len(v) for v in shown[host, node].values()], len(set().union(*shown[host, node].values()))
        if m < 2:
            return 0
        h = -sum(k / sum(ks) * math.log(k / sum(ks), m) for k in ks)
        return (1 - site_tree.GAMMA ** len(ks)) * h * m / (m + site_tree.PRIOR)

    out = []
    for host, p in read:
        keep = [True] * len(p.texts)
        for i in range(1, len(p.key)):
            inside = range(p.lo[i], p.hi[i])
            size = max(sum(len(p.texts[b]) for b in inside), 1)
            mean = sum(len(p.texts[b]) * importance(host, p.key[p.owner[b]]) for b in inside) / size
            if p.named[i] or max(mean, presentation(host, p.key[i])) < threshold:
                for b in inside:
                    keep[b] = False
        out.append("\n".join(t for t, k in zip(p.texts, keep) if k))
    return out


def extract(spark, pages, **options):
    frame = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(pages)], "page_id long, url string, html string").withColumns(
        {c: F.lit(c) for c in ("row", "host", "node", "known", "text", "texts")})
    return [r["text"] for r in sorted(site_tree.main_text(spark, frame, **options).collect())]


def news(i, host="http://news.example", extra=""):
    rng = random.Random(i)
    body = "".join(f"<p>{' '.join(f'w{rng.randrange(900)}' for _ in range(20))}" for _ in range(rng.randint(1, 6)))
    return f"{host}/{i}", (f"<html><head><title>Story {i}</title></head><body class='has-sidebar'><div class=top>My Site <b>Home</b> About</div>"
                           f"<div class=x7>All stories of the week in one letter, free of charge.</div><div class=story><h1>Story {i}</h1>{body}{extra}</div>"
                           f"<div class=legal>Copyright of the site. All rights kept.</div></body></html>")


def test_pages_unnamed_branches_go_by_entropy(spark):
    pages = [news(i) for i in range(30)] + [news(3, "http://copy.example") for _ in range(20)] + [news(77, "http://small.example")]
    got = extract(spark, pages)
    assert got == brute_pages(pages) == extract(spark, pages, tree_bound=3)
    for i, text in enumerate(got[:30]):
        assert text.startswith(f"Story {i}\n") and "My Site" not in text and "letter" not in text and "Copyright" not in text
    assert got[-1].startswith("Story 77")  # one page of its host: the tree of all hosts tells
    assert all("Story 3" in t for t in got[30:50])  # copies do not make an article a menu


def test_pages_named_parts_and_broken_markup(spark):
    pages = [
        ("http://a.example/1", "<nav>menu</nav><header>site</header><article><header><h1>A &amp; B</h1></header><p>one\n <b>two</b><br>three<p>four &lt;5&gt; é &copy;"
                               "<script>var t='</p>';</script><style>p{}</style><!-- no > --><div class='comments'><p>me too</p></div><form>mail <input></form>"
                               "<aside>see</aside><ul><li>x<li>y</ul>a < b</article><footer>end</footer>"),
        (None, None), ("no host", ""), ("http://a.example/2", "plain text only"), ("http://a.example/3", "<p>cut <b"),
        ("http://a.example/4", "<div class=\"story with-sidebar\"><h1>T</h1><p title='a>b' hidden=no>gone</p><p data-x=a>b</p></div>"),
        ("http://a.example/5", "<p>a<!-- open"), ("http://a.example/6", "</p></div>x<SCRIPT>y</ScRiPt >z<table><tr><td>1<td>2<tr><td>3</table>"),
    ]
    got = extract(spark, pages)
    assert got == brute_pages(pages)
    assert got == ["A & B\none two three\nfour <5> é ©\nx\ny\na < b", "", "", "plain text only", "cut", "T\nb", "a", "xz\n1\n2\n3"]


def test_pages_long_and_deep(spark):
    deep = "<div>" * 20_000 + "deep" + "</div>" * 20_000 + "<p>" + "long " * 200_000
    got = extract(spark, [("http://a.example/1", deep), ("http://a.example/2", "<b>" * 50_000 + "x</i>" * 1000), ("http://a.example/3", "<" * 100_000)])
    assert got[0].startswith("deep\nlong long") and len(got[0]) == 5 + 5 * 200_000 - 1
    assert got[1].startswith("xxx") and got[2] == "<" * 100_000


def test_pages_given_tables(spark):
    """On the given pages the extraction is what their article elements hold."""
    import html as entities

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    got = extract(spark, [(p.url, p.html) for p in pages])
    for p, text in zip(pages, got):
        article = re.search("<article>(.*?)</article>", p.html, re.S).group(1).replace("<br>", " ")
        blocks = (" ".join(entities.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1)>", article))
        assert text == "\n".join(b for b in blocks if b)
    assert got == brute_pages([(p.url, p.html) for p in pages])


def test_pages_empty(spark):
    assert extract(spark, [("a", "b")][:0]) == []
