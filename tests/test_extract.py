"""K2 post extraction on hand-written pages (FIXTURES.md section 4)."""
import hashlib

from seqintel.operators import extract as EX

PAGE = """<html><head><title>T</title></head><body><h1>Forum title</h1>
<div class="post" data-post-id="p1"><span class="author">alice</span><time datetime="2024-01-02 03:04:05"></time>
  <div class="content">This is the first post body, long enough.</div>
  <blockquote>quoted words here</blockquote></div>
<div class="post" data-post-id="p2" data-parent-id="p1"><span class="username">bob</span>
  <span class="date">02/01/2024 03:04</span><div class="content">short</div></div>
<div class="post" id="post-9"><div class="content">Third post without author or time at all.</div>
  <div class="postbody">nested body content that is long enough</div></div>
</body></html>"""


def frame(spark, rows):
    return spark.createDataFrame(rows, "page_id BIGINT, url STRING, html STRING")


def test_raw_post_fields(spark):
    rows = EX.raw_posts(frame(spark, [(1, "http://x.onion/thread/42", PAGE)])).collect()
    by = {r["raw_id"]: r for r in rows}
    # p2's body ("short") is under 20 characters: dropped, index still advances;
    # the nested div.postbody matches [class*='post'] too: kept, one level deep
    assert set(by) == {"p1", "post-9", "thread_42_3"}
    assert by["thread_42_3"]["depth"] == 1 and by["thread_42_3"]["body"] == "nested body content that is long enough"
    p1 = by["p1"]
    assert p1["idx"] == 0 and p1["author"] == "alice" and p1["ts_raw"] == "2024-01-02 03:04:05"
    assert p1["title"] == "Forum title" and p1["body"] == "This is the first post body, long enough."
    assert p1["quoted"] == "quoted words here" and p1["thread_id"] == "thread_42"
    p9 = by["post-9"]
    assert p9["idx"] == 2 and p9["author"] == "unknown_user" and p9["ts_raw"] == "" and p9["quoted"] is None


def test_no_container_uses_body_and_untitled(spark):
    html = "<html><body><p>plain page text that is long enough</p></body></html>"
    rows = EX.raw_posts(frame(spark, [(2, "http://x.onion/a", html)])).collect()
    assert len(rows) == 1
    r = rows[0]
    assert r["title"] == "sin_titulo" and r["body"] == "plain page text that is long enough"
    assert r["thread_id"] == "thread_" + hashlib.sha1(b"http://x.onion/a").hexdigest()[:16]


def test_deep_empty_and_broken_pages(spark, monkeypatch):
    deep = "<ul>" + "<li class='post'>" * 1200 + "a body that is long enough here"
    pages = frame(spark, [(1, "http://x.onion/t", deep), (2, "http://x.onion/u", ""), (3, "http://x.onion/v", None)])
    rows = EX.raw_posts(pages).collect()
    assert len(rows) == 1200 and max(r["depth"] for r in rows) == 1199
    assert EX.unreadable_pages(pages).count() == 0

    class Broken(EX._Reader):
        def feed(self, data):
            raise ValueError("no page")
    monkeypatch.setattr(EX, "_Reader", Broken)
    assert EX.page_elements("<p>") is None


def test_extract_posts_frame(spark):
    pages = spark.createDataFrame([(1, "http://x.onion/thread/42", PAGE)], "page_id BIGINT, url STRING, html STRING")
    out = {r["raw_id"]: r for r in EX.extract_posts(pages, ingest_ts="2025-01-01 00:00:00").collect()}
    assert out["p1"]["message_id"] == "msg_" + hashlib.sha1(b"http://x.onion/thread/42|p1|0").hexdigest()[:16]
    assert out["p1"]["ts_imputed"] is False and out["post-9"]["ts_imputed"] is True
    assert str(out["post-9"]["ts"]) == "2025-01-01 00:00:00"
    outer = {r["raw_id"] for r in EX.extract_posts(pages, ingest_ts="2025-01-01", outermost_only=True).collect()}
    assert outer == {"p1", "post-9"}


def test_nested_posts_leave_python_in_proportion_to_the_page(spark):
    n = 2000
    nested = "".join(f"<div class='post' id='p{i}'><b class='author'>a{i}</b>some text of the post number {i} that goes on and on for quite a while "
                     for i in range(n)) + "</div>" * n
    read = EX.page_elements(nested)
    size = sum(map(len, read["pieces"])) + sum(len(read[r]) for r in (*EX.INNER, "spots")) * 100
    assert len(nested) > 200_000 and size < 1_000_000
    rows = {r["raw_id"]: r for r in EX.raw_posts(frame(spark, [(1, "http://x.onion/t", nested)])).collect()}
    assert len(rows) == n and rows["p1999"]["depth"] == n - 1 and rows["p7"]["author"] == "a7"
    assert rows["p1999"]["body"] == "a1999 some text of the post number 1999 that goes on and on for quite a while"
    assert rows["p0"]["body"].endswith(rows["p1999"]["body"]) and rows["p0"]["body"].startswith("a0 some text")


def test_siblings_after_nested_posts_have_their_own_depth_and_fields(spark):
    html = ("<div class='post' id='a'>first outer post text here<div class='post' id='b'><i class='user'>ben</i>inner post text long enough</div></div>"
            "<div class='post' id='c'><i class='user'>cy</i>a later post at the top level</div>")
    rows = {r["raw_id"]: r for r in EX.raw_posts(frame(spark, [(1, "http://x.onion/t", html)])).collect()}
    assert {k: (r["depth"], r["author"]) for k, r in rows.items()} == {"a": (0, "ben"), "b": (1, "ben"), "c": (0, "cy")}
