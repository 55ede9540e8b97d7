"""WARC archives and main text extraction on small page tables."""

import hashlib
import io
import json
import random
import time
import zlib
from collections import Counter

import pytest

from bibflow.llm import html_wrappers, warc

PAGES = "page_id bigint, url string, html string, payload string, last boolean"


@pytest.fixture(scope="module")
def page_rows():
    big = "é<p>" + "0123456789\r\n\r\nWARC/1.1\r\n" * 20000
    same = "<p>copy " + "x" * 2000
    rows = [(1, "http://a.example/%41\n?x", same), (5, None, same), (3, "http://b.example/", same), (3, "http://b.example/", same),
            (7, "http://c.example/", "short"), (8, "http://c.example/", "short"), (9, "", None), (10, "u", ""), (None, "u", big),
            (12, "http://d.example/", big), (None, None, None), (13, "http://d.example/", big + "!")]
    return [(*r, "clash", True) for r in rows]


def test_archives_round_trip(spark, page_rows):
    pages = spark.createDataFrame(page_rows, PAGES).repartition(3)
    manifest = warc.write_archives(warc.classify(pages))
    chunks = warc.read_archives(manifest)
    rows = chunks.orderBy("record_id", "chunk_no").collect()
    top = {}
    for r in page_rows:
        if r[0] is not None:
            top[r[2]] = max(top.get(r[2], r[0]), r[0])
    want = Counter()
    for r in page_rows:
        data = (r[2] or "").encode()
        refers = top.get(r[2]) if len(data) >= 1000 and sum(x[2] == r[2] for x in page_rows) > 1 else None
        refers = None if refers == r[0] else refers
        url = r[1] and r[1].replace("\n", "%0A")  # a header holds no line end; all else is as it was
        want[r[0], url, len(data), hashlib.sha1(data).hexdigest(), "response" if refers is None else "revisit", refers] += 1
    got = Counter((r["page_id"], r["url"], r["payload_bytes"], r["sha1_so_far"], r["record_type"], r["refers_to"]) for r in rows if r["last"])
    assert got == want
    assert len({(r["record_id"], r["chunk_no"]) for r in rows}) == len(rows)
    assert len({r["record_id"] for r in rows}) == len(page_rows)  # repeated rows are records of their own
    # The chunks of a stored payload, in order, are the payload; each carries the digest so far.
    big = next(r[2] for r in page_rows if r[0] == 13).encode()
    parts = [r for r in rows if r["page_id"] == 13]
    assert b"".join(bytes(r["data"]) for r in parts) == big and max(len(r["data"]) for r in parts) <= warc.CHUNK and len(parts) > 3
    seen = hashlib.sha1()
    for r in parts:
        seen.update(bytes(r["data"]))
        assert r["sha1_so_far"] == seen.hexdigest()
    assert manifest.agg({"records": "sum"}).first()[0] == len(page_rows)


def test_archives_of_an_empty_table(spark):
    manifest = warc.write_archives(warc.classify(spark.createDataFrame([], PAGES)))
    assert manifest.count() == 0 and warc.read_archives(manifest).count() == 0


def test_damaged_payload_is_an_error():
    body = b"y" * 3000
    head = warc.header(1, "u", hashlib.sha1(body).hexdigest(), len(body), None)
    pack = lambda b: (lambda c: c.compress(b) + c.flush())(zlib.compressobj(1, wbits=31))
    good = pack(head + body + b"\r\n\r\n")
    assert [r[1:3] + r[7:10] for r in warc.read_records(io.BytesIO(good + good))] == [
        (0, 1, 3000, hashlib.sha1(body).hexdigest(), True)] * 2
    with pytest.raises(ValueError):
        list(warc.read_records(io.BytesIO(pack(head + b"z" * 3000 + b"\r\n\r\n"))))
    with pytest.raises(ValueError):
        list(warc.read_records(io.BytesIO(good[:-20])))


# ---- main text ----

def page(title, paragraphs, menu=3, article=True, extra=""):
    items = "".join(f'<li><a href="/{k}">Item {k}</a></li>' for k in range(menu))
    body = f"<h1>{title}</h1>" + "".join(f"<p>{p}</p>" for p in paragraphs)
    box = "<article>{}{}</article>" if article else '<div id="content">{}{}</div>'
    return (f"<!DOCTYPE html><html><head><title>{title} | site</title><style>p{{x:1}}</style><script>var t='</p><p>no';</script></head>"
            f"<body class='page'><header><p>Site name</p></header><nav><ul>{items}</ul></nav><!-- <p>hidden</p> -->"
            f'<div class="cookie-notice"><p>We use cookies</p></div>' + box.format(body, extra) +
            '<aside><p>Side</p></aside><form><p>Search</p><input name=q></form><section id="comments"><p>Reader says hi</p></section>'
            "<footer><p>&copy; 2020</p></footer></body></html>")


def test_extraction(spark):
    rng = random.Random(1)
    say = lambda: " ".join("".join(rng.choices("abcdefg", k=5)) for _ in range(rng.randint(4, 30)))
    rows, want = [], {}
    for k in range(40):
        title, paragraphs = say(), [say() for _ in range(rng.randint(1, 6))]
        host = ["h1.example", "h2.example"][k % 2]
        extra = '<div class="share"><p>Share this</p></div><h4>Read on tomorrow</h4>' if host == "h2.example" else ""
        rows.append((k, f"http://{host}/p/{k}", page(title, paragraphs, menu=k % 5, article=k % 10 != 0, extra=extra)))
        want[k] = "\n\n".join([title, *paragraphs, *(["Read on tomorrow"] if extra else [])])  # the article loses nothing else
    rows += [(100, "http://h1.example/x", None), (101, "http://h1.example/y", ""), (102, None, "<p>a &lt;b&gt;&nbsp;&amp;  c<br>d<p><b>e</b>f"),
             (103, "no host", "<div>x<script>if (a<b) '<p>'</script> y</div><<p>z"), (104, "http://h3.example/", "text only " * 3000),
             (105, "http://h1.example/deep", "<div>" * 300 + "deep" + "</div>" * 300)]
    out = {r["page_id"]: r for r in html_wrappers.main_texts(spark.createDataFrame(
        [(*r, "clash") for r in rows], "page_id bigint, url string, html string, hx_text string").repartition(4)).select(
        "page_id", "hx_text_", "hx_chars").collect()}
    # Outside the main text a slot whose string never differs is part of the template.
    assert {k: out[k]["hx_text_"] for k in want} == want
    assert out[100]["hx_text_"] == out[101]["hx_text_"] == ""
    assert out[102]["hx_text_"] == "a <b> & c d\n\nef"
    assert out[103]["hx_text_"] == "x y\n\n<\n\nz"
    assert out[104]["hx_text_"] == ("text only " * 3000).strip() and out[104]["hx_chars"] == len(out[104]["hx_text_"])
    assert out[105]["hx_text_"] == "deep"
    empty = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert html_wrappers.main_texts(empty).count() == 0


def test_wrapper_is_a_union_free_expression():
    a, _ = html_wrappers.page_wrapper("<body><h1>A</h1><p>x</p><p>y</p><footer>same</footer></body>")
    b, _ = html_wrappers.page_wrapper("<body><h1>B</h1><p>z</p><div class=ad>q</div><footer>same</footer></body>")
    c, _ = html_wrappers.page_wrapper("<body><p>z</p><h1>C</h1><p>w</p></body>")
    ab = html_wrappers.align(a, b)
    assert html_wrappers.expression(ab) == '<body><h1>#</h1>(<p>#</p>)+(<div.ad>"..."</div>)?<footer>"..."</footer></body>'
    assert html_wrappers.expression(html_wrappers.align(a, a)) == html_wrappers.expression(a).replace("#", '"..."')
    mixed = html_wrappers.expression(html_wrappers.align(ab, c))
    assert mixed.startswith("<body>((") and mixed.endswith(")+</body>") and "|" not in mixed
    # Merging is independent of grouping in what it keeps.
    left = html_wrappers.align(html_wrappers.align(a, b), c)
    right = html_wrappers.align(a, html_wrappers.align(b, c))
    assert sorted(html_wrappers.slots_of(left)) == sorted(html_wrappers.slots_of(right))
    assert json.loads(json.dumps(left)) == left


def test_copies_of_a_page_are_no_evidence(spark):
    copy = "<body><h1>Copied</h1><p>The only text of this page</p><blockquote>Quoted</blockquote><p>It ends here</p></body>"
    rows = [(k, "http://copies.example/", copy) for k in range(40)]
    rows += [(100 + k, "http://mixed.example/", copy) for k in range(40)]
    rows += [(200 + k, "http://mixed.example/", f"<body><h1>Title {k}</h1><p>Words of page {k} and more</p><h5>Printed by us</h5></body>")
             for k in range(40)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    whole = "Copied\n\nThe only text of this page\n\nQuoted\n\nIt ends here"
    want = {k: whole for k in (*range(40), *range(100, 140))} | {200 + k: f"Title {k}\n\nWords of page {k} and more" for k in range(40)}
    for parts in (1, 8):
        out = html_wrappers.main_texts(pages.repartition(parts)).collect()
        assert {r["page_id"]: r["hx_text"] for r in out} == want


def test_names_do_not_lose_the_text(spark):
    rows, want = [], {}

    def add(host, k, html, text):
        rows.append((len(rows), f"http://{host}.example/{k}", f"<html>{html}</html>"))
        want[len(rows) - 1] = text
    for k in range(8):
        text = f"Words of page {k} that nobody else has"
        add("compound", k, f"<body class='single-post'><div class='content no-sidebar'><p>{text}</p></div></body>", text)
        add("date", k, f"<body><div class='post-date'>{k} May</div><div><p>{text}</p></div></body>", f"{k} May\n\n{text}")
        add("teaser", k, f"<body><div class='post'>No {k}</div><div><p>{text * 9}</p></div></body>", f"No {k}\n\n{text * 9}")
        add("form", k, f"<body><form id='aspnetForm'><nav><p>Menu {k}</p></nav><p>{text}</p></form></body>", text)
        add("wrap", k, f"<body><div class='widget'><p>{text}</p></div><div class='ad'>Ad {k}</div></body>", text)
        # A fixed string among the strings of a repeated slot: in the article it stays, in a bare body it goes.
        add("repeat", k, f"<body><article><h2>Summary</h2><p>{text}</p><p>Yes.</p></article></body>", f"Summary\n\n{text}\n\nYes.")
        add("bare", k, f"<body><p>{text}</p><p>More {k}</p><p>Subscribe to our letter</p></body>", f"{text}\n\nMore {k}")
        add("links", k, f"<body><div><p>Top</p></div><div class='main-column'><h2>Summary</h2><p>{text}</p><ul><li><a href=/{k}>See {k}</a></li>"
            "</ul></div><p>All rights reserved</p></body>", f"Summary\n\n{text}\n\nSee {k}")
        add("open", k, f"<body><article><object><p>{text}</p><math><mi>x</mi><mo>=</mo><mn>{k}</mn></math></article></body>", f"{text}\n\nx={k}")
    out = html_wrappers.main_texts(spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(4)).collect()
    assert {r["page_id"]: r["hx_text"] for r in out} == want


PARTS = ["comment-list", "comments-area", "reader-comments", "related-posts", "cookie-banner", "ad-slot", "site-footer", "site-nav",
         "main-menu", "sidebar-left", "newsletter-signup", "notice-bar", "share-buttons", "left-sidebar", "top_banner", "login-form", "site-header"]


@pytest.mark.parametrize("pages", [1, 3, 50])
def test_varied_hosts_against_known_text(pages):
    """Hosts with and without article, repeated headings, parts under compound names with text of their own."""
    rng = random.Random(pages)
    say = lambda n: " ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(n))
    for host in range(30):
        box = rng.choice([("<article>", "</article>"), ("<div class='content no-sidebar'>", "</div>"), ("<main>", "</main>"),
                          ("<section id='text-column'>", "</section>")])
        before, after = rng.sample(PARTS, 3), rng.sample(PARTS, 3)
        made = []
        for k in range(pages):
            blocks = ["Summary", *(say(rng.randint(20, 60)) for _ in range(rng.randint(2, 5))), "Outlook", say(25)]
            inside = "".join(f"<h2>{b}</h2>" if b in ("Summary", "Outlook") else f"<p>{b}</p>" for b in blocks)
            part = lambda name: f"<div class='{name}'><p>{say(4)}</p></div>"
            made.append(("<html><body>" + "".join(map(part, before)) + box[0] + inside + box[1] + "".join(map(part, after)) + "</body></html>",
                         "\n\n".join(blocks)))
        wrapper = None
        for source, _ in made:
            own, _ = html_wrappers.page_wrapper(source)
            wrapper = own if wrapper is None else html_wrappers.align(wrapper, own)
        kept = html_wrappers.kept_slots(wrapper)
        for source, text in made:
            assert html_wrappers.main_text(source, kept) == text


@pytest.mark.parametrize("source, text", [
    ("<div>" * 20_000 + "deep", "deep"), ("<ul><li>" * 10_000 + "deep" + "</ul>" * 10_000 + "<p>end", "deep\n\nend"),
    ("<p>x</p>" + "<a '" * 250_000, None), ("<p>x</p>" + '<a b="' * 170_000, None), ("<p>x</p>" + "<a b='\"" * 150_000, None),
    ("<p>x</p>" + "<!" * 500_000, None), ("<p>x</p>" + "<object>" * 125_000 + "y", "x\n\ny"), ("<p>x</p><!--" + "<!--" * 250_000, "x")])
def test_hostile_pages_take_one_pass(source, text):
    began = time.process_time()
    wrapper, _ = html_wrappers.page_wrapper(source)
    wrapper = json.loads(json.dumps(html_wrappers.align(wrapper, wrapper)))
    got = html_wrappers.main_text(source, html_wrappers.kept_slots(wrapper))
    assert got.startswith("x") if text is None else got == text
    assert html_wrappers.expression(wrapper)
    assert time.process_time() - began < 5
