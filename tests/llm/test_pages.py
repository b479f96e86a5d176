import base64
import hashlib
import html
import math
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from leafloom.llm import html_text, warc

LONG = "This paragraph has enough words to be a part of an article, surely."


@pytest.mark.parametrize(
    "page,want",
    [
        (None, ""),
        ("", ""),
        ("just text", "just text"),
        ("<p>a<p>b &amp; c&nbsp;&#100;", "a b & c d"),
        (f"<nav><a href=x>m</a></nav><div class='ad'>buy</div><article><h1>T</h1><p>{LONG}<p>x<b>y</b>z</article><footer>f</footer>", f"T {LONG} xyz"),
        (f"<header>Site</header><main><header><h1>T</h1></header><p>{LONG}</p></main>", f"T {LONG}"),
        (f"<div><div class='menu'><a href=1>x</a></div><div><p>{LONG}</p><p>{LONG} too</p></div><div id=comments><p>first! {LONG}</p></div></div>", f"{LONG} {LONG} too"),
        (f"<body><article><p>{LONG}</p><form>name <input></form><script>var a='</p>';</script><style>p{{}}</style><!-- no --></article><aside>{LONG}</aside>", LONG),
        (f"<article><p>{LONG}</p><div class='cookie-notice'>ok</div><ul><li>a<li>b</ul></article>", f"{LONG} a b"),
        ("<article><p><b>First.<br><p>Second.</article>", "First. Second."),
        ("<script>never ends", ""),
    ],
)
def test_main_text(page, want):
    assert html_text.extract(page) == want


def test_links_lower_a_block():
    links = "".join(f"<li><a href=/{i}>some link text number {i}</a></li>" for i in range(30))
    body = "".join(f"<p>{LONG} {i}</p>" for i in range(5))
    assert html_text.extract(f"<body><div><ul>{links}</ul></div><div>{body}</div></body>") == " ".join(f"{LONG} {i}" for i in range(5))


@pytest.mark.parametrize(
    "page,want",
    [
        # what only a part of a name hints at stays, unless it is mostly links
        (f'<body><article><p>{LONG}</p><section class="related-work"><h2>Work</h2><p>{LONG} a</p></section><p class="notice-board">{LONG} b</p><section id="search-algorithms"><p>{LONG} c</p></section></article></body>', f"{LONG} Work {LONG} a {LONG} b {LONG} c"),
        (f'<body><article><p>{LONG}</p><div class="related-reading"><a href=1>one more</a> <a href=2>two more</a></div></article></body>', LONG),
        (f'<body><article><p>{LONG}</p><div class="related-posts"><p>{LONG}</p></div><ul class="social-share"><li>{LONG}</ul></article></body>', LONG),
        # without an article element: the core, dense blocks beside it, headings
        (f"<body><div class=site-header>Site</div><div id=page><h1>Title</h1><div class=t><p>{LONG} 1</p><p>{LONG} 2</p><p>{LONG} 3</p></div><p>{LONG} 4</p></div><div id=comment-list><p>{LONG}</p></div><div class=footer>f</div></body>", f"Title {LONG} 1 {LONG} 2 {LONG} 3 {LONG} 4"),
        # a form or a marked wrapper around everything, and readers' words longer than the text
        (f"<body><form><nav><a href=1>menu</a></nav><div><p>{LONG} 1</p><p>{LONG} 2</p></div></form></body>", f"{LONG} 1 {LONG} 2"),
        (f"<body><div class=widget><p>{LONG} 1</p><p>{LONG} 2</p><div class=ad>{LONG}</div></div><p>x</p></body>", f"{LONG} 1 {LONG} 2"),
        (f"<body><article><p>{LONG}</p></article><section class=comments>" + f"<p>{LONG} me too</p>" * 40 + "</section></body>", LONG),
        (f"<body><article><p>{LONG}</p><p hidden>{LONG}</p><p style='display: none'>{LONG}</p></article></body>", LONG),
        (f"<body><main><p>{LONG}</p></main><header>{LONG}</header><aside>{LONG}</aside></body>", LONG),
    ],
)
def test_density_decides(page, want):
    assert html_text.extract(page) == want


def _figures(node):
    """Characters, tags, link characters and link tags of an element by plain recursion."""
    chars = tags = linked = links = 0
    for x in node.parts:
        if isinstance(x, str):
            chars += len(html.unescape(" ".join(x.split())))
        else:
            c, t, lc, lt = _figures(x)
            chars, tags, linked, links = chars + c, tags + t + 1, linked + lc, links + lt + (x.tag == "a")
    return chars, tags, chars if node.tag == "a" else linked, links


def _composite(chars, tags, linked, links, share):
    if chars == 0:
        return 0.0
    log_base = math.log(chars / max(chars - linked, 1) * max(linked, 1) + share * chars + math.e)
    return chars / max(tags, 1) * math.log(max(chars / max(linked, 1) * max(tags, 1) / max(links, 1), 1.0) + 1) / math.log(log_base + 1e-9)


_TREES = st.recursive(
    st.text("ab &", min_size=1, max_size=30).map(lambda x: x.replace("&", "&amp;")),
    lambda kids: st.tuples(st.sampled_from(["div", "section", "span", "a", "b"]), st.lists(kids, max_size=4)).map(lambda x: f"<{x[0]}>{''.join(x[1])}</{x[0]}>"),
    max_leaves=25,
)


@settings(max_examples=150, deadline=None)
@given(st.lists(_TREES, min_size=1, max_size=4))
def test_densities_and_the_core_by_plain_recomputation(parts):
    root = html_text.parse(f"<body>{''.join(parts)}</body>")
    order = html_text._order(root)
    body = next(x for x in order if x.tag == "body")
    html_text.measure(order)
    html_text._densities(order, body)
    _, _, linked, _ = _figures(body)
    share = linked / max(_figures(body)[0], 1)
    for x in order:
        assert (x.chars, x.tags, x.link_chars, x.link_tags) == _figures(x)
        assert math.isclose(x.density, _composite(*_figures(x), share), abs_tol=1e-12)
        assert math.isclose(x.total, sum(_composite(*_figures(k), share) for k in x.parts if not isinstance(k, str)), abs_tol=1e-9)
    chosen = html_text.main_nodes(html_text.parse(f"<body>{''.join(parts)}</body>"))
    inside = [x for x in order if any(y is body for y in html_text._up(x))]
    core = max(inside, key=lambda x: x.total)
    if core.total and core is not body:
        path = [x for x in html_text._up(core) if any(y is body for y in html_text._up(x))]
        assert any((c.tag, c.chars, c.total) == (core.tag, core.chars, core.total) for c in chosen)
        low = min(x.density for x in path)
        beside = [k for x in path if x is not core for k in x.parts if not isinstance(k, str) and not any(k is y for y in path)]
        want = sum(k.tag in ("div", "section") and k.density >= low for k in beside) + 1
        assert len(chosen) == want


def test_deep_and_broken_pages_take_time_in_proportion():
    pages = [
        "<div>" * 20_000 + f"<p>{LONG}</p>" + "</div>" * 20_000,
        "<div>" * 20_000 + f"<p>{LONG}</p>" + "</span></section></b>" * 20_000,
        "<span>" * 20_000 + "<hr>" * 20_000 + f"<p>{LONG}</p>",
        f"<p>{LONG}</p>" + "<svg>" * 20_000,
        "<div class=sidebar>" * 20_000 + f"<p>{LONG}</p>",
    ]
    for page in pages:
        began = time.process_time()
        assert html_text.extract(page).strip() == LONG
        assert time.process_time() - began < 3


def test_all_pages_give_their_articles(spark, sf):
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    for r in html_text.op8_main_text(spark, sf).collect():
        article = re.search(r"<article>(.*?)</article>", pages[r.page_id].html, re.S).group(1)
        want = " ".join(html.unescape(re.sub(r"<(?!/?b>)[^>]*>", " ", article).replace("<b>", "").replace("</b>", "")).split())
        assert r.text == want and r.n_chars == len(want) and r.url == pages[r.page_id].url


def test_odd_pages_in_a_frame(spark):
    long = "<article>" + f"<p>{LONG}</p>" * 20_000 + "</article>"
    df = spark.createDataFrame([(1, None, "old"), (2, "", "old"), (3, long, "old"), (3, long, "old")], "page_id long, html string, text string")
    got = html_text.main_text(df).collect()
    assert [r.text for r in got[:2]] == ["", ""] and len(got[2].text) == 20_000 * (len(LONG) + 1) - 1 and got[2] == got[3]
    assert html_text.main_text(df.limit(0)).collect() == []


PAGE = '<html lang="en"><head><title>A &amp; B</title></head><body><a href="/x">x</a><p>Hello é</p><script>no</script></body></html>'


def test_derivatives_are_linked_and_round_trip(spark):
    pages = spark.createDataFrame([(1, "http://h.org/a", PAGE, "x"), (2, None, None, "x"), (1, "http://h.org/a", PAGE, "x")], "page_id long, url string, html string, record_id string")
    responses = warc.responses(pages)
    by_id = {r.record_id: r for r in responses.collect()}
    derived = warc.derive(responses, ("key",)).collect()
    assert len(derived) == 6 and {r.record_type for r in derived} == {"metadata", "conversion"}
    for r in derived:
        source = by_id[r.refers_to]
        assert (r.target_uri, r.date, r.source_headers, r.source_payload_digest) == (source.target_uri, source.date, source.http_headers, source.payload_digest)
        assert r.block_digest == "sha1:" + base64.b32encode(hashlib.sha1(r.block.encode()).digest()).decode() and r.content_length == len(r.block.encode())
        [(head, block)] = warc.parse_records(warc.serialize(r.asDict()))
        fields = dict(head)
        assert block.decode() == r.block and fields["WARC-Refers-To"] == r.refers_to and fields["WARC-Type"] == r.record_type and fields["WARC-Block-Digest"] == r.block_digest
        assert [v for k, v in head if k == "WARC-Source-Header"] == [x for x in source.http_headers.split("\r\n") if x]
    meta = next(r for r in derived if r.key == "1" and r.record_type == "metadata")
    assert "title: A & B\r\n" in meta.block and "outlink: http://h.org/x L a/@href\r\n" in meta.block and "languages: en" in meta.block
    text = next(r for r in derived if r.key == "1" and r.record_type == "conversion")
    assert text.block == "x\nHello é"
    assert [r.block for r in derived if r.key == "2" and r.record_type == "conversion"] == [""]
    assert warc.derive(responses.limit(0)).collect() == []


def test_files_hold_all_records(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://h.org/{i}", PAGE) for i in range(5)], "page_id long, url string, html string")
    warc.write_files(warc.derive(warc.responses(pages)), str(tmp_path / "w"))
    data = b"".join(bytes(r.member) for r in spark.read.parquet(str(tmp_path / "w")).collect())
    assert len(list(warc.parse_records(data))) == 10


def test_responses_come_back_from_files(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://h.org/{i}", PAGE) for i in range(3)], "page_id long, url string, html string")
    made = warc.responses(pages).drop("key")
    rows = [r.asDict() for r in made.collect()]
    (tmp_path / "a.warc").write_bytes(b"".join(map(warc.serialize_response, rows[:2])))
    (tmp_path / "b.warc.gz").write_bytes(warc.gzip.compress(warc.serialize_response(rows[2])))
    back = warc.read_responses(spark, str(tmp_path))
    assert sorted(map(str, (r.asDict() for r in back.collect()))) == sorted(map(str, rows))
    assert warc.derive(back).count() == 6


def test_wrappers_that_tell_of_furniture_are_no_furniture():
    text = "A long sentence of the article that a reader wants to see. " * 5
    for name in ("content has-sidebar", "no-sidebar", "post with-comments", "without-ads"):
        got = html_text.extract(f'<body><div class="{name}"><p>{text}</p></div><div class="sidebar">Side words</div></body>')
        assert got == text.strip(), name


def test_payloads_are_freed_of_codings_and_read_in_their_charset(spark):
    import gzip
    import zlib

    page = "<title>é</title><p>ä ö</p>"
    raw, packed = page.encode("latin-1"), gzip.compress(page.encode())
    chunks = b"5\r\n" + page.encode()[:5] + b"\r\n" + f"{len(page.encode()) - 5:x}".encode() + b";x\r\n" + page.encode()[5:] + b"\r\n0\r\n\r\n"
    head = lambda *f: "\r\n".join(["HTTP/1.1 200 OK", *f, "", ""])
    rows = [
        ("1", head("Content-Type: text/html; charset=ISO-8859-1"), raw, "iso8859-1"), ("2", head("content-encoding:gzip"), packed, "utf-8"), ("3", head("Transfer-Encoding: chunked"), chunks, "utf-8"),
        ("4", None, b"<meta charset='latin-1'>" + raw, "iso8859-1"), ("5", head("Content-Type: text/html; charset=nonsense"), page.encode(), "utf-8"), ("6", head("Content-Encoding: deflate"), zlib.compress(page.encode()), "utf-8"),
        ("7", head("no colon here", "Content-Encoding: gzip"), page.encode(), "utf-8"),
    ]
    df = spark.createDataFrame([(i, None, None, h, None, bytearray(p)) for i, h, p, _ in rows], warc.RESPONSE)
    got = warc.derive(df).collect()
    for i, _, _, name in rows:
        both = {r.record_type: r for r in got if r.refers_to == i}
        assert both["conversion"].block == "ä ö" and f"charset: {name}\r\n" in both["metadata"].block and "title: é" in both["metadata"].block
        assert (both["conversion"].date, both["conversion"].target_uri) == (None, "")
    nothing = warc.derive(spark.createDataFrame([(None, None, None, None, None, None)], warc.RESPONSE)).collect()
    assert sorted((r.record_type, r.block) for r in nothing)[0] == ("conversion", "") and len({r.record_id for r in nothing}) == 2


def test_an_independent_reading_of_the_conversion(spark, sf):
    """All visible text of the pages, by the standard library's parser."""
    from html.parser import HTMLParser

    class Reading(HTMLParser):
        def __init__(self):
            super().__init__()
            self.out, self.off = [], 0

        def handle_starttag(self, tag, attrs):
            self.off += tag in ("script", "style", "title")
            if tag not in ("a", "b"):
                self.out.append(" ")

        def handle_endtag(self, tag):
            self.off -= tag in ("script", "style", "title")
            if tag not in ("a", "b"):
                self.out.append(" ")

        def handle_data(self, data):
            if not self.off:
                self.out.append(data)

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    for r in warc.op4_warc_derivatives(spark, sf).where("record_type = 'conversion'").collect():
        reading = Reading()
        reading.feed(pages[r.page_id])
        assert r.block.split() == "".join(reading.out).split()


def test_broken_records_are_passed_over(tmp_path, spark):
    good = warc.serialize_response({"http_headers": "HTTP/1.1 200 OK\r\n\r\n", "payload": b"x", "record_id": "a", "target_uri": "u", "date": "d", "payload_digest": "p"})
    loose = good.replace(b"Content-Length: ", b"content-length:").replace(b"WARC-Type: ", b"warc-type:")
    lost = good.replace(b"Content-Length: ", b"X-Length: ")
    assert [len(b) for _, b in warc.parse_records(good + loose + lost + good + good[:60])] == [20, 20, 20]
    (tmp_path / "a.warc").write_bytes(lost + loose)
    (tmp_path / "b.warc").write_bytes(b"no record")
    assert [r.payload for r in warc.read_responses(spark, str(tmp_path)).collect()] == [b"x"]
    with pytest.raises(ValueError):
        list(warc.parse_records(b"no record"))
