"""Chapters' content and table regions against plain walks along their pages."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from leafloom.functions import rules, text
from leafloom.operators import content, regions


@pytest.fixture(scope="module")
def book(spark):
    """Two chapters with every case: trimmed titles, continued paragraphs, regions, images, blanks, a backward range."""
    chapters = [(1, 10, 1, 4, ["Chap One", "Part A"]), (1, 11, 5, 6, ["Chap Two"]), (1, 12, 9, 8, ["None"]), (2, 10, 1, 1, [])]
    p = lambda doc, page, index, said, kind="body", lines=(), merge=False: (doc, page, index, said, kind, list(lines), merge)
    paragraphs = [
        p(1, 1, 0, " Part A  Chap·One "), p(1, 1, 1, "  "), p(1, 1, 2, "Chap One begins here and"),
        p(1, 2, 0, "goes on.", merge=True), p(1, 2, 1, "a | b", "table/form", [1]), p(1, 2, 2, "c | d", "table/form", [2]), p(1, 2, 3, "e | f", "table/form", [9]), p(1, 2, 4, "g | h", "table/form", [4]), p(1, 2, 5, "i | j", "table/form", [9]),
        p(1, 3, 0, "after the picture", merge=True), p(1, 3, 1, "x | y", "table/form", []), p(1, 3, 2, "【기재례】", "heading"), p(1, 3, 3, "1 | 2", "table/form", [7]),
        p(1, 4, 0, "k | l", "table/form"), p(1, 4, 1, "12 | <m>", "table/form"), p(1, 4, 2, "tail", None),
        p(1, 5, 0, "First  Item is named, then Second·Item text; Second Item Long ends"), p(1, 6, 0, "more & more", merge=True), p(2, 1, 0, "alone"),
    ]
    images = [(1, 2, 0, "i2.png"), (1, 4, 0, "i4.png"), (1, 8, 0, "no.png")]
    boxes = [(1, 2, 1, [1, 2], "r2-1.png"), (1, 2, 2, [4], "r2-2.png"), (1, 3, 1, [7, 8], "r3-1.png")]
    items = [(1, 11, 0, "one", "First Item"), (1, 11, 1, "two", "Second Item"), (1, 11, 2, "three", "Second Item Long")]
    f = spark.createDataFrame
    return (
        f(chapters, "doc_id long, chapter long, page_start int, page_end int, titles array<string>"), f(paragraphs, "doc_id long, page int, index int, text string, kind string, lines array<int>, merge_first boolean"),
        f(images, "doc_id long, page int, ord int, path string"), f(boxes, "doc_id long, page int, region int, lines array<int>, path string"), f(items, "doc_id long, chapter long, ord int, section string, title string"),
    )


def rows(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.orderBy("doc_id", "chapter", "pos").collect()]


def test_blocks_of_a_range(book):
    got = rows(content.range_blocks(*book[:4]), "chapter", "type", "text", "kind", "suppressed", "path")
    one = [r[1:] for r in got if r[0] == 10][:-1]
    say = lambda said, kind="body", off=False: ("paragraph", said, kind, off, None)
    show = lambda path, kind="table-image": (kind, None, None, False, path)
    assert one == [
        say("begins here and goes on."), show("r2-1.png"), say("a | b", "table/form", True), say("c | d", "table/form", True), say("e | f", "body", True), show("r2-2.png"), say("g | h", "table/form", True), say("i | j", "body"), show("i2.png", "image"),
        say("after the picture"), show("r3-1.png"), say("x | y", "table/form", True), say("【기재례】", "heading"), say("1 | 2", "table/form", True), say("k | l", "table/form"), say("12 | <m>", "table/form"), say("tail"), show("i4.png", "image"),
    ]
    assert [r[2] for r in got if r[0] == 11] == ["First Item is named, then Second·Item text; Second Item Long ends more & more"]
    assert not [r for r in got if r[0] == 12] and got[-1][2] == "alone"
    assert content.range_blocks(book[0].limit(0), *book[1:4]).collect() == []


def test_sections_by_titles_and_their_rendering(book):
    cut = content.segmented(content.range_blocks(*book[:4]), book[4])
    two = sorted((r.part, r.section, r.text) for r in cut.where("chapter = 11").collect())
    assert two == [(1, "one", "is named, then"), (3, "two", "text;"), (5, "three", "ends more & more")]
    got = {(r.chapter, r.section): r for r in content.rendered(cut, ["doc_id", "chapter", "section"], F.col("section")).where("doc_id = 1").collect()}
    whole = got[10, "overview"]
    table = '<table class="reader-synthetic-table"><thead><tr><th>k</th><th>l</th></tr></thead><tbody><tr><td>12</td><td>&lt;m&gt;</td></tr></tbody></table>'
    assert table in whole.html and '<h4 class="reader-inline-heading">【기재례】</h4>' in whole.html and "<p>a | b</p>" not in whole.html and whole.images == 2
    assert whole.html.count("<figure") == 5 and whole.text.split("\n\n")[1:3] == ["a | b", "c | d"]
    assert got[11, "three"].html == "<p>ends more &amp; more</p>" and got[11, "three"].text == "ends more & more"


def test_rows_of_a_table_run_on_over_suppressed_text(spark):
    rows = [(1, 1, "paragraph", "a | b", "table/form", False), (2, 0, "paragraph", "hidden", "body", True), (3, 0, "paragraph", "c | d", "table/form", False), (4, 0, "paragraph", "alone |", "table/form", False), (5, 0, "paragraph", "e | f", "table/form", False)]
    df = spark.createDataFrame([(7, *r, None) for r in rows], "k int, pos int, part int, type string, text string, kind string, suppressed boolean, path string")
    got = content.rendered(df, ["k"], F.lit("alt")).first()
    assert got.html.count("<table") == 2 and got.html.index("c</th>") < got.html.index("<p>alone |</p>") and got.text.count("\n\n") == 4


def walk_cut(paragraph, titles):
    """Titles found from the left, the longest of those that begin together, word by word."""
    out, at = [], 0
    while at < len(paragraph):
        best = None
        for t in titles:
            m = re.compile(r"[\s·ㆍ․]*".join(re.escape(w) for w in t.split(" "))).search(paragraph, at)
            if m and (best is None or (m.start(), -len(t)) < (best[0].start(), -len(best[1]))):
                best = (m, t)
        if best is None:
            break
        out += [(None, paragraph[at : best[0].start()].strip()), (best[1], None)]
        at = best[0].end()
    out.append((None, paragraph[at:].strip()))
    return [x for x in out if x[0] or x[1]]


def test_cutting_at_titles_by_a_walk(spark):
    rng = np.random.default_rng(2)
    words = ["ab", "a", "b", "ba", "제1절"]
    cases = []
    for _ in range(80):
        sep = [" ", "  ", "·", " ㆍ "]
        cases.append(("".join(words[rng.integers(5)] + sep[rng.integers(4)] for _ in range(12)), [" ".join(words[rng.integers(5)] for _ in range(int(rng.integers(1, 3)))) for _ in range(3)]))
    cases += [("", ["a"]), ("   ", ["a"]), (None, ["a"]), ("text", None), ("text", [])]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, p string, t array<string>")
    got = {r.i: [(x.heading, x.text) for x in r.c] for r in df.select("i", content.cut_at_titles(F.col("p"), F.col("t")).alias("c")).collect()}
    for i, (p, t) in enumerate(cases):
        want = walk_cut(p or "", list(dict.fromkeys(t or [])))
        assert got[i] == want, cases[i]


def test_chapters_and_entries(spark):
    f = spark.createDataFrame
    none = None
    chapters = f([(1, "p1", "부 록", 1, "1", "9", 1, "c-one", "Chap One", 2, 4, "2", "4"), (1, "p1", "부 록", 1, "1", "9", 2, "c-two", "Chap Two", 5, 6, none, none), (1, "p2", "제1편", 7, none, none, 3, "c-three", "Chap Three", 7, 7, none, none)], "doc_id long, part string, part_title string, part_start int, part_label string, part_label_end string, chapter long, slug string, title string, page_start int, page_end int, label_start string, label_end string")
    items = f([(1, 1, 0, "item", "절차 Item", 3, 4, "3", "4")], "doc_id long, chapter long, ord int, section string, title string, page_start int, page_end int, label_start string, label_end string")
    paragraphs = f([(1, 2, 0, "Chap One 특 허 overview text.", "body", [], False), (1, 3, 0, "절차 Item what it says", "body", [], False)], "doc_id long, page int, index int, text string, kind string, lines array<int>, merge_first boolean")
    images = f([(1, 4, 0, "x.png")], "doc_id long, page int, ord int, path string")
    boxes = f([], "doc_id long, page int, region int, lines array<int>, path string")
    pages, entries = content.built(chapters, items, paragraphs, images, boxes)
    got = {r.id: r for r in entries.collect()}
    assert set(got) == {"c-one-part-intro", "c-one-part-intro-alias-revision-history", "c-one-overview", "item", "c-two-overview", "c-three-overview"}
    intro = got["c-one-part-intro"]
    assert intro.text == f"{rules.INTRO_SENTENCE} Chap One (p.2) / Chap Two (PDF 5)" and (intro.page_start, intro.page_end, intro.label_start) == (1, 1, "1")
    assert got["c-one-overview"].text == "특허 overview text." and got["c-one-overview"].page_end == 2
    assert got["item"].text == "what it says" and got["item"].categories == ["procedure", "appendix"] and got["item"].images == 1
    alias = got["c-one-part-intro-alias-revision-history"]
    assert alias.section_title == "개정 연혁" and alias.section == "part-intro" and alias.categories == ["appendix"] and alias.text.startswith("부 록 개정 연혁 개정내용 ")
    by = {r.slug: r for r in pages.collect()}
    assert by["c-one"].html.startswith('<section id="overview"><h2>Chap One</h2><p>특 허 overview text.</p></section><section id="part-intro"><h3>부 록</h3>')
    assert '<section id="item"><h3>절차 Item</h3><p>what it says</p><figure' in by["c-one"].html and by["c-one"].images == 1 and by["c-one"].headings == 1
    assert by["c-two"].html == '<section id="overview"><h2>Chap Two</h2></section>' and by["c-two"].summary == "Chap Two" and by["c-two"].headings == 0
    assert by["c-one"].summary.startswith("부 록 개정 연혁")
    assert [r.id for r in content.exploration(entries).collect()] == ["item"]


LINE = "doc int, page int, index int, left double, top double, right double, bottom double, text string"


def line(i, left, top, right, said="cell", height=11):
    return {"index": i, "left": float(left), "top": float(top), "right": float(right), "bottom": float(top + height), "text": said}


def grid(n, top=100, gap=16, start=0, lefts=(70, 200, 330)):
    return [line(start + 10 * r + k, x, top + r * gap, x + 80) for r in range(n) for k, x in enumerate(lefts)]


def test_bands_and_columns():
    got = regions.bands([line(1, 200, 100, 250), line(0, 70, 102, 120), line(2, 70, 114, 120), line(3, 80, 140, 90), line(4, 95, 140, 99)])
    assert [sorted(b.numbers) for b in got] == [[0, 1, 2], [3, 4]] and [b.columns for b in got] == [2, 1]


@pytest.mark.parametrize(
    "left,right,said,want",
    [
        (100, 300, "x" * 60, True), (60, 300, "x" * 60, False), (100, 420, "x" * 60, False), (10, 100, "short", True), (10, 300, "x" * 60, False), (400, 529, "x", False), (300, 518, "x" * 90, True), (70, 510, "x" * 200, False), (200, 370, "middle", True),
    ],
)
def test_continuations(left, right, said, want):
    [band] = regions.bands([line(0, left, 100, right, said)])
    assert regions.continues(band, 70, 510) is want
    two = regions.bands([line(0, 80, 100, 120), line(1, 300, 100, 340)])[0]
    assert not regions.continues(two, 70, 510)


def test_a_form_is_one_region_with_its_title_and_tail():
    form = grid(5) + [line(90, 150, 182, 250, "one row"), *grid(1, 200, start=200), line(1, 180, 70, 300, "Title"), line(91, 75, 240, 150, "signed"), line(92, 75, 400, 150, "far")]
    [got] = regions.page_regions(form, 595)
    assert 1 in got["lines"] and 90 in got["lines"] and 91 in got["lines"] and 92 not in got["lines"]
    assert (got["left"], got["top"], got["right"], got["bottom"]) == (58.0, 58.0, 422.0, 263.0)


def test_chains_captions_and_tails():
    page = [line(500, 90, 80, 180, "【표】"), *grid(2), line(501, 300, 134, 400, "x" * 80), line(502, 70, 300, 520, "prose " * 30), *grid(1, 400, start=300)]
    a, b = regions.page_regions(page, 400)
    assert a["lines"] == [0, 1, 2, 10, 11, 12, 500, 501] and b["lines"] == [300, 301, 302] and (a["region"], b["region"]) == (1, 2)
    assert a["right"] == 400.0 and b["top"] == 388.0
    assert regions.page_regions([line(0, 70, 100, 500)], 595) == [] and regions.page_regions([], 595) == []


def test_regions_of_frames(spark):
    df = spark.createDataFrame([(1, p, *(x[c] for c in ("index", "left", "top", "right", "bottom")), None if x["index"] == 1 else x["text"]) for p in (1, 2) for x in grid(2)] + [(1, 3, 0, 70.0, 100.0, 90.0, 110.0, "x")], LINE)
    got = regions.table_regions(df, ["doc", "page"]).orderBy("page").collect()
    assert [(r.page, r.region, r.lines) for r in got] == [(1, 1, [0, 1, 2, 10, 11, 12]), (2, 1, [0, 1, 2, 10, 11, 12])]
    assert regions.table_regions(df.limit(0), ["doc", "page"]).collect() == []
    assert spark.range(1).select(regions.crop_path(F.lit(12345), F.lit(2)).alias("p")).first().p == "images/table-crops/12345-2.png"


def test_repairs_settle_whatever_their_number(spark):
    chain = (("a b", "b"), ("b c", "c"), ("c a", "a"))
    said = " ".join(["a"] + list("bca") * 40)
    got = spark.range(1).select(text.repair(F.lit(said), chain).alias("x"), text.repair(F.lit(None).cast("string"), chain).alias("n"), text.repair(F.lit("특 허 심 판 원"), rules.REPAIRS).alias("k")).first()
    want = said
    while (now := want.replace("a b", "b").replace("b c", "c").replace("c a", "a")) != want:
        want = now
    assert got.x == want and got.n is None and got.k == text.repaired("특 허 심 판 원") == "특허심판원"


def test_rounding_passes_what_is_no_small_number(spark):
    odd = [float("nan"), float("inf"), -float("inf"), 1e18, -(2.0**53), 0.25, None]
    got = [r.r for r in spark.createDataFrame([(i, x) for i, x in enumerate(odd)], "i int, x double").orderBy("i").select(text.python_round(F.col("x")).alias("r")).collect()]
    assert np.isnan(got[0]) and got[1:5] == odd[1:5] and got[5] == 0.2 and got[6] is None


def test_titles_are_found_without_a_pattern_for_each(monkeypatch):
    made, compiled = [], re._compiler.compile
    monkeypatch.setattr(re._compiler, "compile", lambda p, *a, **k: made.append(p) or compiled(p, *a, **k))
    for n in range(600):
        titles = [f"first {n}", f"first {n} longer", None]
        assert text._trim_headings(f" ·first{n} first ㆍ {n}·longer\nfirst {n}th", titles) == f"first {n}th"
        assert [x["heading"] or x["text"] for x in content._cut(f"first {n} first  {n}·longer the first", titles)] == [f"first {n}", f"first {n} longer", "the first"]
    assert len(made) <= 1  # the one that takes separators out


def test_titles_with_blank_words_or_separators_are_cut_at(spark):
    df = spark.createDataFrame([("x a··b y a  b", ["a ·b", "a  b"])], "p string, t array<string>")
    assert [(r.heading, r.text) for r in df.select(content.cut_at_titles(F.col("p"), F.col("t")).alias("c")).first().c] == [(None, "x"), ("a ·b", None), (None, "y"), ("a  b", None)]


def test_first_words(spark):
    said = ["", " \0 ", "one", " a\0\0b c  d", "a b c", None]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(said)], "i int, x string").orderBy("i")
    assert [r.w for r in df.select(text.first_words(F.col("x"), 3).alias("w")).collect()] == ["", "", "one", "a b c", "a b c", None]


def test_chapters_are_read_once_and_entries_when_asked_for(spark, sf, monkeypatch):
    from leafloom.plans import manual

    made, written = [], content.O.written
    monkeypatch.setattr(content.O, "written", lambda df: made.append(df.columns) or written(df))
    m = manual.books(spark, sf)
    pages, entries = content.built(m["chapters"], m["items"], m["paragraphs"], m["images"], m["regions"])
    assert len(made) == 3 and not any("excerpt" in c for c in made)
    assert "documents.parquet" not in entries._jdf.queryExecution().optimizedPlan().toString() and entries.count() > 0


def test_rules_are_tried_only_where_one_can_begin(spark):
    assert [text._head(p) for p in (r"이\s+에(?=\s+(?:대|따))", "a(b)|c", "(a)", "a?b", r"a\(|b", "ab|c", "", "a+b")] == ["이", None, None, None, None, None, None, "a"]
    df = spark.createDataFrame([(0, "특 허 plain"), (1, "plain words"), (2, None), (3, "행정 심 판")], "i int, x string").orderBy("i")
    assert [r.x for r in df.select(text.repair(F.col("x")).alias("x")).collect()] == ["특허 plain", "plain words", None, "행정심판"]
    assert "[국-행]" in df.select(text.repair(F.col("x")).alias("x"))._jdf.queryExecution().analyzed().toString()


def test_search_texts_are_made_once_a_row(spark, sf):
    from leafloom.plans import manual

    m = manual.books(spark, sf)
    pages, entries = content.built(m["chapters"], m["items"], m["paragraphs"], m["images"], m["regions"])
    for df in (pages, entries):
        plan = df._jdf.queryExecution().optimizedPlan().toString().split("\n")
        assert max(line.count("[국-행]") for line in plan) == 1


def test_lines_of_books_are_placed_without_a_shuffle(spark):
    from leafloom.plans import manual

    said = "\n".join(f"line {i}{'.' if i % 2 else ''}" for i in range(50))
    docs = spark.createDataFrame([(21, said, "s", "en"), (22, None, "s", "en")], "doc_id long, text string, source string, lang string")
    import tempfile

    folder = tempfile.mkdtemp()
    docs.write.parquet(f"{folder}/documents.parquet")
    paragraphs = manual.books(spark, folder)["paragraphs"]
    plan = paragraphs._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan
    got = sorted(tuple(r) for r in paragraphs.where("page < 26").select("page", "index", "text", "lines", "merge_first").collect())
    assert len(got) == 50 and got[0] == (14, 0, "line 0", [0], False) and got[4] == (15, 0, "line 4", [4], False) and got[-1] == (23, 13, "line 49.", [49], False)
    assert [tuple(r)[:2] for r in paragraphs.where("page >= 26").select("page", "index").collect()] == [(26, 0)]
