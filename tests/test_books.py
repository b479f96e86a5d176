"""Contents tables, the reader's side, export and the audit bundle on worked rows."""

import pytest
from pyspark.sql import functions as F

from leafloom.functions import rules
from leafloom.operators import bundle, export, images, reader, toc
from leafloom.sources import sinks, tables


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_contents_of_an_outline(spark):
    outline = [(1, 1, 1, "일러두기", 3, None), (1, 2, 2, "제1편 총칙", 13, "1"), (1, 3, 3, "제1장 목적", 13, "1"), (1, 4, 4, "제1절 범위", 14, None), (1, 5, 4, "제1절 범위", 15, None), (1, 6, 2, "제14-1편 총칙", 17, None), (1, 7, 3, "제1장 목적", 17, None), (1, 8, 1, "심판편람편찬위원", 19, None), (1, 9, 4, "orphan", 19, None)]
    pages = [(1, p, {13: "1", 14: "2", 15: "3"}.get(p), "frontmatter" if p < 13 else "body", "목 차" if p == 11 else "text") for p in range(1, 21)] + [(2, 1, None, "body", None)]
    chapters, items, counts = toc.built(spark.createDataFrame(outline, "doc_id long, index int, level int, title string, page_start int, label_start string"), spark.createDataFrame(pages, "doc_id long, page int, page_label string, page_kind string, text string"))
    got = [(r.part_title, r.slug, r.label, r.page_start, r.page_end, r.label_end) for r in chapters.where("doc_id = 1").orderBy("part_ord", "ord").collect()]
    assert got == [
        ("전면부", "cover-and-masthead", "전면부", 1, 4, None), ("전면부", "front-notes", "일러두기", 3, 10, "3"), ("후면부", "editorial-board", "편찬위원", 19, 20, None),
        ("제1편 총칙", "제1장-목적", "제1장", 13, 16, "3"), ("제14-1편 총칙", "제1장-목적-2", "제1장", 17, 18, None),
    ]
    assert [(r.chapter, r.section, r.page_start, r.page_end, r.label_end) for r in items.orderBy("page_start").collect()] == [("제1장-목적", "제1절-범위", 14, 14, "2"), ("제1장-목적", "제1절-범위-2", 15, 16, "3")]
    assert [(r.doc_id, r.parts, r.chapters, r.items, r.contents_pages) for r in counts.orderBy("doc_id").collect()] == [(1, 4, 5, 2, 2), (2, 1, 1, 0, 0)]
    assert [r.part_end for r in chapters.where("doc_id = 1 and part_ord = 0").collect()] == [10, 10]
    assert one(spark, toc.opens_contents(F.lit(" 목  차 "))) and not one(spark, toc.opens_contents(F.lit("the 목차")))


def test_reader_html_and_introductions(spark):
    lead = lambda body, title="T x": f"<section id='a'><h2>{title}</h2> <p>{body}</p><p>T x stays</p></section>"
    cases = [("T x text", "text"), ("part one T x text", "text"), ("see. T x text", "see. T x text"), ("T xtext", "T xtext"), ("a" * 81 + " T x text", "a" * 81 + " T x text"), ("no heading", "no heading")]
    for given, want in cases:
        assert one(spark, reader.ready_html(F.lit(lead(given)))) == lead(want), given
    assert one(spark, reader.ready_html(F.lit('<table class="x"><tr></table>'))) == '<div class="reader-table-scroll"><table class="x"><tr></table></div>'
    assert one(spark, reader.ready_html(F.lit(""))) == "" and one(spark, reader.ready_html(F.lit(None).cast("string"))) is None
    for given, described, items in ((f" {rules.INTRO_SENTENCE} a (p.1) / b ", rules.INTRO_SENTENCE, ["a (p.1)", "b"]), ("other / text", "other / text", []), ("", "", [])):
        a, b = reader.parsed_intro(F.lit(given))
        assert (one(spark, a), one(spark, b)) == (described, items)
    page = '<h2>x</h2><section id="part-intro">\n1</section><section id="part-intro">2</section>'
    assert one(spark, reader.without_intro(F.lit(page))) == '<h2>x</h2><section id="part-intro">2</section>'
    assert [one(spark, reader.date_label(F.lit(x).cast("string"))) for x in (None, "", "soon", "2026-04-18T00:05:00Z", "2026-04-18T13:30:00Z")] == ["미상", "미상", "soon", "2026. 4. 18. 오전 12:05", "2026. 4. 18. 오후 1:30"]


def test_catalogs_and_found_entries(spark):
    entry = "chapter string, section string, entry_type string, section_title string, chapter_title string, part_title string, text string, page_start int, page_end int, label string, images long, ord int"
    entries = spark.createDataFrame([("a", "s2", "item", "Two", "A", "P", "", 5, 6, "5", 2, 1), ("a", "s1", "item", "One", "A", "P", "", 3, 4, "3", 0, 2), ("a", "part-intro", "part-intro", "P", "A", "P", "", 9, 9, None, 0, 3), ("a", "x", "search-alias", "Alias", "A", "P", "", 1, 1, None, 0, 4), ("b", "overview", "overview", "개요", "B", "P", "", 7, 7, None, 0, 5), ("gone", "s", "item", "S", "G", "P", "", 1, 1, None, 0, 6), ("a", "s3", "item", "One", "A", "P", "", 8, 8, "8", 7, 7)], entry)
    chapters = spark.createDataFrame([("a", "A", "P", "sum", "3", 3, 1), ("b", "B", "P", "sum", None, 7, 0)], "chapter string, title string, part_title string, summary string, label_start string, page_start int, images long")
    got = reader.catalog(chapters, entries).orderBy("chapter", "place").collect()
    assert [(r.chapter, r.section, r.route) for r in got] == [("a", "part-intro", "#/chapter/a/part-intro"), ("a", "overview", "#/chapter/a"), ("a", "s1", "#/chapter/a/s1"), ("a", "s2", "#/chapter/a/s2"), ("a", "s3", "#/chapter/a/s3"), ("b", "overview", "#/chapter/b")]
    found = spark.createDataFrame([(1, "P", "A", "3", 3, 4, "o·ne", True), (2, "p", "a", None, 0, 0, "One", True), (3, "P", "B", None, 0, 0, "nothing", True), (4, "Q", "C", None, 0, 0, "x", False), (5, None, None, None, None, None, None, None)], "id int, part_title string, chapter_title string, label string, page_start int, page_end int, title string, has_image boolean")
    owners = spark.createDataFrame([("a", "P", "A", "3", 1), ("b", "P", "B", None, 2)], "chapter string, part_title string, chapter_title string, label string, ord int")
    out = reader.resolved(found, entries.withColumn("title", F.col("section_title")), owners).orderBy("id").collect()
    assert [(r.chapter, r.section, r.route, r.images) for r in out] == [("a", "s1", "#/chapter/a/s1", 0), ("a", "s3", "#/chapter/a/s3", 7), ("b", "overview", "#/chapter/b", 1), (None, "overview", "/", 0), (None, "overview", "/", 0)]


CHAPTER = "doc_id long, ord int, slug string, title string, part_title string, page_start int, page_end int, label_start string, label_end string, html string, headings array<struct<id:string,title:string>>"


def test_markdown(spark):
    page = '<h1>no</h1><h2>T , it</h2><h3>특 허 &amp; more</h3><p>Text <b>bold</b><p>two<h4>deep</h4><table><td>cell</td></table><img src="x"><img alt="a &lt; b"/><h2>Other</h2>'
    assert one(spark, export.markdown(F.lit(page), F.lit("T, it"), 2)) == "### 특허 & more\n\nText bold\n\ntwo\n\n#### deep\n\n[이미지 생략: 이미지]\n\n[이미지 생략: a < b]\n\n## Other"
    assert one(spark, export.markdown(F.lit(None).cast("string"), F.lit("T"))) is None and one(spark, export.markdown(F.lit(""), F.lit("T"))) == ""
    assert [tuple(x) for x in one(spark, export.split_sections(F.lit('a<section id="x">1\n2</section>b<section  id="y"></section>')))] == [("x", "1\n2"), ("y", "")]
    assert [tuple(x) for x in one(spark, export.split_sections(F.lit("plain")))] == [(None, "plain")]
    assert one(spark, export.numbered(F.lit(1000), 3, F.lit("s"))) == "1000__s.md" and one(spark, export.numbered(F.lit(7), 3, F.lit("s"))) == "007__s.md"


def test_export(spark):
    section = '<section id="overview"><h2>{t}</h2><p>body</p></section><section id="part-intro"><p>intro</p></section><section id="s1"><h3>One</h3><p>kept</p></section><section id="s2"><h3>Two</h3><p>risky</p></section>'
    heads = [("s1", "One"), ("s2", "Two")]
    chapters = [
        (1, 0, "front-preface", "머리말", "전면부", 1, 1, None, None, "<p>words</p>", []), (1, 1, "c1", "장 하나", "제1편", 5, 9, "1", "5", section.format(t="장 하나"), heads), (1, 2, "c2", "장 둘", "제1편", 10, 11, None, None, "<p>x</p>", []),
        (1, 3, "app", "부록 장", "부 록", 20, 30, None, None, "<p>x</p>", []), (1, 4, "editorial-board", "편찬", "후면부", 31, 31, None, None, "", []),
    ]
    queue = [(1, "front-preface", "overview", 1, None, ["low-confidence"]), (1, "c1", "s2", 8, "4", ["page-merge", "has-override"]), (1, "c1", "s2", 7, "3", ["page-merge"]), (1, "c2", "overview", 10, None, ["low-confidence"])]
    got = {r.path: r for r in export.exported(spark.createDataFrame(chapters, CHAPTER), spark.createDataFrame(queue, "doc_id long, slug string, section string, page int, label string, flags array<string>"), "책").collect()}
    assert set(got) == {"chapters/001__front-preface.md", "chapters/002__c1.md", "parts/01__전면부.md", "parts/02__제1편.md", "excluded.md", "index.md"}
    note = "Two section은 고위험 페이지 검토 항목 때문에 NotebookLM v1에서 제외했습니다. (인쇄 3, 4; PDF 7, 8; flags: has-override, page-merge)"
    assert got["chapters/002__c1.md"].content == f"# 장 하나\n\n- 편: 제1편\n- 범위: 인쇄 1-5 / PDF 5-9\n- 생략: 위험 section 1개\n\nbody\n\n## One\n\nkept\n\n> 생략: {note}\n"
    assert "- 참고: " + rules.KEPT_RISKY in got["chapters/001__front-preface.md"].content and "- 범위: PDF 1\n" in got["chapters/001__front-preface.md"].content
    part = got["parts/02__제1편.md"].content
    assert part.startswith("# 제1편\n\n## 포함 장\n- 장 하나 (인쇄 1-5 / PDF 5-9)\n\n## 제외/생략\n- 장 둘: 고위험") and f"- 장 하나 > Two: 생략: {note}" in part and "\n## 장 하나\n\n- 범위" in part and "\n### One\n" in part
    assert got["excluded.md"].content.count("\n- ") == 4 and "## Section 생략\n- 제1편 / 장 하나 > Two: 생략: " in got["excluded.md"].content and "부 록 / 부록 장 (- / PDF 20-30): 부록은" in got["excluded.md"].content
    assert "- 업로드용 part 파일 수: 2\n- 검수용 chapter 파일 수: 2\n- chapter 제외 수: 3\n- section 생략 수: 1\n" in got["index.md"].content and "02__제1편.md: 제1편 / 포함 장 1개 / 제외 장 1개 / 생략 section 1개 / " in got["index.md"].content
    assert got["index.md"].words == len(got["index.md"].content.split())


def test_bundle(spark):
    f = spark.createDataFrame
    pages = f([(1, 1, None, "frontmatter", True), (1, 2, None, "frontmatter", True), (1, 3, "1", "body", True), (1, 4, "2", "body", True), (1, 5, "3", "body", False)], "doc_id long, page int, page_label string, page_kind string, has_text boolean")
    reviews = f([(1, 2, "toc", None, None, False, ["목차"]), (1, 3, "prose", "c1", "s1", False, ["특 허 하나", "", None]), (1, 4, "prose", None, None, True, ["둘"])], "doc_id long, page int, layout string, chapter string, section string, merge_first boolean, paragraphs array<string>")
    audits = f([(1, 3, "high", []), (1, 4, "high", ["multi-section-page"])], "doc_id long, page int, tier string, flags array<string>")
    entries = f([(1, "e1", "c1", "s1", "One", "C", "P", "특허 하나", "", "item", 3, 4), (1, "e2", "c1", "s2", "Two", "C", "P", "둘 FTA", "", "item", 4, 4), (1, "e3", "c1", "part-intro", "개정 연혁", "C", "부 록", "x", "", "search-alias", 4, 4), (1, "e4", "front-preface", "overview", "개요", "머리말", "F", "y", "", "overview", 1, 1)], "doc_id long, id string, chapter string, section string, section_title string, chapter_title string, part_title string, text string, excerpt string, entry_type string, page_start int, page_end int")
    chapters = f([(1, "c1", "C", "P", "별첨 있음", '<section id="s1">', 3, 3)], "doc_id long, chapter string, title string, part_title string, summary string, html string, page_start int, page_end int")
    covered = bundle.coverage(pages, reviews, audits, entries, chapters)
    assert [(r.page, r["mode"], r.n_entries) for r in covered.orderBy("page").collect()] == [(1, "search-only", 1), (2, "toc-transform", 0), (3, "reader-body", 1), (4, "search-only", 3), (5, None, 0)]
    total = bundle.coverage_summary(covered).first()
    assert (total.reader_body, total.search_only, total.toc_transform, total.hidden_text_pages, total.uncovered_body_pages, total.unlabelled_text_pages, total.toc_span) == (1, 2, 1, [], [5], [1, 2], [2, 2])
    special = {(r.group, r.via, r.term) for r in bundle.special_sections(entries, chapters).collect()}
    assert special == {("fta_gi", "search-index", "FTA"), ("revision_history", "search-index", "개정 연혁"), ("appendix", "search-index", "부록"), ("front_preface", "search-index", "머리말"), ("appendix", "document-data", "별첨")}
    asked = [r.query for r in bundle.query_set(bundle.special_sections(entries, chapters)).orderBy("at").collect()]
    assert asked[:9] == list(rules.FIXED_QUERIES) and asked[9:] == ["부록"]
    got = {r.page: r for r in bundle.compared(covered, reviews, entries, chapters).collect()}
    assert {p: r.status for p, r in got.items()} == {2: "unsupported", 3: "candidate-backed", 4: "ambiguous"}
    assert (got[3].locator.source, got[3].locator.route, got[4].locator.source, got[2].locator.source) == ("page-review", "#/chapter/c1/s1", "search-index-candidate", "none")
    assert got[3].limitations == list(rules.LIMITS_ALWAYS) and got[4].limitations[3:] == [rules.LIMIT_MANY, rules.LIMIT_SECTIONS, rules.LIMIT_MERGED] and got[2].limitations[3:] == [rules.LIMIT_NO_CANDIDATE, rules.LIMIT_NO_CHAPTER]
    assert got[3].tokens == got[3].others == ["특허", "하나"]
    names = {x for x in __import__("re").findall(r"\{(\w+)\}", rules.LEDGER)} - {"files", "baseline", "special_sections"}
    ledger = one(spark, bundle.report({**{n: F.lit(7) for n in names}, "baseline": bundle.baseline_line("2026-01-01"), "special_sections": bundle.special_report({"toc": F.lit(2)})}))
    assert "- `toc`: `2` record(s)\n- `part_intro`: `0` record(s)" in ledger and "baseline reference: `data/research/pdf-web-audit/2026-01-01/`\n\n## 2." in ledger and ledger.count("`7`") == 15 and "{" not in ledger
    assert bundle.bundle_ids("2026-11-26") == ("2026-11-26-r2", "2026-11-26") and bundle.bundle_ids("x", "mine") == ("mine", None) and bundle.bundle_ids("x", "mine-r2", "b") == ("mine-r2", "b")


def test_pictures_and_sinks(spark, tmp_path):
    (tmp_path / "in" / "images").mkdir(parents=True)
    (tmp_path / "in" / "a.pdf").write_bytes(b"\x00\xff\n\r\n")
    (tmp_path / "in" / "images" / "new.png").write_bytes(bytes(range(256)))
    (tmp_path / "out" / "images").mkdir(parents=True)
    (tmp_path / "out" / "images" / "stale.png").write_bytes(b"x")
    got = images.decoded(spark, str(tmp_path / "in"), lambda data: iter([(1, 0, 30, 10, [0.0, 0.0, 30.0, 10.0], "png", data[:2])])).collect()
    assert [(r.doc_id, r.page, r.width, bytes(r.content)) for r in got] == [("a.pdf", 1, 30, b"\x00\xff")]
    assert one(spark, images.too_small(F.lit(30), F.lit(10))) and one(spark, images.decorative(F.lit(None).cast("int"), F.lit(2)))
    files = sinks.publish(spark, str(tmp_path / "in"), str(tmp_path / "out"), ["a.pdf"], ("images", "absent"))
    assert sorted(r.name for r in files.where("name not like '.%'").collect()) == ["a.pdf", "new.png"]
    assert (tmp_path / "out" / "a.pdf").read_bytes() == b"\x00\xff\n\r\n" and (tmp_path / "out" / "images" / "new.png").read_bytes() == bytes(range(256))
    n = sinks.write_files(spark.createDataFrame([("x/a.md", "text \n\n"), ("b.md", None)], "path string, content string"), str(tmp_path / "files"))
    assert n == 2 and (tmp_path / "files" / "x" / "a.md").read_text() == "text\n" and (tmp_path / "files" / "b.md").read_text() == "\n"
    assert list((tmp_path / "files").iterdir()) and not list(__import__("pathlib").Path(sinks.replaced(spark, str(tmp_path / "files"))).iterdir())
    df = spark.range(5)
    kept, seen = sinks.observed(df, "run", rows=F.count("*"))
    assert kept.count() == 5 or kept.collect()
    assert sinks.required(df, F.col("id") >= 0, "bad").count() == 5
    with pytest.raises(Exception, match="bad row"):
        sinks.required(df, F.col("id") < 3, "bad row").collect()
    with pytest.raises(FileNotFoundError, match="toc.json"):
        tables.artifact(spark, str(tmp_path), "toc.json")


def test_command_line(capsys):
    from leafloom.__main__ import main

    main(["bundle", "--bundle-id", "b-r2"])
    main(["list"])
    out = capsys.readouterr().out.splitlines()
    assert out[0] == '{"bundle": "b-r2", "baseline": "b"}' and "d04_range_blocks" in out
    with pytest.raises(SystemExit):
        main(["run", "nothing", "a", "b"])
