import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from leafloom.functions import text
from leafloom.operators import assembly, layout, ordered, qa, relational
from leafloom.sources import sinks, tables
from leafloom.streaming import arrivals


def test_parents_and_ranges_equal_a_stack(spark):
    rng = random.Random(1)
    rows = [(d, i, rng.randint(1, 4), i * 2 + rng.randint(0, 1)) for d in range(5) for i in range(60)]
    df = spark.createDataFrame(rows, "doc int, ord int, level int, start int")
    got = relational.range_by_level(relational.parent_by_level(df, ["doc"], "ord", "level", 4), ["doc"], "ord", "level", 4, "start", F.lit(500))
    got = {(r.doc, r.ord): (r.parent, r.range_end) for r in got.collect()}
    for d in range(5):
        own, stack = [r for r in rows if r[0] == d], []
        for i, (_, at, level, start) in enumerate(own):
            while stack and stack[-1][1] >= level:
                stack.pop()
            end = next((s - 1 for _, _, lv, s in own[i + 1 :] if lv <= level), 500)
            assert got[d, at] == (stack[-1][0] if stack else None, max(start, end))
            stack.append((at, level))


def test_bands_and_clusters_equal_sweeps(spark):
    rng = random.Random(2)
    rows = [(g, i, rng.uniform(0, 100)) for g in range(8) for i in range(40)]
    rows = [(g, i, a, a + rng.uniform(0, 4)) for g, i, a in rows]
    df = spark.createDataFrame(rows, "g int, i int, a double, b double")
    got = {(r.g, r.i): r.band for r in ordered.bands(df, ["g"], "a", "b", 1.0, ["a", "i"]).collect()}
    near = {(r.g, r.i): r.cluster for r in ordered.clusters(df, ["g"], "a", 2.0, ["a", "i"]).collect()}
    for g in range(8):
        band = cluster = 0
        reach = last = float("-inf")
        for _, i, a, b in sorted((r for r in rows if r[0] == g), key=lambda r: (r[2], r[1])):
            band, cluster = band + (a > reach + 1), cluster + (a - last > 2)
            reach, last = max(reach, b), a
            assert (got[g, i], near[g, i]) == (band, cluster)


def test_slugs_never_collide(spark):
    df = spark.createDataFrame([(1, i, b) for i, b in enumerate(["x", "x-2", "x", "x", "y" * 80, "y" * 80])], "g int, i int, base string")
    got = [r.slug for r in ordered.unique_slugs(df, "g", "i", "base").orderBy("i").collect()]
    assert got == ["x", "x-2", "x-3", "x-4", "y" * 80, "y" * 78 + "-2"]


def test_ranking_without_one_task(spark):
    df = spark.range(1000).select((F.xxhash64("id") % 50).alias("v"), "id")
    got = {r.id: r["rank"] for r in ordered.ranked(df, [F.desc("v"), F.col("id")], parts=7).collect()}
    want = sorted(df.collect(), key=lambda r: (-r.v, r.id))
    assert [got[r.id] for r in want] == list(range(1, 1001))


def test_first_and_last_wins_and_ties(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 2, 2), (None, 3, 3), ("b", 4, 4)], "k string, v int, o int")
    assert sorted((r.k, r.v) for r in relational.first_wins(df, "k", "v", "o").collect()) == [("a", 1), ("b", 4)]
    assert {r.k: r.v for r in relational.last_wins(df, "k", "v", "o").collect()} == {"a": 2, None: 3, "b": 4}
    d = spark.createDataFrame([(1, "y", 0), (1, "x", 1), (1, "x", 2), (1, "y", 3)], "g int, v string, o int")
    assert relational.dominant(d, ["g"], "v", F.col("o")).first().v == "y"


def page(texts, **columns):
    rows = [{"doc_id": 1, "page": 1, "line": i, "text": t, "left": 70.0, "top": 150.0 + 16 * i, "bottom": 161.0 + 16 * i, "right": min(525.0, 70.0 + 8 * len(t)), "font_size": 10.0} for i, t in enumerate(texts)]
    for i, changes in columns.items():
        rows[int(i[1:])].update(changes)
    return pd.DataFrame(rows)


LONG = "긴 본문 문장이 이어지는 줄로서 폭의 절반을 넘도록 충분히 길게 적은 것이며 다음 줄로"


def reviewed(spark, frame, overrides=None):
    return layout.reviewed(spark.createDataFrame(frame), overrides).first()


def test_prose_page_with_heading_date_and_signature(spark):
    f = page(["제목", *[LONG] * 5, LONG + ".", "2024년 1월 2일", "특허심판원장 홍길동"], r0={"left": 280.0, "right": 315.0}, r5={"left": 90.0}, r8={"left": 240.0, "right": 355.0})
    got = reviewed(spark, f)
    assert (got.layout, got.confidence) == ("prose", "high")
    assert [p.kind for p in got.paragraphs] == ["heading", "body", "body", "date", "signature"]
    assert [p.reason for p in got.paragraphs] == ["page-start", "style-change", "indent", "style-change", "style-change"]


def test_toc_list_table_and_decorative_pages(spark):
    toc = page([f"항목 {i} ........ {i + 10}" for i in range(12)])
    assert reviewed(spark, toc).layout == "toc"
    listed = page([x for i in range(6) for x in (f"{i + 1}. 항목의 첫 줄", "이어지는 줄")])
    got = reviewed(spark, listed)
    assert got.layout == "list" and got.n_paragraphs == 6 and got.paragraphs[0].text == "1. 항목의 첫 줄 이어지는 줄"
    rows = [{"doc_id": 1, "page": 1, "line": 3 * r + c, "text": f"셀{r}{c}", "left": 70.0 + 150 * c, "right": 110.0 + 150 * c, "top": 150.0 + 20 * r, "bottom": 161.0 + 20 * r, "font_size": 10.0} for r in range(6) for c in range(3)]
    got = reviewed(spark, pd.DataFrame(rows))
    assert got.layout == "table/form" and got.paragraphs[0].text == "셀00 | 셀01 | 셀02" and got.n_paragraphs == 6
    few = page(["가운데", "제목"], r0={"left": 270.0, "right": 325.0}, r1={"left": 270.0, "right": 325.0})
    got = reviewed(spark, few)
    assert got.layout == "decorative/structural" and got.n_paragraphs == 2 and got.confidence == "medium"


def test_margin_fragments_go_and_overrides_regroup(spark):
    f = page([LONG] * 10 + ["제", "1", "편"])
    for i, top in zip((10, 11, 12), (300.0, 312.0, 324.0), strict=True):
        f.loc[i, ["left", "right", "top", "bottom", "font_size"]] = [550.0, 565.0, top, top + 9, 8.0]
    got = reviewed(spark, f)
    assert got.n_paragraphs == 1 and "제 1" not in got.paragraphs[0].text
    starts = spark.createDataFrame([(1, 1, 4)], "doc_id long, page long, index int")
    got = reviewed(spark, f, starts)
    assert got.has_override and got.confidence == "low" and [(p.reason, len(p.lines)) for p in got.paragraphs] == [("page-start", 4), ("override", 6)]


def test_oversize_prose_is_split_and_pages_merge(spark):
    f = page([LONG + "."] * 40)
    got = reviewed(spark, f)
    assert all(len(p.text) <= 900 for p in got.paragraphs) and got.n_paragraphs > 1
    two = pd.concat([page([LONG] * 9), page([LONG] * 9).assign(page=2)])
    assert [r.merge_first for r in layout.reviewed(spark.createDataFrame(two)).orderBy("page").collect()] == [False, True]
    two = pd.concat([page([LONG] * 9), page(["5. " + LONG, *[LONG] * 8]).assign(page=2)])
    assert [r.merge_first for r in layout.reviewed(spark.createDataFrame(two)).orderBy("page").collect()] == [False, False]


@pytest.mark.parametrize("flags,tier,lane,score", [
    (["multi-section-page"], "high", "accuracy-critical", 68), (["boxed-heading"], "low", "readability-critical", 50),
    (["korean-linebreak-residue"], "medium", "accuracy-critical", 67), ([], "low", "readability-critical", 0), (["page-merge", "angle-heading"], "high", "accuracy-critical", 115 + 8),
])
def test_tiers_lanes_and_scores(spark, flags, tier, lane, score):
    overlap = 2 if flags else 0
    array = F.array(*map(F.lit, flags)) if flags else F.array().cast("array<string>")
    row = spark.range(1).select(array.alias("f")).select(qa.risk_tier(F.col("f"), F.lit("prose"), F.lit("high")).alias("t"), qa.lane(F.col("f")).alias("l"), qa.priority(F.col("f"), F.lit("prose"), F.lit("high"), F.lit(overlap)).alias("s")).first()
    want = score if len(flags) != 1 or flags == ["multi-section-page"] else score + 8
    assert (row.t, row.l, row.s) == (tier, lane, want)


def test_all_flags_in_order(spark):
    got = spark.range(1).select(qa.page_flags(F.lit(2), F.lit("low"), F.lit(True), F.lit(True), F.array(F.lit("【상자】"), F.lit("< 각 >"), F.lit("제")), F.lit("table/form"), F.lit("<p>"), F.lit(True)).alias("f")).first().f
    assert got == ["multi-section-page", "low-confidence", "has-override", "page-merge", "boxed-heading", "angle-heading", "korean-linebreak-residue", "missing-table-crop", "structural-fragment-paragraph"]


def test_nearest_unused_is_greedy(spark):
    a = spark.createDataFrame([("p", 1, [0.0]), ("p", 2, [0.1]), ("p", 3, [9.0])], "page string, vec_id long, v array<double>")
    b = spark.createDataFrame([("p", 10, [0.2]), ("p", 11, [5.0])], "page string, other_id long, v array<double>")
    got = assembly.nearest_unused(a, b, ["page"], "vec_id", "other_id", "v").collect()
    assert sorted((r.vec_id, r.other_id) for r in got if r.other_id) == [(1, 10), (2, 11)]


def test_sinks_and_sources(spark, tmp_path):
    df = spark.createDataFrame([("a", "x  \n"), ("b", None)], "k string, t string")
    out = sinks.write_bundle(str(tmp_path / "b"), {"rows.json": df, "text.md": df.select("t")})
    assert len(out) == 2 and spark.read.json(out[0]).count() == 2
    listing = sinks.manifest(spark, str(tmp_path / "b")).where("name like 'part-%'").collect()
    assert listing and all(r.bytes >= 0 for r in listing)
    with pytest.raises(FileNotFoundError, match="nope.json, other.json"):
        sinks.publish(spark, str(tmp_path / "b"), str(tmp_path / "c"), ["rows.json", "nope.json", "other.json"])
    assert sinks.publish(spark, str(tmp_path / "b"), str(tmp_path / "c"), ["rows.json"]).count() > 0
    assert tables.optional(spark, str(tmp_path / "none"), "a int").count() == 0
    (tmp_path / "c.json").write_text('{"a": "7", "title": "t"}')
    assert tables.config(spark, str(tmp_path / "c.json"), {"a": 1, "b": 2}).select("a", "b").first() == (7, 2)
    assert sinks.summary("run", pages=3) == '{"run": "run", "pages": 3}'


def test_streamed_inventory(spark, tmp_path):
    schema = "page long, text string, at timestamp"
    rows = spark.sql("select 1L page, '- ii -' || char(10) || 'x' text, timestamp'2024-01-01 00:01:00' at union all select 2L, 'plain', timestamp'2024-01-01 00:02:00'")
    rows.write.parquet(str(tmp_path / "in"))
    q = arrivals.counts(arrivals.arriving(spark, str(tmp_path / "in"), schema), "at").writeStream.format("memory").queryName("arrived").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert {r.page_kind: r.pages for r in spark.table("arrived").collect()} == {"frontmatter": 1, "unlabeled": 1}


def test_lines_of_odd_texts(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, " \n\n ")], "doc_id long, text string")
    assert layout.synthetic(df).collect() == []
    assert [r.x for r in df.select(F.size(text.lines(F.coalesce("text", F.lit("")))).alias("x")).collect()] == [0, 0, 0]


def test_paged_files_and_rounding(spark, tmp_path):
    from leafloom.sources.pages import paged

    (tmp_path / "a.txt").write_text("one\ftwo\0 \f")
    (tmp_path / "skip.bin").write_bytes(b"x")
    rows = sorted(map(tuple, paged(spark, str(tmp_path)).collect()))
    assert rows == [("a.txt", 1, "one"), ("a.txt", 2, "two"), ("a.txt", 3, "")]
    got = spark.createDataFrame([(0.25,), (0.15,), (9.95,), (2.25,), (14352.85,), (-0.25,), (7.0,)], "x double").select(text.python_round(F.col("x")).alias("r")).collect()
    assert [r.r for r in got] == [round(v, 1) for v in (0.25, 0.15, 9.95, 2.25, 14352.85, -0.25, 7.0)]


def test_rounding_equals_python(spark, sf):
    from leafloom.plans import registry

    rows = registry.QUERIES["g04_python_rounding"](spark, sf).collect()
    assert rows and all(r.rounded == round(r.l_extendedprice / 7, 1) for r in rows)


def test_oversize_paragraphs_are_split_where_they_can_be(spark, sf):
    from leafloom.plans import registry

    rows = registry.QUERIES["l03_oversize_split"](spark, sf).collect()
    assert rows and all(r.n_chars <= 901 or r.n_lines == 1 for r in rows)
