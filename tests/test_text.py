import pytest
from pyspark.sql import functions as F

from leafloom.functions import text


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize("line,label", [("- xii -", "xii"), ("-IV-", "iv"), ("- 12 -", "12"), ("- 12345 -", None), ("12", None), ("- a1 -", None)])
def test_page_labels(spark, line, label):
    assert value(spark, text.page_label(F.lit(line))) == label


def test_headers_and_triples_go(spark):
    lines = F.array(*map(F.lit, ["제", "12", "편", "부 록", "제1장 의의", "제1장 의의", "본문입니다.", "- 3 -"]))
    assert value(spark, text.strip_headers(text.strip_labels(lines))) == ["제1장 의의", "본문입니다."]


@pytest.mark.parametrize("broken,whole", [("특허 심판의 청구 인은", "특허심판의 청구인은"), ("이 에 대한 판단", "이에 대한 판단"), ("법정대리 인 또 는", "법정대리인 또는"), ("사람이 에서", "사람이 에서"), ("", "")])
def test_repairs(spark, broken, whole):
    assert value(spark, text.repair(F.lit(broken))) == whole


@pytest.mark.parametrize("segments,whole", [(["심판", "관은"], "심판관은"), (["권리", "를 가진다"], "권리를 가진다"), (["그", "사건"], "그 사건"), (["민법 (민소", "§12)"], "민법 (민소§12)"), (["상표권", "자는"], "상표권자는"), (["plain", "words"], "plain words"), ([], "")])
def test_segments_join(spark, segments, whole):
    array = F.array(*map(F.lit, segments)) if segments else F.array().cast("array<string>")
    assert value(spark, text.join_segments(array)) == whole


def test_slugs_and_excerpts(spark):
    assert value(spark, text.slug(F.lit(" 제1장 (의의)·요건 / A_b "))) == "제1장-의의-요건---a-b".replace("---", "-")
    assert value(spark, text.slug(F.lit("()"))) == "entry"
    assert value(spark, text.excerpt(F.lit("abc def"), 5)) == "abc…"
    assert value(spark, text.compact(F.lit("One. " + "word " * 60), 40)) == "One."
    assert value(spark, text.compact(F.lit("word " * 60), 20)).endswith("…")


def test_locators_routes_and_uris(spark):
    assert [value(spark, text.locator(F.lit(a), F.lit(b).cast("int"))) for a, b in ((1, 3), (2, 2), (4, None))] == ["1-3", "2", "4"]
    assert value(spark, text.route(F.lit("c"), F.lit("overview"))) == "#/chapter/c"
    assert value(spark, text.route(F.lit("c"), F.lit("s1"))) == "#/chapter/c/s1"
    assert value(spark, text.route(F.lit(""), F.lit("s1"))) is None
    assert value(spark, text.encode_uri(F.lit("제1장 (a)~!*"))) == "%EC%A0%9C1%EC%9E%A5%20(a)~!*"


def test_classes_keep_their_order(spark):
    got = value(spark, text.classify(F.lit("심판청구의 절차와 당사자 증거 사례"), part=F.lit("부 록")))
    assert got == ["party", "evidence", "case", "procedure", "appendix"]


def test_repeated_headings_are_trimmed(spark):
    t = F.array(F.lit("제1장 의의"), F.lit("요건"))
    assert value(spark, text.trim_headings(F.lit("제1장ㆍ의의 요 건 본문 제1장 의의"), t)) == "본문 제1장 의의"
    assert value(spark, text.trim_headings(F.lit("요건이란"), t)) == "요건이란"
    assert value(spark, text.trim_headings(F.lit(None).cast("string"), t)) is None


def test_paragraphs_flush_at_length(spark):
    lines = F.array(*(F.lit("x" * 200) for _ in range(5)))
    assert [len(p) for p in value(spark, text.paragraphs(lines, 420))] == [602, 401]


def test_residue_in_texts(spark):
    for t, want in (("심판 관은 말한다", True), ("그 사건 등", False), ("민법 §12", True), ("", False), ("한 단어", False)):
        assert value(spark, text.linebreak_residue(F.lit(t))) is want, t


def test_residue_pairs(spark):
    pairs = [("권리", "를", True), ("심판", "관", True), ("각", "호", False), ("사건", "등", False), ("부", "동산법", True), ("부", "동산", False), ("상표권", "자는", True), ("법", "으", False), ("법으", "로", True), ("권리는", "인", False), ("abc", "를", False)]
    for a, b, want in pairs:
        assert value(spark, text.residue_pair(F.lit(a), F.lit(b))) is want, (a, b)
        if a != "abc":
            assert text._one_word(a, b) is want, (a, b)
