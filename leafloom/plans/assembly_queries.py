"""Queries of contents tables, chapters' content, the reader's side and Markdown export."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leafloom.functions import rules, text
from leafloom.operators import assembly as A
from leafloom.operators import content as C
from leafloom.operators import export as E
from leafloom.operators import layout as L
from leafloom.operators import reader as Q
from leafloom.operators import regions as G
from leafloom.operators import toc as T
from leafloom.plans import manual
from leafloom.plans.registry import query
from leafloom.sources.tables import table

# books of documents: pages by place in the book, contents pages where the text has a table row
_PAGES = "SELECT doc_id // 20 AS book, doc_id % 20 + 1 AS page, text, CASE WHEN lang = 'en' THEN 'body' ELSE 'frontmatter' END AS kind FROM documents"


def _pages(spark, sf_dir):
    d = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    kind = F.when(F.col("lang") == "en", "body").otherwise("frontmatter")
    return d.select(F.floor(F.col("doc_id") / 20).alias("doc_id"), (F.pmod("doc_id", F.lit(20)) + 1).alias("page"), F.when(F.col("doc_id") % 3 == 0, F.col("doc_id").cast("string")).alias("page_label"), kind.alias("page_kind"), "text")


@query(f"""WITH p AS ({_PAGES}), f AS (SELECT *, min(page) FILTER (WHERE page <= 12 AND contains(text, 'ch')) OVER (PARTITION BY book) AS first FROM p),
e AS (SELECT *, sum(CASE WHEN kind = 'frontmatter' THEN 0 ELSE 1 END) OVER (PARTITION BY book ORDER BY page ROWS UNBOUNDED PRECEDING) AS ended FROM f WHERE page >= first) SELECT book AS doc_id, page FROM e WHERE ended = 0""")
def p03_toc_pages(spark, sf_dir):
    """The first page within the scan limit that has the marker and those behind it while their kind stays."""
    return T.contents_pages(_pages(spark, sf_dir), 12, "ch")


_LEVEL1 = """SELECT doc_id // 20 AS book, CASE doc_id % 20 WHEN 1 THEN '머리말' WHEN 3 THEN '일러두기' ELSE '심판편람편찬위원' END AS title, doc_id % 20 + 1 AS page_start, doc_id % 20 + 2 AS page_end FROM documents WHERE doc_id % 20 IN (1, 3, 18) AND doc_id // 20 % 3 <> 1"""


@query(f"""WITH p AS ({_PAGES}), d AS (SELECT book, max(page) AS n FROM p GROUP BY 1), t AS (SELECT book, min(page) AS toc FROM p WHERE kind = 'frontmatter' AND page > 3 GROUP BY 1), l AS ({_LEVEL1})
SELECT book AS doc_id, 'frontmatter' AS part, 'cover-and-masthead' AS slug, '표지 및 발간정보' AS title, 1 AS page_start, 4 AS page_end, coalesce(toc - 1, 12) AS part_end FROM d LEFT JOIN t USING (book)
UNION ALL SELECT book, 'frontmatter', 'front-preface', title, page_start, page_end, coalesce(toc - 1, 12) FROM d LEFT JOIN t USING (book) JOIN l USING (book) WHERE title = '머리말'
UNION ALL SELECT book, 'frontmatter', 'front-notes', title, page_start, least(page_end, coalesce(toc - 1, page_end)), coalesce(toc - 1, 12) FROM d LEFT JOIN t USING (book) JOIN l USING (book) WHERE title = '일러두기'
UNION ALL SELECT book, 'backmatter', 'editorial-board', title, page_start, n, n FROM d JOIN l USING (book) WHERE title = '심판편람편찬위원'""")
def d01_made_up_parts(spark, sf_dir):
    p = _pages(spark, sf_dir)
    title = F.when(F.col("page") == 2, rules.FRONT_CHAPTERS[1][1]).when(F.col("page") == 4, rules.FRONT_CHAPTERS[2][1]).otherwise(rules.BACK_CHAPTER[1])
    none = F.lit(None).cast("string")
    level1 = p.where("page in (2, 4, 19) and doc_id % 3 <> 1").select("doc_id", title.alias("title"), F.col("page").alias("page_start"), (F.col("page") + 1).alias("page_end"), none.alias("label_start"), none.alias("label_end"))
    contents = p.where("page_kind = 'frontmatter' and page > 3").select("doc_id", "page")
    made = T.made_up(p.groupBy("doc_id").agg(F.max("page").alias("page_count")), level1, contents)
    return made.select("doc_id", "part", "slug", "title", "page_start", "page_end", "part_end")


def _outline(spark, sf_dir):
    """Books' outlines: a part every ten pages, a chapter every five, an item on every other page."""
    p = _pages(spark, sf_dir)
    one = lambda level, title: F.struct(F.lit(level).alias("level"), title.alias("title"))
    level, page = lambda test, x: F.when(test, x), F.col("page")
    rows = F.array_compact(F.array(
        level(page % 10 == 1, one(2, F.concat(F.lit("제"), F.floor(page / 10) + 1, F.lit("편 Part")))), level(page % 5 == 1, one(3, F.lit("제1장 Chapter"))), level(page % 2 == 0, one(4, F.concat(F.lit("제"), page, F.lit("절 Item")))),
    ))
    e = p.select("doc_id", "page", F.posexplode(rows).alias("k", "r"))
    n = F.row_number().over(W.partitionBy("doc_id").orderBy("page", "k"))
    return e.select("doc_id", n.alias("index"), "r.level", "r.title", F.col("page").alias("page_start"), F.lit(None).cast("string").alias("label_start")), p


@query("""WITH p AS (SELECT doc_id // 20 AS b, doc_id % 20 + 1 AS page, CASE WHEN doc_id % 3 = 0 THEN doc_id END AS label FROM documents), m AS (SELECT b, max(page) AS n FROM p GROUP BY 1),
c AS (SELECT b, page, row_number() OVER (PARTITION BY b ORDER BY page) AS k, lead(page) OVER (PARTITION BY b ORDER BY page) AS nxt FROM p WHERE page % 5 = 1),
r AS (SELECT b, page, k, greatest(page, coalesce(nxt - 1, n)) AS page_end FROM c JOIN m USING (b) WHERE EXISTS (SELECT 1 FROM p WHERE p.b = c.b AND p.page = c.page - (c.page - 1) % 10))
SELECT b AS doc_id, '제' || ((page - 1) // 10 + 1) || '편 Part' AS part_title, '제1장-chapter' || CASE WHEN row_number() OVER (PARTITION BY b ORDER BY page) = 1 THEN '' ELSE '-' || row_number() OVER (PARTITION BY b ORDER BY page) END AS slug, '제1장 Chapter' AS title, page AS page_start, page_end,
 (SELECT max_by(label, page) FROM p WHERE p.b = r.b AND p.page BETWEEN r.page AND r.page_end AND label IS NOT NULL) AS label_end FROM r""")
def d02_d03_reader_parts(spark, sf_dir):
    outline, pages = _outline(spark, sf_dir)
    chapters, _, _ = T.built(outline, pages, 12)
    return chapters.where("part_ord > 1").select("doc_id", "part_title", "slug", "title", "page_start", "page_end", F.col("label_end").cast("long").alias("label_end"))


@query("""WITH p AS (SELECT doc_id // 20 AS b, doc_id % 20 + 1 AS page FROM documents), i AS (SELECT b, page, page - (page - 1) % 5 AS chapter FROM p WHERE page % 2 = 0)
SELECT i.b AS doc_id, '제' || page || '절 Item' AS title, '제' || page || '절-item' AS section, page AS page_start FROM i WHERE EXISTS (SELECT 1 FROM p WHERE p.b = i.b AND p.page = i.chapter) AND EXISTS (SELECT 1 FROM p WHERE p.b = i.b AND p.page = i.chapter - (i.chapter - 1) % 10)""")
def d03_toc_items(spark, sf_dir):
    outline, pages = _outline(spark, sf_dir)
    return T.built(outline, pages, 12)[1].select("doc_id", "title", "section", "page_start")


def _blocks(spark, sf_dir):
    m = manual.books(spark, sf_dir)
    ranged = m["chapters"].select("doc_id", "chapter", "page_start", "page_end", F.array("title", "part_title").alias("titles"))
    return m, C.range_blocks(ranged, m["paragraphs"], m["images"], m["regions"])


@query()
def d04_range_blocks(spark, sf_dir):
    """The blocks of all chapters; the trimming and merging have no SQL, a walk along the pages is the test's other way."""
    return _blocks(spark, sf_dir)[1]


@query()
def d05_segments(spark, sf_dir):
    """All chapters' blocks by section, cut at the items' titles; tested against a walk along the blocks."""
    m, blocks = _blocks(spark, sf_dir)
    return C.segmented(blocks, m["items"])


@query()
def d06_d07_rendering(spark, sf_dir):
    """HTML, text and images of every section of all chapters; tested against a walk along the blocks."""
    m, blocks = _blocks(spark, sf_dir)
    return C.rendered(C.segmented(blocks, m["items"]), ["doc_id", "chapter", "section"], F.col("section"))


@query()
def d10_d11_chapters(spark, sf_dir):
    """Every chapter of all books with its HTML, summary and counts; tested against a walk along its pages."""
    m = manual.books(spark, sf_dir)
    return C.built(m["chapters"], m["items"], m["paragraphs"], m["images"], m["regions"])[0]


@query()
def d09_d11_entries(spark, sf_dir):
    """The search entries of all books: introductions, aliases, overviews and items; tested against a walk."""
    m = manual.books(spark, sf_dir)
    return C.built(m["chapters"], m["items"], m["paragraphs"], m["images"], m["regions"])[1]


@query("""WITH d AS (SELECT doc_id // 20 AS b, doc_id, text, doc_id % 20 AS n FROM documents WHERE len(string_split(trim(regexp_replace(text, '\\s+', ' ', 'g')), ' ')) > 52), w AS (SELECT *, string_split(trim(regexp_replace(text, '\\s+', ' ', 'g')), ' ') AS w FROM d),
t AS (SELECT b, n, doc_id, unnest([{'k': 1, 'title': w[26] || ' ' || w[27]}, {'k': 2, 'title': w[51] || ' ' || w[52]}]) AS r FROM w), c AS (SELECT b, n, doc_id, r.k AS k, r.title AS title, CASE WHEN n >= 15 THEN ['appendix'] ELSE [] END AS cats FROM t)
SELECT b AS doc_id, trim(regexp_replace(title, '[·․ㆍ\\s]+', ' ', 'g')) AS title, array_to_string(cats, ',') AS categories, n * 12 + 2 + k * 3 AS page_start FROM c WHERE len(cats) > 0""")
def p08_exploration(spark, sf_dir):
    m = manual.books(spark, sf_dir)
    _, entries = C.built(m["chapters"], m["items"], m["paragraphs"], m["images"], m["regions"])
    return C.exploration(entries).select("doc_id", "title", F.array_join("categories", ",").alias("categories"), "page_start")


@query("""WITH p AS (SELECT p_size, p_partkey, p_brand, CASE WHEN p_partkey % 5 = 0 THEN 'Name ' || p_partkey ELSE CAST(p_partkey AS VARCHAR) END AS lead FROM part), c AS (SELECT *, regexp_matches(lead, '^(?:\\d{2,4}|[A-Z]{1,6})$') AS code FROM p),
f AS (SELECT p_size, p_partkey, lead, p_brand, coalesce(min(p_partkey) FILTER (WHERE code) OVER (PARTITION BY p_size), 1e18) AS first FROM c),
r AS (SELECT p_size, string_agg('<tr><th>' || lead || '</th><th>' || p_brand || '</th></tr>', '' ORDER BY p_partkey) FILTER (WHERE p_partkey < first) AS head, string_agg('<tr><td>' || lead || '</td><td>' || p_brand || '</td></tr>', '' ORDER BY p_partkey) FILTER (WHERE p_partkey >= first) AS body FROM f GROUP BY 1)
SELECT p_size, '<table class="reader-synthetic-table">' || coalesce('<thead>' || head || '</thead>', '') || '<tbody>' || coalesce(body, '') || '</tbody></table>' AS html FROM r""")
def d07_tables(spark, sf_dir):
    p = table(spark, sf_dir, "part", "p_size", "p_partkey", "p_brand")
    lead = F.when(F.col("p_partkey") % 5 == 0, F.concat(F.lit("Name "), "p_partkey")).otherwise(F.col("p_partkey").cast("string"))
    rows = F.array_sort(F.collect_list(F.struct("p_partkey", F.array(lead, "p_brand").alias("c"))))
    return p.groupBy("p_size").agg(rows.alias("r")).select("p_size", C.table_html(F.col("r.c")).alias("html"))


@query("""WITH c AS (SELECT r_regionkey, r_name, n_nationkey, n_name || ' (' || CASE WHEN n_nationkey % 2 = 0 THEN 'p.' || n_nationkey ELSE 'PDF ' || (n_nationkey + 1) END || ')' AS line FROM region LEFT JOIN nation ON n_regionkey = r_regionkey AND r_regionkey <> 2)
SELECT r_regionkey, CASE WHEN count(line) = 0 THEN r_name ELSE '이 편은 다음 장으로 구성됩니다. ' || string_agg(line, ' / ' ORDER BY n_nationkey) END AS intro, CASE WHEN count(line) = 0 THEN '<p>' || r_name || '</p>' ELSE '<p>이 편은 다음 장으로 구성됩니다.</p>' || string_agg('<p>' || line || '</p>', '' ORDER BY n_nationkey) END AS html,
 CASE WHEN count(line) = 0 THEN r_name ELSE '이 편은 다음 장으로 구성됩니다.' END AS described, string_agg(line, '|' ORDER BY n_nationkey) AS items, '<h2>x</h2><p>y</p>' AS stripped FROM c GROUP BY 1, r_name""")
def d08_d13_part_intros(spark, sf_dir):
    n = table(spark, sf_dir, "nation").where("n_regionkey <> 2")
    line = C.chapter_line(F.col("n_name"), F.when(F.col("n_nationkey") % 2 == 0, F.col("n_nationkey").cast("string")), F.col("n_nationkey") + 1)
    lines = n.groupBy("n_regionkey").agg(F.array_sort(F.collect_list(F.struct("n_nationkey", line.alias("t")))).alias("l"))
    r = table(spark, sf_dir, "region").join(lines, F.col("n_regionkey") == F.col("r_regionkey"), "left").withColumn("l", F.coalesce("l.t", F.array().cast("array<string>")))
    html, said = C.part_intro(F.col("r_name"), F.col("l"))
    r = r.withColumns({"intro": said, "html": html})
    described, items = Q.parsed_intro(F.col("intro"))
    page = F.concat(F.lit('<h2>x</h2><section id="part-intro"><h3>'), "r_name", F.lit("</h3>"), "html", F.lit("</section><p>y</p>"))
    return r.select("r_regionkey", "intro", "html", described.alias("described"), F.nullif(F.array_join(items, "|"), F.lit("")).alias("items"), Q.without_intro(page).alias("stripped"))


_ENTRIES = """d AS (SELECT doc_id, source, lang, doc_id % 7 AS n, coalesce(quality, -1) AS quality FROM documents LEFT JOIN labels USING (doc_id)), e AS (SELECT source AS chapter, CASE WHEN n = 0 AND quality >= 0 THEN 'overview' ELSE 's' || doc_id END AS section, CASE WHEN n = 0 AND quality >= 0 THEN 'overview' WHEN n = 1 THEN 'part-intro' WHEN n = 2 THEN 'search-alias' ELSE 'item' END AS entry_type, doc_id AS page_start, doc_id + n AS page_end, doc_id AS ord FROM d)"""


def _entries(spark, sf_dir):
    d = table(spark, sf_dir, "documents", "doc_id", "source", "lang").join(table(spark, sf_dir, "labels", "doc_id", "quality"), "doc_id", "left").withColumn("n", F.col("doc_id") % 7)
    over = (F.col("n") == 0) & (F.coalesce("quality", F.lit(-1)) >= 0)
    kind = F.when(over, "overview").when(F.col("n") == 1, "part-intro").when(F.col("n") == 2, "search-alias").otherwise("item")
    return d.select(F.col("source").alias("chapter"), F.when(over, "overview").otherwise(F.concat(F.lit("s"), "doc_id")).alias("section"), kind.alias("entry_type"), F.concat(F.lit("T"), "doc_id").alias("section_title"), F.upper("source").alias("chapter_title"), F.col("lang").alias("part_title"), F.lit("").alias("text"), F.col("doc_id").alias("page_start"), (F.col("doc_id") + F.col("n")).alias("page_end"), F.lit(None).cast("string").alias("label"), F.col("n").alias("images"), F.col("doc_id").alias("ord"))


def _sources(entries):
    return entries.groupBy("chapter").agg(F.min("page_start").alias("page_start")).select("chapter", F.upper("chapter").alias("title"), F.lit("part").alias("part_title"), F.lit("all of it").alias("summary"), F.lit(None).cast("string").alias("label_start"), "page_start", F.lit(0).cast("long").alias("images"))


@query(f"""WITH {_ENTRIES}, a AS (SELECT chapter, section, entry_type, page_start, page_end, ord FROM e WHERE entry_type <> 'search-alias' UNION ALL SELECT chapter, 'overview', 'overview', min(page_start), min(page_start), -1 FROM e GROUP BY 1 HAVING count(*) FILTER (WHERE section = 'overview') = 0)
SELECT chapter, section, entry_type, CAST(row_number() OVER (PARTITION BY chapter ORDER BY CASE WHEN entry_type = 'part-intro' THEN 1 WHEN section = 'overview' THEN 2 ELSE 3 END, page_start, page_end, ord) AS BIGINT) AS place, '#/chapter/' || chapter || CASE WHEN section = 'overview' THEN '' ELSE '/' || section END AS route FROM a""")
def d12_catalogs(spark, sf_dir):
    e = _entries(spark, sf_dir)
    return Q.catalog(_sources(e), e).select("chapter", "section", "entry_type", F.col("place").cast("long").alias("place"), "route")


@query(f"""WITH {_ENTRIES}, k AS (SELECT x.*, d.lang, d.n FROM e x JOIN d ON d.doc_id = x.ord), f AS (SELECT doc_id, source, lang, n, CASE WHEN n < 5 THEN doc_id ELSE -1 END AS page_start, CASE WHEN n = 6 THEN 'other' ELSE 'T' || doc_id END AS title, CASE WHEN doc_id % 11 = 0 THEN 'nowhere' ELSE source END AS owner FROM d)
SELECT doc_id, CASE WHEN owner = 'nowhere' THEN NULL ELSE owner END AS chapter, CASE WHEN owner = 'nowhere' OR f.n = 6 THEN 'overview' ELSE section END AS section, CASE WHEN owner = 'nowhere' THEN '/' WHEN f.n = 6 OR section = 'overview' THEN '#/chapter/' || owner ELSE '#/chapter/' || owner || '/' || section END AS route,
 CASE WHEN owner = 'nowhere' OR f.n = 6 THEN CASE WHEN doc_id % 2 = 0 THEN 1 ELSE 0 END ELSE k.n END AS images FROM f JOIN k ON k.ord = f.doc_id""")
def j14_key_cascade(spark, sf_dir):
    """Rows that name an entry by its whole key, by title only, by their chapter only, or nothing at all."""
    e = _entries(spark, sf_dir).withColumn("title", F.col("section_title"))
    n, own = F.col("images"), F.when(F.col("ord") % 11 == 0, "NOWHERE").otherwise(F.col("chapter_title"))
    found = e.select(F.col("ord").alias("doc_id"), "part_title", own.alias("chapter_title"), "label", F.when(n < 5, F.col("page_start")).otherwise(-1).alias("page_start"), "page_end", F.when(n == 6, "other").otherwise(F.col("title")).alias("title"), (F.col("ord") % 2 == 0).alias("has_image"))
    # every chapter under each part that its entries name
    chapters = e.groupBy("chapter", "part_title").agg(F.min("ord").alias("ord")).select("chapter", "part_title", F.upper("chapter").alias("chapter_title"), F.lit(None).cast("string").alias("label"), "ord")
    return Q.resolved(found, e, chapters).select("doc_id", "chapter", "section", "route", "images")


@query("""WITH p AS (SELECT page_id, trim(regexp_extract(html, '<h1>([^<]*)</h1>', 1)) AS h, regexp_extract(html, '<p>([^<]+)</p>', 1) AS t FROM pages)
SELECT page_id, '<section id="s"><h2>' || h || '</h2><p>' || CASE WHEN page_id % 4 < 2 THEN ltrim(t) WHEN page_id % 4 = 2 THEN 'no. 1 ' || h || ' ' || t ELSE t END || '</p></section><div class="reader-table-scroll"><table class="x"><tr></tr></table></div>' AS html FROM p WHERE h <> '' AND NOT contains(t, h)""")
def x18_reader_html(spark, sf_dir):
    p = table(spark, sf_dir, "pages", "page_id", "html").select("page_id", F.trim(F.regexp_extract("html", "<h1>([^<]*)</h1>", 1)).alias("h"), F.regexp_extract("html", "<p>([^<]+)</p>", 1).alias("t"))
    p = p.where((F.col("h") != "") & ~F.contains("t", F.col("h")))  # a paragraph with the heading in it is the case of the test's fixtures
    way = F.col("page_id") % 4
    lead = F.when(way == 0, F.concat("h", F.lit(" "), "t")).when(way == 1, F.concat(F.lit("part one "), "h", F.lit(" "), "t")).when(way == 2, F.concat(F.lit("no. 1 "), "h", F.lit(" "), "t")).otherwise(F.col("t"))
    page = F.concat(F.lit('<section id="s"><h2>'), "h", F.lit("</h2><p>"), lead, F.lit('</p></section><table class="x"><tr></tr></table>'))
    return p.select("page_id", Q.ready_html(page).alias("html"))


@query("""WITH p AS (SELECT page_id, CASE WHEN page_id % 3 = 0 THEN html ELSE '<section id="a' || page_id || '">' || html || '</section><section id="b"><p>end</p></section>' END AS html FROM pages)
SELECT page_id, CASE WHEN page_id % 3 = 0 THEN NULL ELSE 'a' || page_id END AS id, CASE WHEN page_id % 3 = 0 THEN length(html) ELSE length(html) - length('<section id="a' || page_id || '"></section><section id="b"><p>end</p></section>') END AS n_chars FROM p UNION ALL SELECT page_id, 'b', 10 FROM p WHERE page_id % 3 <> 0""")
def m01_sections(spark, sf_dir):
    p = table(spark, sf_dir, "pages", "page_id", "html")
    made = F.when(F.col("page_id") % 3 == 0, F.col("html")).otherwise(F.concat(F.lit('<section id="a'), "page_id", F.lit('">'), "html", F.lit('</section><section id="b"><p>end</p></section>')))
    return p.select("page_id", F.explode(E.split_sections(made)).alias("s")).select("page_id", "s.id", F.length("s.html").cast("long").alias("n_chars"))


@query("""WITH p AS (SELECT page_id, string_split(html, '<p>') AS parts FROM pages), x AS (SELECT page_id, unnest(parts) AS part, unnest(range(len(parts))) AS ord FROM p) SELECT page_id, ord, length(part) AS n_chars, CASE WHEN ord = 0 THEN 'overview' ELSE 'p' END AS title FROM x""")
def d05_cut_texts(spark, sf_dir):
    s = A.sections(table(spark, sf_dir, "pages", "page_id", "html"), "page_id", "html", "<(p)>")
    return s.select("page_id", F.col("ord").cast("long").alias("ord"), F.length("body").cast("long").alias("n_chars"), "title")


@query("""WITH h AS (SELECT page_id, regexp_extract(html, '<h1>([^<]*)</h1>', 1) AS h, regexp_extract(html, '<p>([^<]+)</p>', 1) AS t FROM pages), n AS (SELECT page_id, trim(regexp_replace(h, '\\s+', ' ', 'g')) AS h, trim(regexp_replace(t, '\\s+', ' ', 'g')) AS t FROM h)
SELECT page_id, CASE WHEN page_id % 2 = 0 THEN '# Other' || chr(10) || chr(10) ELSE '' END || '## ' || h || chr(10) || chr(10) || t || chr(10) || chr(10) || '[이미지 생략: 이미지]' AS markdown FROM n WHERE h <> '' AND t <> '' AND NOT contains(h, '&') AND NOT contains(t, '&')""")
def m02_markdown(spark, sf_dir):
    p = table(spark, sf_dir, "pages", "page_id", "html").withColumns({"h": F.regexp_extract("html", "<h1>([^<]*)</h1>", 1), "t": F.regexp_extract("html", "<p>([^<]+)</p>", 1)})
    p = p.where((F.trim("h") != "") & (F.trim("t") != "") & ~F.contains("h", F.lit("&")) & ~F.contains("t", F.lit("&")))  # entities: see the tests
    own = F.when(F.col("page_id") % 2 == 0, "Other").otherwise("Title, it")
    made = F.concat(F.lit("lead <h2>"), own, F.lit("</h2><ul><li>dropped</li></ul><h3>"), "h", F.lit("</h3><p>"), "t", F.lit('</p><table><tr><td>cell</td></tr></table><img src="x">'))
    return p.select("page_id", E.markdown(made, F.lit("Title , it")).alias("markdown"))


_M = """c AS (SELECT d.doc_id, d.doc_id // 20 AS b, d.source, l.toxic = 1 AS risky, d.doc_id % 2 = 0 AS headed, CASE WHEN d.doc_id % 20 = 0 THEN 'front-preface' WHEN d.doc_id % 20 = 19 THEN 'editorial-board' ELSE 'c' || d.doc_id END AS slug, CASE WHEN d.source = 'src3' THEN '부 록' ELSE d.source END AS part FROM documents d LEFT JOIN labels l USING (doc_id)),
p AS (SELECT *, CASE WHEN slug = 'editorial-board' OR part = '부 록' THEN 'exclude' WHEN coalesce(risky, false) AND NOT headed AND slug <> 'front-preface' THEN 'exclude' WHEN coalesce(risky, false) AND headed THEN 'omit-sections' ELSE 'include' END AS policy FROM c)"""


def _export(spark, sf_dir):
    """Books as chapters to export: even ones with headings, rated toxic ones with a risky section."""
    d = table(spark, sf_dir, "documents", "doc_id", "text", "source")
    n = F.pmod("doc_id", F.lit(20))
    slug = F.when(n == 0, "front-preface").when(n == 19, "editorial-board").otherwise(F.concat(F.lit("c"), "doc_id"))
    book = F.floor(F.col("doc_id") / 20)
    first = text.escape_html(F.get(text.lines(F.coalesce("text", F.lit(""))), F.lit(0)))
    page = F.concat(F.lit('<section id="overview"><h2>T'), "doc_id", F.lit("</h2><p>"), F.coalesce(first, F.lit("")), F.lit('</p></section><section id="part-intro"><p>intro</p></section><section id="s1"><h3>S</h3><p>body</p></section>'))
    none = F.lit(None).cast("string")
    empty = F.array().cast("array<struct<id:string,title:string>>")
    heads = F.when(F.col("doc_id") % 2 == 0, F.array(F.struct(F.lit("s1").alias("id"), F.lit("S").alias("title")))).otherwise(empty)
    chapters = d.select(book.alias("doc_id"), n.alias("ord"), slug.alias("slug"), F.concat(F.lit("T"), "doc_id").alias("title"), F.when(F.col("source") == "src3", rules.APPENDIX_PART).otherwise(F.col("source")).alias("part_title"), (n + 1).alias("page_start"), (n + 1).alias("page_end"), none.alias("label_start"), none.alias("label_end"), page.alias("html"), heads.alias("headings"), F.col("doc_id").alias("key"))
    risky = table(spark, sf_dir, "labels", "doc_id", "toxic").where("toxic = 1").select("doc_id").distinct()
    queue = risky.join(d.select("doc_id", "source"), "doc_id").select(book.alias("doc_id"), slug.alias("slug"), F.lit("s1").alias("section"), (n + 1).alias("page"), none.alias("label"), F.array(F.lit("low-confidence")).alias("flags"))
    return chapters, queue


@query(f"WITH {_M} SELECT doc_id AS key, policy, CASE WHEN policy <> 'exclude' THEN NULL WHEN slug = 'editorial-board' THEN '후면부 관리성 콘텐츠라서 NotebookLM v1에서 제외했습니다.' WHEN part = '부 록' THEN '부록은 표/서식 의존도가 높아 NotebookLM v1에서 제외했습니다.' ELSE '고위험 페이지가 있으나 section heading이 없어 chapter 전체를 NotebookLM v1에서 제외했습니다. (PDF ' || (doc_id % 20 + 1) || '; flags: low-confidence)' END AS reason FROM p")
def m03_inclusion(spark, sf_dir):
    own, _ = E.bodies(*_export(spark, sf_dir))
    return own.select("key", "policy", "reason")


@query(f"""WITH {_M}, f AS (SELECT p.doc_id, p.policy, p.slug, trim(regexp_replace((list_filter(string_split(d.text, chr(10)), lambda x: trim(regexp_replace(x, '\\s+', ' ', 'g')) <> ''))[1], '\\s+', ' ', 'g')) AS line, risky FROM p JOIN documents d USING (doc_id) WHERE policy <> 'exclude')
SELECT doc_id AS key, '# T' || doc_id || chr(10) || chr(10) || '- 편: ' || (SELECT part FROM p WHERE p.doc_id = f.doc_id) || chr(10) || '- 범위: PDF ' || (doc_id % 20 + 1) || chr(10) || CASE WHEN policy = 'omit-sections' THEN '- 생략: 위험 section 1개' || chr(10) ELSE '' END || CASE WHEN coalesce(risky, false) AND policy = 'include' THEN '- 참고: 전면부 포함 정책에 따라 QA 위험 페이지가 있어도 chapter 전체를 유지했습니다.' || chr(10) ELSE '' END || chr(10) || coalesce(nullif(line, '') || chr(10) || chr(10), '')
 || CASE WHEN policy = 'omit-sections' THEN '> 생략: S section은 고위험 페이지 검토 항목 때문에 NotebookLM v1에서 제외했습니다. (PDF ' || (doc_id % 20 + 1) || '; flags: low-confidence)' ELSE '## S' || chr(10) || chr(10) || 'body' END || chr(10) AS content FROM f""")
def m04_chapter_documents(spark, sf_dir):
    own, _ = E.bodies(*_export(spark, sf_dir))
    kept = own.where("policy <> 'exclude'")
    return kept.select("key", E.document(kept, "body", 1, True).alias("content"))


@query(f"""WITH {_M}, k AS (SELECT b, doc_id, slug, row_number() OVER (PARTITION BY b ORDER BY doc_id) AS n FROM p WHERE policy <> 'exclude'), q AS (SELECT b, part, min(doc_id) AS first FROM p WHERE part <> '부 록' GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY b ORDER BY first) AS n FROM q)
SELECT b AS doc_id, 'chapters/' || printf('%03d', n) || '__' || slug || '.md' AS path FROM k UNION ALL SELECT b, 'parts/' || printf('%02d', n) || '__' || part || '.md' FROM r UNION ALL SELECT DISTINCT b, 'excluded.md' FROM p UNION ALL SELECT DISTINCT b, 'index.md' FROM p""")
def m05_export_files(spark, sf_dir):
    return E.exported(*_export(spark, sf_dir)).select("doc_id", "path")


@query()
def m05_export_contents(spark, sf_dir):
    """The files' contents; tested against worked chapters."""
    return E.exported(*_export(spark, sf_dir))


@query()
def j12_nearest_unused(spark, sf_dir):
    """Each of a label's even vectors with its nearest unused odd one of equal size; greedy consumption, tested against brute force."""
    e = table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label").withColumns({"page": F.concat_ws("-", "label", F.floor(F.col("vec_id") / 100)), "width": F.floor(F.pmod("vec_id", F.lit(6)) / 2), "height": F.size("embedding")})
    other = e.where("vec_id % 2 = 1").select("page", "width", "height", F.col("vec_id").alias("other_id"), "embedding")
    return A.nearest_unused(e.where("vec_id % 2 = 0").select("page", "width", "height", "vec_id", "embedding"), other, ["page", "width", "height"], "vec_id", "other_id", "embedding")


@query()
def r01_r03_table_regions(spark, sf_dir):
    """Table regions of all documents' pages, table cells side by side; a box decides what joins it, so SQL has no form."""
    lines = table(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", F.posexplode(text.lines(F.coalesce("text", F.lit("")))).alias("i", "line"))
    page, row = F.floor(F.col("i") / 40), F.col("i") % 40
    cell = lines.select("doc_id", "i", page.alias("page"), row.alias("row"), F.posexplode(F.split("line", rules.TABLE_CELLS)).alias("k", "text"))
    wide = F.count("*").over(W.partitionBy("doc_id", "i"))
    left, top = 70.0 + F.col("k") * 120.0, 100.0 + F.col("row") * 16.0
    right = F.least(F.lit(525.0), left + F.when(wide > 1, F.least(F.lit(110.0), 8.0 * F.length("text"))).otherwise(8.0 * F.length("text")))
    placed = cell.select("doc_id", "page", (F.col("i") * 100 + F.col("k")).cast("int").alias("index"), left.alias("left"), top.alias("top"), right.alias("right"), (top + 11).alias("bottom"), "text")
    return G.table_regions(placed, ["doc_id", "page"], L.WIDTH)
