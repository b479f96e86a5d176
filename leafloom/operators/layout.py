"""Layout analysis of pages from lines with boxes: line kinds, features, page layouts, paragraphs and confidence.

Line tests, features and the page's layout are Column expressions, windows and grouped aggregates over (doc, page).
Only the split into paragraphs carries state from line to line; it runs per page on arrays of precomputed tests.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leafloom.functions import rules, text
from leafloom.operators import ordered

PAGE = ["doc_id", "page"]
WIDTH, HEIGHT = 595.0, 842.0
DECORATIVE, TOC, TABLE, LIST, PROSE = "decorative/structural", "toc", "table/form", "list", "prose"


def synthetic(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", per_page: int = 40) -> DataFrame:
    """Lines with made-up boxes from texts: one column, a page every ``per_page`` lines, headings centered."""
    lines = docs.select(F.col(id_col).alias("doc_id"), F.posexplode(text.lines(F.col(text_col))).alias("at", "text"))
    row = F.col("at") % per_page
    top = 150.0 + 16.0 * row
    lines = lines.select("doc_id", (F.floor(F.col("at") / per_page) + 1).cast("int").alias("page"), row.cast("int").alias("line"), "text", top.alias("top"), (top + 11.0).alias("bottom"))
    return lines.withColumns({"left": F.lit(70.0), "right": F.least(F.lit(525.0), 70.0 + 8.0 * F.length("text")), "font_size": F.lit(10.0)})


def centered(left: Column, right: Column, width: float = WIDTH) -> Column:
    """Near the page's middle, with even margins, and not wide."""
    middle = F.abs((left + right) / 2 - width / 2) <= width * 0.1
    return middle & (F.abs(left - (width - right)) <= width * 0.12) & (right - left <= width * 0.6)


def line_kind(width: float = WIDTH, height: float = HEIGHT) -> Column:
    """date, heading, signature or body of a line with text, top, font_size and is_centered."""
    t, mid = F.col("text"), F.col("is_centered")
    structural = t.rlike(rules.STRUCTURAL_HEADING)
    signed = F.contains(t, F.lit("원장")) & (mid | (F.length(t) <= 24) & (F.col("top") >= height * 0.8))
    return F.when(t.rlike(rules.DATE_LINE), "date").when(F.trim(t).rlike(rules.SPECIAL_HEADING), "heading").when(signed, "signature").when(mid & ((F.length(t) <= 20) | structural), "heading").when(structural & (F.col("font_size") >= 11.5), "heading").otherwise("body")


def ends_with_page_number(c: Column) -> Column:
    last = F.regexp_extract(F.rtrim(F.regexp_replace(text.normalize(c), r"\)+$", "")), r"(\S+)$", 1)
    return F.when(c.rlike(rules.LEADER_DOTS), last.rlike(rules.TRAILING_PAGE_NUMBER)).otherwise(last.rlike(r"(?i)^(?:\d{1,4}|[ivxlcdm]{1,12})$"))


def is_marker(c: Column) -> Column:
    x = text.normalize(c)
    return x.rlike(rules.LIST_MARKER) | x.rlike(rules.ARTICLE_LINE) | F.startswith(x, F.lit("§")) | x.rlike(rules.LEADER_DOTS)


def cleaned(lines: DataFrame) -> DataFrame:
    """Lines without page labels, running headers at the top, stacked fragments at the right margin, and headings that a
    page repeats at once."""
    t, top = F.col("text"), F.col("top")
    headers = rules.RUNNING_HEADERS + rules.LAYOUT_HEADERS
    header = F.lit(False)
    for p in headers:
        header = header | t.rlike(p)
    small = (top < 110) & (F.col("font_size") <= 9.5) & t.rlike(rules.STRUCTURAL_HEADING)
    out = lines.where(~(t.rlike(rules.PAGE_LABEL) | (top < 140) & (header | t.rlike(rules.FRAGMENT_HEADER) & ~t.rlike(r"^\d+$")) | small))
    return margin_pruned(top_pruned(out))


def top_pruned(lines: DataFrame, first: int = 6, ahead: int = 3) -> DataFrame:
    """Lines without the structural headings among a page's first ones that come again within the next few lines."""
    order = ["top", "left", "block", "line"] if "block" in lines.columns else ["top", "left", "line"]
    by = W.partitionBy(*PAGE).orderBy(*order)
    again = reduce(lambda a, b: a | b, (F.coalesce(F.lead("text", k).over(by) == F.col("text"), F.lit(False)) for k in range(1, ahead + 1)))
    marked = lines.withColumn("_again", (F.row_number().over(by) <= first) & F.col("text").rlike(rules.STRUCTURAL_HEADING) & again)
    return marked.where("not _again").drop("_again")


def margin_pruned(lines: DataFrame, width: float = WIDTH) -> DataFrame:
    """Lines without chains of narrow small fragments down the right margin that spell a part's running title."""
    maybe = (F.col("left") >= width - 72) & (F.col("right") - F.col("left") <= 44) & (F.col("font_size") <= 9.7) & F.col("text").rlike(rules.MARGIN_FRAGMENT)
    # a page without candidates keeps its lines as they are: the windows run over candidates alone
    cand = lines.where(maybe).select(*PAGE, "line", "left", "top", "text")
    by = W.partitionBy(*PAGE).orderBy("top", "left", "line")
    cand = cand.withColumns({"_dx": F.col("left") - F.lag("left").over(by), "_dy": F.col("top") - F.lag("top").over(by)})
    chained = ordered.islands(cand, PAGE, ["top", "left", "line"], ~((F.abs("_dx") <= 8) & F.col("_dy").between(0, 22)), "chain")
    stat = chained.groupBy(*PAGE, "chain").agg(F.count("*").alias("n"), F.bool_or(F.col("text") == "편").alias("part"), F.bool_or((F.col("text") == "제") | F.col("text").rlike(r"^\d")).alias("number"))
    drop = chained.join(stat.where("n >= 2 and part and number"), [*PAGE, "chain"], "left_semi").select(*PAGE, "line")
    return lines.join(drop, [*PAGE, "line"], "left_anti")


def described(lines: DataFrame, width: float = WIDTH, height: float = HEIGHT) -> DataFrame:
    """Lines with their tests, renumbered in reading order, and the page's dominant body font."""
    by = W.partitionBy(*PAGE).orderBy("top", "left", "line")
    out = lines.withColumn("is_centered", centered(F.col("left"), F.col("right"), width)).withColumn("kind", line_kind(width, height))
    out = out.withColumns({"index": F.row_number().over(by) - 1, "width": F.col("right") - F.col("left"), "leader": F.col("text").rlike(rules.LEADER_DOTS), "numbered": ends_with_page_number(F.col("text")), "marker": is_marker(F.col("text")), "bullet": text.normalize(F.col("text")).rlike(rules.ROUND_BULLET)})
    plain = out.where(~F.col("is_centered") & (F.length("text") >= 8) & ~F.col("kind").isin("date", "signature") & ~F.col("leader"))
    per = plain.groupBy(*PAGE, F.round("font_size", 1).alias("font")).agg(F.count("*").alias("n"), F.min("index").alias("first"))
    font = per.groupBy(*PAGE).agg(F.min_by("font", F.struct(-F.col("n"), F.col("first"))).alias("body_font"))
    out = out.join(font, PAGE, "left")
    off = F.coalesce(F.abs(F.col("font_size") - F.col("body_font")), F.lit(0.0))
    body = F.col("body_font").isNotNull() & (off <= 0.8) & ~F.col("is_centered") & (F.col("kind") == "body") & (F.col("width") >= width * 0.45) & ~F.col("leader")
    return out.withColumns({"odd_font": off > 0.8, "body_like": body})


def features(lines: DataFrame, width: float = WIDTH) -> DataFrame:
    """The figures of each page that its layout follows from, with its left anchor and line gap."""
    by = W.partitionBy(*PAGE).orderBy("index")
    pair = lines.withColumns({"_left": F.lag("left").over(by), "_bottom": F.lag("bottom").over(by), "_body": F.lag("body_like").over(by)})
    gap = F.when(F.col("body_like") & F.col("_body") & (F.abs(F.col("left") - F.col("_left")) <= 6) & (F.col("top") > F.col("_bottom")), F.col("top") - F.col("_bottom"))
    ratio = lambda c: F.avg(F.col(c).cast("double"))
    page = pair.withColumn("_gap", gap).groupBy(*PAGE).agg(
        F.count("*").alias("n_lines"), ratio("is_centered").alias("centered_ratio"), ratio("leader").alias("leader_ratio"), ratio("numbered").alias("numbered_ratio"),
        F.count_if("marker").alias("markers"), F.count_if("bullet").alias("bullets"), F.first("body_font").alias("body_font"),
        F.coalesce(F.median(F.when(F.col("body_like"), F.col("left"))), F.lit(0.0)).alias("anchor"), F.coalesce(F.median("_gap"), F.lit(10.0)).alias("line_gap"),
    )
    runs = ordered.islands(lines.withColumn("_was", F.lag("body_like").over(by)), PAGE, ["index"], F.col("_was") != F.col("body_like"), "run").where("body_like").groupBy(*PAGE, "run").agg(F.count("*").alias("n")).groupBy(*PAGE).agg(F.max("n").alias("body_run"))
    short = ordered.bands(lines, PAGE, "top", "bottom", 3.0, ["top", "left", "index"]).where(F.col("width") <= width * 0.35)
    columns = ordered.clusters(short, [*PAGE, "band"], "left", 18.0, ["left", "index"]).groupBy(*PAGE, "band").agg(F.max("cluster").alias("columns"))
    tables = columns.where("columns >= 3").groupBy(*PAGE).agg(F.count("*").alias("table_bands"))
    grid = ordered.clusters(lines.where(F.col("width") <= width * 0.35), PAGE, "left", 18.0, ["left", "index"])
    anchors = grid.groupBy(*PAGE, "cluster").agg(F.median("left").alias("center"))
    near = grid.select(*PAGE, "left").join(anchors, PAGE).where(F.abs(F.col("left") - F.col("center")) <= 18).groupBy(*PAGE, "cluster").agg(F.count("*").alias("n"))
    strong = near.groupBy(*PAGE).agg(F.count_if(F.col("n") >= 5).alias("strong")).join(grid.groupBy(*PAGE).agg(F.count("*").alias("short")), PAGE).select(*PAGE, ((F.col("short") >= 15) & (F.col("strong") >= 3)).alias("anchor_grid"))
    out = page.join(runs, PAGE, "left").join(tables, PAGE, "left").join(strong, PAGE, "left")
    return out.fillna(0, ["body_run", "table_bands"]).fillna(False, ["anchor_grid"]).withColumn("layout", page_layout())


def page_layout() -> Column:
    """A page's layout from its figures: the first of the fixed rules that holds, else prose."""
    n, run, leaders, r = F.col("n_lines"), F.col("body_run"), F.col("leader_ratio"), rules
    listed = (F.col("markers") >= r.LIST_MARKERS) & ((F.col("markers") / n >= r.LIST_SHARE) | (run < r.PROSE_RUN))
    cases = (
        (DECORATIVE, (n <= r.DECORATIVE_LINES) & ((F.col("centered_ratio") >= r.DECORATIVE_SHARE) | (run < r.PROSE_RUN))),
        (TOC, (leaders >= r.TOC_LEADERS) & (F.col("numbered_ratio") >= r.TOC_NUMBERS)),
        (TABLE, (F.col("table_bands") >= r.TABLE_BANDS) | F.col("anchor_grid")),
        (LIST, (F.col("bullets") >= 1) & (n >= r.BULLET_LINES) | listed | (leaders >= r.LIST_LEADERS)),
    )
    return F.coalesce(*(F.when(test, name) for name, test in cases), F.lit(PROSE))


class _Page:
    """A page's lines as arrays; each method gives the reason for a new paragraph at every line, '' for none."""

    def __init__(self, c: dict[str, np.ndarray], a: int, b: int):
        self.text = c["text"][a:b].tolist()
        self.left, self.top, self.bottom, self.width = (c[k][a:b] for k in ("left", "top", "bottom", "width"))
        self.kind, self.marker, self.leader, self.numbered = (c[k][a:b].tolist() for k in ("kind", "marker", "leader", "numbered"))
        self.odd, self.mid, self.boxed, self.ended = (c[k][a:b] for k in ("odd_font", "is_centered", "boxed", "ended"))
        self.anchor, self.line_gap = float(c["anchor"][a]), float(c["line_gap"][a])
        self.n = b - a
        self.gap = np.concatenate([[0.0], self.top[1:] - self.bottom[:-1]])

    def prose(self) -> list[str]:
        wide = max(self.line_gap + 3.5, self.line_gap * 1.4)
        out, in_list = ["page-start"], bool(self.marker[0])
        for i in range(1, self.n):
            before = self.text[i - 1]
            style = self.kind[i] != self.kind[i - 1] or self.mid[i] != self.mid[i - 1] or self.odd[i] or self.odd[i - 1]
            at_anchor, indented = abs(self.left[i] - self.anchor) <= 6, self.left[i] >= self.anchor + 12
            flows = not style and not self.ended[i - 1] and self.gap[i] < wide
            cited = self.text[i].startswith("§") and flows and at_anchor and before.count("(") > before.count(")")
            if self.marker[i] and not cited:
                why = "list-marker"
            elif self.boxed[i] or style:
                why = "style-change"
            elif self.gap[i] >= wide:
                why = "gap"
            elif indented and not (in_list and flows):
                why = "indent"
            elif self.ended[i - 1] and at_anchor and self.gap[i] > self.line_gap + 1:
                why = "gap"
            else:
                why = ""
            if why:
                in_list = why == "list-marker" or bool(self.marker[i])
            out.append(why)
        return self.shortened(out)

    def shortened(self, why: list[str], longest: int = rules.LONGEST_PARAGRAPH, least: int = rules.LEAST_CUT) -> list[str]:
        """More boundaries inside paragraphs beyond ``longest`` characters: the last good one in reach, again and again."""
        why = list(why)
        length = np.concatenate([[0], np.cumsum([len(t) + 1 for t in self.text])])
        marked = np.array(self.marker, bool)
        closed = np.concatenate([[False], np.array(self.ended[:-1], bool)]) & (np.abs(self.left - self.anchor) <= rules.ANCHOR_SLACK)
        starts = [i for i, w in enumerate(why) if w]
        for a, b in zip(starts, [*starts[1:], self.n], strict=True):
            while length[b] - length[a] - 1 > longest:
                inner = np.arange(a + 1, b)
                ahead = length[inner] - length[a]
                entry = marked[inner] & (ahead >= rules.LEAST_ENTRY)
                good = entry | closed[inner]
                near = np.flatnonzero(good & (ahead >= least) & (ahead <= longest))
                if not good.any():
                    break
                k = near[-1] if len(near) else np.flatnonzero(good)[0]
                why[inner[k]], a = "list-marker" if entry[k] else "gap", int(inner[k])
        return why

    def toc(self) -> list[str]:
        out, left = ["page-start"], self.left[0]
        for i in range(1, self.n):
            goes_on = self.left[i] > left + 8 and not self.numbered[i]
            out.append("toc-entry" if (self.leader[i] or self.numbered[i]) and not goes_on else "")
            left = self.left[i] if out[-1] else left
        return out

    def list(self) -> list[str]:
        out, first = ["page-start"], 0
        for i in range(1, self.n):
            entry = self.marker[i] or self.boxed[i]
            note = self.leader[first] and not self.leader[i] and self.gap[i] >= 10
            out.append("list-marker" if entry else "gap" if note else "style-change" if self.boxed[first] else "")
            first = i if out[-1] else first
        return out

    def decorative(self) -> list[str]:
        return ["page-start", *["style-change"] * (self.n - 1)]

    def table(self) -> list[str]:
        """A row per band; a wide single line behind a row of several starts a tail of wide single lines."""
        band, reach = [0], self.bottom[0]
        for i in range(1, self.n):
            band.append(band[-1] + (self.top[i] > reach + 3))
            reach = max(reach, self.bottom[i]) if band[-1] == band[-2] else self.bottom[i]
        size = np.bincount(band)
        out, tail = ["page-start"], False
        for i in range(1, self.n):
            if band[i] == band[i - 1]:
                out.append("")
                continue
            wide = size[band[i]] == 1 and self.width[i] >= 240
            if tail and wide and self.gap[i] <= 24:
                out.append("")
                continue
            tail = bool(wide and size[band[i] - 1] >= 2)
            out.append("gap" if tail else "table-row")
        return out


_BUILDERS = {PROSE: _Page.prose, TOC: _Page.toc, LIST: _Page.list, TABLE: _Page.table, DECORATIVE: _Page.decorative}


def boundaries(lines: DataFrame, pages: DataFrame) -> DataFrame:
    """Lines with layout, paragraph number (from 0) and the reason why the paragraph began."""
    marked = lines.withColumns({"boxed": F.trim("text").rlike(rules.SPECIAL_HEADING), "ended": F.rtrim("text").rlike(rules.SENTENCE_END)})
    marked = marked.join(pages.select(*PAGE, "layout", "anchor", "line_gap"), PAGE)
    schema = ", ".join(f"`{c}` {t}" for c, t in marked.dtypes) + ", reason string, paragraph int"

    def paged(f: pd.DataFrame) -> pd.DataFrame:
        doc, page = f["doc_id"].to_numpy(), f["page"].to_numpy()
        cuts = [0, *(np.flatnonzero((doc[1:] != doc[:-1]) | (page[1:] != page[:-1])) + 1).tolist(), len(f)]
        c = {k: f[k].to_numpy() for k in ("text", "left", "top", "bottom", "width", "kind", "marker", "leader", "numbered", "odd_font", "is_centered", "boxed", "ended", "anchor", "line_gap", "layout")}
        why, number = [], []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            own = _BUILDERS[c["layout"][a]](_Page(c, a, b))
            why += own
            number += (np.cumsum([bool(w) for w in own]) - 1).tolist()
        return f.assign(reason=why, paragraph=number)

    def split(frames):
        # pages follow each other whole; the last one of a batch may go on in the next
        rest = None
        for f in frames:
            f = f if rest is None else pd.concat([rest, f], ignore_index=True)
            if not len(f):
                continue
            open_ = (f["doc_id"] == f["doc_id"].iloc[-1]) & (f["page"] == f["page"].iloc[-1])
            rest, done = f[open_], f[~open_]
            if len(done):
                yield paged(done)
        if rest is not None and len(rest):
            yield paged(rest)

    return marked.repartition(*PAGE).sortWithinPartitions(*PAGE, "index").mapInPandas(split, schema)


def coerced(reason: Column) -> Column:
    """The reason if it is a known one, else a change of style."""
    return F.when(reason.isin(*rules.BOUNDARY_REASONS), reason).otherwise("style-change")


def override_paragraphs(df: DataFrame, keys: list[str], specs: Column, layout: Column) -> DataFrame:
    """Manual paragraphs (structs of text, kind, reason) as rows: empty ones drop out, the rest are numbered from 0."""
    rows = df.select(*keys, layout.alias("layout"), F.posexplode(specs).alias("at", "spec"))
    default = F.when(F.col("at") == 0, "page-start").when(F.col("layout") == TABLE, "table-row").when(F.col("layout") == TOC, "toc-entry").when(F.col("layout") == LIST, "list-marker").otherwise("override")
    body = text.for_search(F.col("spec.text"))
    kind = F.coalesce("spec.kind", F.when(F.col("layout") == PROSE, "body").otherwise(F.col("layout")))
    rows = rows.select(*keys, "at", body.alias("text"), kind.alias("kind"), coerced(F.coalesce("spec.reason", default)).alias("reason")).where("text <> ''")
    return rows.withColumn("paragraph", F.row_number().over(W.partitionBy(*keys).orderBy("at")) - 1).drop("at")


def overridden(split: DataFrame, overrides: DataFrame) -> DataFrame:
    """Paragraph starts with manual ones: ``overrides`` lists (doc_id, page, index) of lines that must start one.

    A page with overrides begins anew at exactly those lines and its first; other pages stay as they are.
    """
    forced = overrides.select(*PAGE, "index").distinct().withColumn("_forced", F.lit(True))
    pages = overrides.select(*PAGE).distinct().withColumn("has_override", F.lit(True))
    out = split.join(forced, [*PAGE, "index"], "left").join(pages, PAGE, "left").withColumn("has_override", F.coalesce("has_override", F.lit(False)))
    by = W.partitionBy(*PAGE).orderBy("index")
    begins = F.when(F.col("has_override"), F.coalesce("_forced", F.lit(False)) | (F.col("index") == 0)).otherwise(F.col("reason") != "")
    out = out.withColumn("_begins", begins).withColumn("reason", F.when(F.col("has_override"), F.when(F.col("_begins"), F.when(F.col("index") == 0, "page-start").otherwise("override")).otherwise("")).otherwise(F.col("reason")))
    return out.withColumn("paragraph", (F.sum(F.col("_begins").cast("int")).over(by) - 1).cast("int")).drop("_begins", "_forced")


def paragraphs(split: DataFrame, width: float = WIDTH) -> DataFrame:
    """One row per paragraph: text by its layout, kind, reason, lines and box."""
    ordered_lines = F.array_sort(F.collect_list(F.struct("index", "left", "top", "text", "kind", "marker", "odd_font", "boxed", "width")))
    g = split.groupBy(*PAGE, "paragraph").agg(
        ordered_lines.alias("l"), F.first("layout").alias("layout"), F.max("reason").alias("reason"), F.min("left").alias("left"), F.min("top").alias("top"), F.max("right").alias("right"), F.max("bottom").alias("bottom"))
    first = F.get("l", F.lit(0))
    across = F.array_join(F.transform(F.array_sort(F.transform("l", lambda x: F.struct(x["left"].alias("a"), x["top"].alias("b"), x["text"].alias("t")))), lambda x: x["t"]), " | ")
    wide = (F.size("l") <= 3) & F.forall("l", lambda x: x["width"] >= width * 0.45)
    body = F.when((F.col("layout") == TABLE) & ~wide, across).when(F.col("layout") == TABLE, F.array_join("l.text", " ")).otherwise(text.join_segments(F.col("l.text")))
    own = first["kind"].isin("heading", "date", "signature")
    heading = first["boxed"] | first["text"].rlike(rules.ARTICLE_LINE) | first["marker"] & first["odd_font"]
    kind = F.when(own, first["kind"]).when(F.col("layout") != PROSE, F.col("layout")).when(heading, "heading").otherwise("body")
    return g.select(*PAGE, "paragraph", "layout", body.alias("text"), kind.alias("kind"), coerced(F.col("reason")).alias("reason"), F.col("l.index").alias("lines"), "left", "top", "right", "bottom")


def confidence(layout: Column, body_font: Column, override: Column, n: Column) -> Column:
    return F.when(override | (n == 0), "low").when(body_font.isNull() | (layout != PROSE), "medium").otherwise("high")


def reviewed(lines: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """One row per page: layout, confidence, paragraphs, and whether its first paragraph continues the page before."""
    told = ordered.written(described(cleaned(lines)))
    pages = features(told)
    split = boundaries(told, pages)
    split = overridden(split, overrides) if overrides is not None else split.withColumn("has_override", F.lit(False))
    flags = split.groupBy(*PAGE).agg(F.bool_or("has_override").alias("has_override"))
    p = paragraphs(split).groupBy(*PAGE).agg(F.array_sort(F.collect_list(F.struct("paragraph", "text", "kind", "reason", "lines"))).alias("paragraphs"))
    page = pages.join(p, PAGE).join(flags, PAGE)
    by = W.partitionBy("doc_id").orderBy("page")
    page = page.withColumn("_prev", F.lag(F.struct("layout", "anchor", F.element_at("paragraphs", -1).alias("last"), "page")).over(by))
    first = F.get("paragraphs", F.lit(0))
    merge = (
        (F.col("_prev.layout") == PROSE) & (F.col("layout") == PROSE) & (F.col("_prev.page") == F.col("page") - 1) & (first["kind"] == "body") & ~is_marker(first["text"])
        & ~F.rtrim("_prev.last.text").rlike(rules.SENTENCE_END) & (F.abs(F.col("anchor") - F.col("_prev.anchor")) <= 6) & (F.length("_prev.last.text") + F.length(first["text"]) <= 900)
    )
    n = F.size("paragraphs")
    return page.select(*PAGE, "layout", confidence(F.col("layout"), F.col("body_font"), F.col("has_override"), n).alias("confidence"), n.alias("n_paragraphs"), "has_override", F.coalesce(merge, F.lit(False)).alias("merge_first"), "anchor", "line_gap", "body_font", "paragraphs")
