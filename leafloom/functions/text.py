"""Text functions as Column expressions: normalising, labels, slugs, excerpts, tests on lines, repair and joins."""

from __future__ import annotations

import re
from functools import lru_cache, reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from leafloom.functions import rules

#: White space as Python and Unicode see it.
WS = r"(?U)\s"


def normalize(c: Column) -> Column:
    """NUL as a space, runs of white space as one, ends trimmed."""
    return F.trim(F.regexp_replace(F.translate(c, "\0", " "), WS + "+", " "))


def first_words(c: Column, n: int) -> Column:
    """The first ``n`` words of ``normalize(c)``; what is behind them is not normalised."""
    words = rf"(?U)^[\s\x00]*([^\s\x00]+(?:[\s\x00]+[^\s\x00]+){{0,{n - 1}}})"
    return normalize(F.regexp_extract(c, words, 1))


def clean_title(c: Column, bookmark: bool = False) -> Column:
    """Middle dots as spaces, normalised; a bookmark's `` ,`` becomes ``,``."""
    out = normalize(F.translate(c, "․ㆍ·", "   "))
    return F.replace(out, F.lit(" ,"), F.lit(",")) if bookmark else out


def slug(c: Column, longest: int = 80) -> Column:
    """A lower-case name for addresses; ``entry`` if nothing is left."""
    x = F.regexp_replace(F.regexp_replace(clean_title(c), "/", "-"), "[()]", "")
    x = F.regexp_replace(F.regexp_replace(x, "[^0-9A-Za-z가-힣-]+", "-"), "-{2,}", "-")
    x = F.substring(F.lower(F.regexp_replace(x, "^-+|-+$", "")), 1, longest)
    return F.coalesce(F.nullif(x, F.lit("")), F.lit("entry"))


def page_label(c: Column) -> Column:
    """The printed label of a line such as ``- xii -``, roman ones in lower case; null for other lines."""
    return F.nullif(F.lower(F.regexp_extract(c, rules.PAGE_LABEL, 1)), F.lit(""))


def lines(c: Column) -> Column:
    """The non-empty normalised lines of a text."""
    return F.filter(F.transform(F.split(c, "\n"), normalize), lambda x: x != "")


def first_lines(c: Column, n: int = 12) -> Column:
    return F.slice(lines(c), 1, n)


def first_label(top: Column, within: int = 8) -> Column:
    """The first page label among the first lines."""
    return F.get(F.filter(F.transform(F.slice(top, 1, within), page_label), lambda x: x.isNotNull()), F.lit(0))


def strip_labels(array: Column) -> Column:
    return F.filter(array, lambda x: ~x.rlike(rules.PAGE_LABEL))


def strip_headers(array: Column, patterns=rules.RUNNING_HEADERS, heading: str = rules.STRUCTURAL_HEADING, window: int = 6, ahead: int = 3) -> Column:
    """Lines without running headers, leading ``제``/number/``편`` triples, and early headings that come again soon."""
    kept = F.filter(array, lambda x: ~reduce(lambda a, b: a | b, (x.rlike(p) for p in patterns)))
    triple = lambda xs: (F.get(xs, F.lit(0)) == "제") & F.get(xs, F.lit(1)).rlike(r"^\d+$") & (F.get(xs, F.lit(2)) == "편")
    # each round of the fold drops one triple, so as many rounds as there are lines are enough
    kept = F.aggregate(kept, kept, lambda xs, _: F.when(F.coalesce(triple(xs), F.lit(False)), F.slice(xs, 4, F.greatest(F.size(xs) - 3, F.lit(0)))).otherwise(xs))
    repeated = lambda x, i: (i < window) & x.rlike(heading) & F.array_contains(F.slice(kept, i + 2, ahead), x)
    return F.filter(kept, lambda x, i: ~repeated(x, i))


def _head(pattern: str) -> str | None:
    """The character that whatever matches a pattern begins with; None where it is not plain to see."""
    flat, before = pattern, None
    while flat != before:
        before, flat = flat, re.sub(r"\([^()]*\)", "", flat)
    plain = pattern[:1].isalnum() and pattern[1:2] not in ("?", "*", "{") and not re.search(r"[|\[]|\\[()]", flat)
    return pattern[0] if plain else None


def repair(c: Column, table=rules.REPAIRS) -> Column:
    """Split words put together by ordered rules, applied again until nothing changes.

    A rule removes white space, so a text settles after as many rounds as it has words at most; a round that changed
    nothing is the last one that does any work.
    """
    if not table:
        return c
    hit = c.rlike("|".join(f"(?:{p})" for p, _ in table))
    if None not in (heads := sorted({_head(p) for p, _ in table}, key=str)):
        # rules are tried only on texts that have a character between the least and the greatest that one begins with
        hit = c.rlike(f"[{heads[0]}-{heads[-1]}]") & hit
    once = lambda x: reduce(lambda y, r: F.regexp_replace(y, r[0], r[1]), table, x)
    # a fold keeps the rules once in the plan; texts without a hit pass through
    start = F.struct(c.alias("text"), F.lit(False).alias("settled"))

    def step(acc, _):
        now = F.when(acc["settled"], acc["text"]).otherwise(once(acc["text"]))
        return F.transform(F.array(now), lambda x: F.struct(x.alias("text"), (x == acc["text"]).alias("settled")))[0]

    rounds = F.sequence(F.lit(1), F.regexp_count(c, F.lit(WS + "+")) + 1)
    return F.when(hit, F.aggregate(rounds, start, step, lambda acc: acc["text"])).otherwise(c)


def for_search(c: Column) -> Column:
    """The index's normal form: normalised and repaired."""
    return repair(normalize(F.coalesce(c, F.lit(""))))


def for_matching(c: Column) -> Column:
    """The reader's normal form: no middle dots, no white space, lower case."""
    return F.lower(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)[·․\s]+", ""))


def excerpt(c: Column, limit: int = 160) -> Column:
    return F.when(F.length(c) <= limit, c).otherwise(F.concat(F.rtrim(F.substring(c, 1, limit - 1)), F.lit("…")))


def compact(c: Column, longest: int = 120) -> Column:
    """The text without guide dots; if it is too long, its first sentence if that fits, else clipped at a late word's end.

    A sentence ends with its mark, or with the syllable 다 or 요 before a full stop. Null is empty.
    """
    x = F.trim(F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), "[·․]+", " "), WS + "+", " "))
    head = F.substring(x, 1, longest)
    ahead = F.length(F.regexp_extract(x, r"^(.*?)(?:[.!?]\s|[다요]\.\s)", 1))
    last = F.length(head) - F.locate(" ", F.reverse(head))
    clipped = F.when((F.locate(" ", F.reverse(head)) > 0) & (last >= longest * 0.6), F.substr(head, F.lit(1), last)).otherwise(head)
    return F.when(F.length(x) <= longest, x).when((ahead > 0) & (ahead + 1 <= longest), F.trim(F.substr(x, F.lit(1), ahead + 1))).otherwise(F.concat(F.rtrim(clipped), F.lit("…")))


def escape_html(c: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def paragraph_html(c: Column) -> Column:
    return F.concat(F.lit("<p>"), escape_html(c), F.lit("</p>"))


def paragraphs(array: Column, least: int = 420) -> Column:
    """Lines gathered into paragraphs that end once they have ``least`` characters."""
    empty = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open"))

    def step(acc, line):
        now = F.when(acc["open"] == "", line).otherwise(F.concat(acc["open"], F.lit(" "), line))
        full = F.length(now) >= least
        return F.struct(F.when(full, F.concat(acc["done"], F.array(now))).otherwise(acc["done"]).alias("done"), F.when(full, F.lit("")).otherwise(now).alias("open"))

    return F.aggregate(array, empty, step, lambda acc: F.when(acc["open"] == "", acc["done"]).otherwise(F.concat(acc["done"], F.array(acc["open"]))))


def split_label(c: Column, pattern: str) -> tuple[Column, Column]:
    """(label, rest) by a pattern of two groups; the value for both where it does not match."""
    hit = c.rlike(pattern)
    return F.when(hit, F.regexp_extract(c, pattern, 1)).otherwise(c), F.when(hit, F.regexp_extract(c, pattern, 2)).otherwise(c)


def classify(haystack: Column, classes=rules.CATEGORIES, part: Column | None = None) -> Column:
    """The names of the classes with a keyword in the text, in the classes' order."""
    hit = lambda words: reduce(lambda a, b: a | b, (F.contains(haystack, F.lit(w)) for w in words))
    marks = [F.when(hit(words), F.lit(name)) for name, words in classes]
    if part is not None:
        marks.append(F.when(F.contains(part, F.lit(rules.APPENDIX_PART)), F.lit("appendix")))
    return F.array_distinct(F.array_compact(F.array(*marks)))


def tokens(c: Column, pattern: str = rules.TOKEN) -> Column:
    return F.regexp_extract_all(c, F.lit(f"({pattern})"), 1)


def locator(start: Column, end: Column) -> Column:
    """``start-end``, one number, or ``-``."""
    s, e = start.cast("string"), end.cast("string")
    return F.when(start.isNull() & end.isNull(), "-").when(start.isNull(), e).when(end.isNull() | (start == end), s).otherwise(F.concat_ws("-", s, e))


def route(chapter: Column, section: Column | None = None) -> Column:
    """``#/chapter/<chapter>[/<section>]``; null without a chapter, no section for the overview."""
    chapter = F.nullif(chapter, F.lit(""))
    base = F.concat(F.lit("#/chapter/"), chapter)
    if section is None:
        return base
    own = F.nullif(F.nullif(section, F.lit("")), F.lit("overview"))
    return F.concat(base, F.coalesce(F.concat(F.lit("/"), own), F.lit("")))


def encode_uri(c: Column) -> Column:
    """A path segment as browsers encode it."""
    out = F.url_encode(c)
    for a, b in (("+", "%20"), ("%21", "!"), ("%7E", "~"), ("%27", "'"), ("%28", "("), ("%29", ")")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def composite_key(*fields: Column) -> Column:
    return F.concat_ws("::", *(for_matching(f) for f in fields))


def cells(c: Column) -> Column:
    """The non-empty trimmed cells of a table row."""
    return F.filter(F.transform(F.split(c, rules.TABLE_CELLS), lambda x: F.trim(x)), lambda x: x != "")


def encoded(c: Column) -> Column:
    """A nested value as JSON text with its nulls."""
    return F.to_json(c, {"ignoreNullFields": "false"})


def display(c: Column, labels: dict[str, str]) -> Column:
    """A code's label, or the code itself."""
    table = F.create_map(*(F.lit(x) for pair in labels.items() for x in pair))
    return F.coalesce(F.element_at(table, c), c)


def has_residue(words: Column, test) -> Column:
    """Whether neighbours in an array meet ``test(left, right)``."""
    left, right = F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0)))
    return F.coalesce(F.exists(F.zip_with(left, right, test), lambda x: x), F.lit(False))


def _verdicts(o, left, right):
    """(test, whether two Hangul words are one) in the order in which the tests decide; ``o`` says how values are tested."""
    suffixes = (*rules.SUFFIX_TOKENS, *rules.SUFFIX_PREFIXES)
    alone, long = o.among(left, rules.LEFT_STANDALONE), o.size(left) >= 2
    head, rest = o.first(right), o.rest(right)
    return (
        (o.among(right, suffixes) | o.among(head, rules.COMPOUND_TAILS) & o.among(rest, suffixes), o.no(alone)),
        (long & o.among(head, ("자",)) & o.among(rest, suffixes) | o.among(o.last(left), ("으",)) & o.among(head, ("로",)), True),
        (alone | o.among(right, rules.RIGHT_STANDALONE) | long & o.among(o.last(left), rules.PARTICLE_ENDINGS), False),
        (o.among(left, rules.COMPOUND_HEADS) & (o.size(right) >= 3) | o.among(right, rules.COMPOUND_TAILS), True),
    )


class _Columns:
    """Tests on Columns."""

    among = staticmethod(lambda c, words: c.isin(*words))
    size = staticmethod(F.length)
    first = staticmethod(lambda c: F.substring(c, 1, 1))
    rest = staticmethod(lambda c: F.substring(c, 2, 20))
    last = staticmethod(lambda c: F.substring(c, -1, 1))
    no = staticmethod(lambda c: ~c)


class _Words:
    """The same tests on strings."""

    among = staticmethod(lambda c, words: c in words)
    size = staticmethod(len)
    first = staticmethod(lambda c: c[:1])
    rest = staticmethod(lambda c: c[1:])
    last = staticmethod(lambda c: c[-1:])
    no = staticmethod(lambda c: not c)


def residue_pair(left: Column, right: Column) -> Column:
    """Whether two Hangul words are likely one that a line break has split."""
    rule = F.lit(False)
    for test, verdict in reversed(_verdicts(_Columns, left, right)):
        rule = F.when(test, verdict).otherwise(rule)
    return left.rlike("^[가-힣]+$") & right.rlike("^[가-힣]+$") & (F.length(left) + F.length(right) <= 8) & rule


def linebreak_residue(c: Column) -> Column:
    """Whether a text has neighbouring words that a line break has split, or a reference torn from its law."""
    return has_residue(F.split(normalize(c), " "), lambda a, b: residue_pair(a, b) | F.startswith(b, F.lit("§")))


_HANGUL = re.compile("[가-힣]+")
_REPAIRS = [(re.compile(p), r) for p, r in rules.REPAIRS]


def _one_word(left: str, right: str) -> bool:
    """``residue_pair`` for two words outside Spark."""
    if not left or not right or len(left) + len(right) > 8:
        return False
    return next((verdict for test, verdict in _verdicts(_Words, left, right) if test), False)


def repaired(x: str) -> str:
    """``repair`` outside Spark."""
    before = None
    while before != x and _HANGUL.search(x):  # the rules are about Hangul words
        before = x
        for p, r in _REPAIRS:
            x = p.sub(r, x)
    return x


def bookmark_title(x: str) -> str:
    """``clean_title`` of a bookmark outside Spark."""
    return " ".join(re.sub("[\0․ㆍ·]", " ", x).split()).replace(" ,", ",")


def _joined(segments: list[str] | None) -> str | None:
    if segments is None:
        return None
    out: list[str] = []
    tail = ""  # the last characters so far: all that a join looks at
    for segment in (" ".join(s.replace("\0", " ").split()) for s in segments if s):
        if not segment:
            continue
        # the Hangul that touches the break: up to six before it and ten behind it
        left, right = re.search("[가-힣]{0,6}$", tail)[0], re.match("[가-힣]{0,10}", segment)[0]
        cited = re.match(r"§[0-9A-Za-z().-]", segment) and re.search("[0-9A-Za-z가-힣]$", tail)
        out += [segment] if not out or cited or _one_word(left, right) else [" ", segment]
        tail = "".join(out[-12:])[-6:]
    return repaired("".join(out))


def join_segments(array: Column, repair_each: bool = False) -> Column:
    """Segments of a paragraph joined: references and split words without a space, others with one, then repaired.

    Each join looks at the words that earlier joins have made, so this runs over Arrow batches. Blank and null segments
    are passed over; a null array stays null. ``repair_each`` repairs segments before they are joined as well.
    """
    each = (lambda x: [repaired(s) for s in x if s]) if repair_each else list

    def run(column: pd.Series) -> pd.Series:
        return pd.Series([_joined(each(x) if x is not None else None) for x in column], dtype=object)

    return F.pandas_udf(run, "string")(array)


@lru_cache(maxsize=4096)
def _solid(title: str | None) -> str:
    """A title without separators."""
    return re.sub(r"[\s․ㆍ·]+", "", title or "")


def _separates(c: str) -> bool:
    return c in "․ㆍ·" or c.isspace()


def behind_separators(text: str, at: int) -> int:
    """The place of the first character from ``at`` on that separates no words; the text's length if there is none."""
    while at < len(text) and _separates(text[at]):
        at += 1
    return at


def _behind(text: str, at: int, solid: str) -> int:
    """Where a title that starts at ``at`` ends, whatever separators are in it; -1 if it is not there as whole words."""
    if not text.startswith(solid[0], at):
        return -1
    for c in solid:
        at = behind_separators(text, at)
        if not text.startswith(c, at):
            return -1
        at += 1
    return at if at == len(text) or _separates(text[at]) else -1


def _trim_headings(text: str | None, titles: list[str] | None) -> str | None:
    # no pattern is made: titles differ by row, and compiling one takes longer than any text
    solid = sorted({_solid(t) for t in titles or ()} - {""}, key=lambda t: (-len(t), t))
    if text is None or not solid:
        return text
    at = 0
    while True:
        start = behind_separators(text, at)
        end = next((e for t in solid if (e := _behind(text, start, t)) >= 0), None)
        if end is None:
            return text[at:]
        at = behind_separators(text, end)


def trim_headings(text: Column, titles: Column) -> Column:
    """The text without titles repeated at its start, whatever separators they are written with."""

    def run(text: pd.Series, titles: pd.Series) -> pd.Series:
        return pd.Series([_trim_headings(a, list(b) if b is not None else []) for a, b in zip(text, titles, strict=True)], dtype=object)

    return F.pandas_udf(run, "string")(text, titles)


def python_round(c: Column, digits: int = 1) -> Column:
    """Rounds doubles to the nearest decimal of their exact binary value, halves to even.

    The scaled value is kept as a product and its rounding error (Dekker 1971), so a tie is a tie of the exact value.
    """
    scale = F.lit(float(10**digits))
    x = c.cast("double")
    big = x * F.lit(134217729.0)
    high = big - (big - x)
    product = x * scale
    error = (high * scale - product) + (x - high) * scale
    whole = F.floor(product).cast("double")
    over = (product - whole - 0.5) + error
    # an error may reach below the floor's own whole number
    down, up = F.when((product == whole) & (error < -0.5), whole - 1).otherwise(whole), whole + 1
    even = F.when(whole % 2 == 0, whole).otherwise(up)
    rounded = F.when(over > 0, up).when(over < 0, down).otherwise(even) / scale
    # whole numbers, infinities and NaN are what they are
    return F.when(F.isnan(x) | (F.abs(x) >= 2.0**52), x).otherwise(rounded)
