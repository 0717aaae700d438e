"""Stored web pages -> table rows (S2, S3, J7 with C7-C9).

The reference downloads one stat page per season and walks its DOM on one
machine.  Here pages already sit in a table (page_id, url, html) and are cut
into rows with regular expressions, per row, on the executors; fetching over
HTTP is left to whatever loads that table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crease.functions import soft_cast, strip_brackets

# Patterns of our own.  A navigation item: a list item that holds one link, whatever
# other attributes the two have.  Groups: the target and the text.
ITEM_RE = r'<li[^>]*><a [^>]*?href="([^"]*)"[^>]*>([^<]*)</a></li>'
# A table row, and what its data and header cells hold.
ROW_RE = r"(?is)<tr[^>]*>(.*?)</tr>"
CELL_RE = r"(?is)<td[^>]*>(.*?)</td>"
HEAD_RE = r"(?is)<th[^>]*>(.*?)</th>"
TAG_RE = r"<[^>]*>"
HOST_RE = r"^[a-z]+://([^/?#]+)"
LANG_RE = r"^[a-z]+://[^/?#]+/([a-z]+)/"
SEASON_RE = r"^[a-z]+://[^/?#]+[^?#]*?[/-]([0-9]+)"   # first number after / or - in the path
TRAIL_RE = r"\s+$"          # trailing whitespace, newline included


def url_catalog(pages: DataFrame, url: str = "url") -> DataFrame:
    """Host, language folder and season number of every page URL (S2 + C9).

    The season comes from the number in the path, not from the line order of
    a URL list (a distributed read keeps no line order).
    """
    u = F.regexp_replace(F.col(url), TRAIL_RE, "")
    return pages.select(
        "page_id", u.alias("url"),
        F.regexp_extract(u, HOST_RE, 1).alias("host"),
        F.regexp_extract(u, LANG_RE, 1).alias("lang"),
        season_of(url).alias("season"))


def read_url_list(spark, path: str) -> DataFrame:
    """A text file of URLs, one per line, as a (page_id, url) table."""
    lines = (spark.read.text(path).select(F.regexp_replace("value", TRAIL_RE, "").alias("url"))
             .filter(F.col("url") != ""))
    return lines.withColumn("page_id", F.xxhash64("url"))


def season_list(spark, path: str, newest: int = 2018) -> DataFrame:
    """A list of URLs, one per line, newest season first: ``position, url, season``, where the
    season is ``newest`` less the line's place in the list (S2).  Blank lines have a place but no row."""
    from crease.sources.files import text_lines
    lines = text_lines(spark, path).select("position", F.regexp_replace("value", TRAIL_RE, "").alias("url"))
    return lines.where("url <> ''").withColumn("season", F.lit(newest) - F.col("position"))


def season_of(url: str | Column = "url") -> Column:
    """Season number in the path of a page's URL (C9); NULL when there is none."""
    u = F.regexp_replace(F.col(url) if isinstance(url, str) else url, TRAIL_RE, "")
    return F.nullif(F.regexp_extract(u, SEASON_RE, 1), F.lit("")).try_cast("int")


def _cells(row: Column, cell_re: str) -> Column:
    """Texts of the cells of a row: inner tags dropped, white space trimmed."""
    return F.transform(F.regexp_extract_all(row, F.lit(cell_re), 1),
                       lambda c: F.trim(F.regexp_replace(c, TAG_RE, "")))


def html_rows(pages: DataFrame, row_re: str = ROW_RE, cell_re: str = CELL_RE, html: str = "html") -> DataFrame:
    """Rows of every page: ``page_id, pos, cells`` (S3).

    ``row_re`` finds the rows and ``cell_re`` the cells of one; group 1 is what each
    holds.  Rows without a cell (such as a header row) are not counted.  ``pos`` is
    0-based.  NULL html: no rows.
    """
    rows = F.transform(F.regexp_extract_all(F.col(html), F.lit(row_re), 1), lambda r: _cells(r, cell_re))
    kept = pages.select("page_id", F.filter(rows, lambda c: F.size(c) > 0).alias("_rows"))
    return kept.select("page_id", F.posexplode("_rows").alias("pos", "cells"))


# ---- elements chosen by tag and class, nested ones told apart

# What is not markup: comments, scripts and style sheets.
UNSEEN_RE = r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>"
# what stands in a tag up to its end: quoted values may hold the sign, unless a quote is never closed
_ATTRS = r"""(?:(?:[^>"']|"[^"]*"|'[^']*')*+(?=>)|[^>]*+)"""
_NO, _HELD = "\x01", "\x02"          # around an element's number: in its own tag; where it stood in the one around it


def _innermost(tag: str) -> str:
    """A numbered element that holds no other of its tag.  Groups: number, attributes, content."""
    return (rf"(?is)<{tag}{_NO}(\d+){_NO}({_ATTRS})>([^<]*+(?:<(?!/?{tag}[\s>/{_NO}])[^<]*+)*+)</{tag}\s*>")


def _found(html: Column, tag: str) -> Column:
    """Every element of a tag as text, nested ones cut out of those around them.

    Opening tags are numbered in the page's order.  Then, as often as the page nests
    the tag, the elements that hold no other are taken out and leave their numbers
    behind, which makes the next ones innermost.
    """
    inner = _innermost(tag)
    clean = F.regexp_replace(F.translate(html, _NO + _HELD, ""), UNSEEN_RE, "")
    parts = F.split(clean, rf"(?i)<{tag}(?=[\s>/])")
    numbered = F.array_join(F.transform(parts, lambda p, i: F.when(i == 0, p).otherwise(
        F.concat(F.lit(f"<{tag}{_NO}"), (i - 1).cast("string"), F.lit(_NO), p))), "")
    tags = F.regexp_extract_all(numbered, F.lit(rf"(?i)<(/?){tag}[\s>/{_NO}]"), 1)
    depth = F.aggregate(tags, F.struct(F.lit(0).alias("now"), F.lit(0).alias("most")), lambda a, t: F.struct(
        F.when(t == "", a["now"] + 1).otherwise(F.greatest(a["now"] - 1, F.lit(0))).alias("now"),
        F.greatest(a["most"], F.when(t == "", a["now"] + 1).otherwise(0)).alias("most")))["most"]
    steps = F.when(depth > 0, F.sequence(F.lit(1), depth)).otherwise(F.array().cast("array<int>"))
    start = F.struct(numbered.alias("html"), F.array().cast("array<string>").alias("found"))
    return F.aggregate(steps, start, lambda a, _: F.struct(
        F.regexp_replace(a["html"], inner, f" {_HELD}$1{_HELD} ").alias("html"),
        F.concat(a["found"], F.regexp_extract_all(a["html"], F.lit(inner), 0)).alias("found")))["found"]


def elements(pages: DataFrame, tag: str = "table", classed: str | None = None, html: str = "html",
             keep: list[str] | tuple = ()) -> DataFrame:
    """Elements of a tag (S3): ``page_id, <keep>, element, classes, holds, content``.

    ``element`` numbers the page's opening tags of that tag from 0; ``content`` lacks nested
    elements of the tag, which are rows of their own, named in ``holds`` by their
    numbers.  ``classed`` picks the elements that have the class.  Comments, scripts and style sheets
    are not searched.  An element that is never closed is left out, what it holds is not; a
    stray end tag closes nothing.  NULL or empty html: no elements.  Nothing is shuffled.
    """
    inner = _innermost(tag)
    x = pages.select("page_id", *keep, F.explode(_found(F.coalesce(F.col(html), F.lit("")), tag)).alias("_e"))
    part = lambda i: F.regexp_extract("_e", inner, i)
    named = F.regexp_extract_all(part(2), F.lit(r"""(?i)(?:^|\s)class\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""), 1)
    classes = F.filter(F.split(F.translate(F.coalesce(F.get(named, F.lit(0)), F.lit("")), "\"'", ""), r"\s+"), lambda c: c != "")
    holds = F.transform(F.regexp_extract_all(part(3), F.lit(rf"{_HELD}(\d+){_HELD}"), 1), lambda n: n.cast("int"))
    x = x.select("page_id", *keep, part(1).cast("int").alias("element"), classes.alias("classes"), holds.alias("holds"),
                 part(3).alias("content"))
    return x if classed is None else x.where(F.array_contains("classes", classed))


def element_text(content: str | Column = "content") -> Column:
    """What an element says itself: tags and nested elements dropped, white space trimmed."""
    c = F.col(content) if isinstance(content, str) else content
    own = F.regexp_replace(c, rf"\s?{_HELD}\d+{_HELD}\s?", "")
    return F.trim(F.regexp_replace(own, rf"</?[a-zA-Z]{_ATTRS}>", ""))


def _section_rows(content: Column, row_tag: str, cell_tags: tuple[str, ...]) -> Column:
    """Rows of a section: structs (all its cells are heading cells, cells)."""
    end = rf"(?=</?{row_tag}[\s>]|</?(?:thead|tbody|tfoot)[\s>]|\z)"
    any_cell = "|".join(cell_tags)
    rows = F.regexp_extract_all(content, F.lit(rf"(?is)<{row_tag}(?=[\s>]){_ATTRS}>(.*?){end}"), 1)
    cells = lambda r: F.transform(F.regexp_extract_all(
        r, F.lit(rf"(?is)<(?:{any_cell})(?=[\s>]){_ATTRS}>(.*?)(?=</?(?:{any_cell})[\s>]|\z)"), 1), element_text)
    return F.filter(F.transform(rows, lambda r: F.struct(
        (~r.rlike(rf"(?i)<(?!th[\s>])(?:{any_cell})[\s>]")).alias("heads"), cells(r).alias("cells"))), lambda r: F.size(r["cells"]) > 0)


def _sections(content: Column, row_tag: str, cell_tags: tuple[str, ...]) -> Column:
    """All rows of an element in order of head, body and foot: structs (section, cells)."""
    span = lambda name: rf"(?is)<{name}(?=[\s>]){_ATTRS}>(.*?)(?=</{name}\s*>|<(?:thead|tbody|tfoot)[\s>]|\z)"
    held = lambda name: F.array_join(F.regexp_extract_all(content, F.lit(span(name)), 1), " ")
    rest = F.regexp_replace(F.regexp_replace(content, span("thead"), ""), span("tfoot"), "")
    rows = lambda c: _section_rows(c, row_tag, cell_tags)
    as_ = lambda r, name: F.transform(r, lambda x: F.struct(F.lit(name).alias("section"), x["cells"].alias("cells")))
    body = rows(rest)
    return F.concat(as_(rows(held("thead")), "head"), as_(F.filter(body, lambda r: r["heads"]), "head"),
                    as_(F.filter(body, lambda r: ~r["heads"]), "body"), as_(rows(held("tfoot")), "foot"))


def element_rows(pages: DataFrame, classed: str | None = None, tag: str = "table", row_tag: str = "tr",
                 cell_tags: tuple[str, ...] = ("td", "th"), html: str = "html", keep: list[str] | tuple = ()) -> DataFrame:
    """Rows of the chosen elements (S3): ``page_id, <keep>, element, section, pos, cells``.

    ``section`` is ``head`` for the rows of a ``thead`` and for rows of ``th`` cells alone, ``foot`` for
    those of a ``tfoot``, else ``body``; ``pos`` counts from 0 in each.  A nested table's rows are
    its own element's.  End tags of rows and cells may be missing; rows without cells are not counted.
    """
    x = elements(pages, tag, classed, html, keep)
    rows = _sections(F.col("content"), row_tag, cell_tags)
    numbered = F.transform(F.array(*[F.lit(n) for n in ("head", "body", "foot")]), lambda n: F.filter(F.col("_rows"), lambda r: r["section"] == n))
    x = x.select("page_id", *keep, "element", rows.alias("_rows"))
    x = x.select("page_id", *keep, "element", F.explode(numbered).alias("_rows"))
    return x.select("page_id", *keep, "element", F.posexplode("_rows").alias("pos", "_r")).select(
        "page_id", *keep, "element", F.col("_r.section").alias("section"), "pos", F.col("_r.cells").alias("cells"))


def element_pairs(pages: DataFrame, names: list[str], classed: str | None = None, tag: str = "table", html: str = "html",
                  url: str = "url") -> DataFrame:
    """Of the chosen tables, each body row that holds a player's figures with the team row after it (J7):
    ``page_id, element, pair``, the figures under ``names``, ``team`` without brackets, ``season``.

    Rows of the head are not paired, so a header does not shift the pairs; a last row
    without a team row has a NULL team.
    """
    x = elements(pages.withColumn("_season", season_of(url)), tag, classed, html, ["_season"])
    body = F.transform(F.filter(_sections(F.col("content"), "tr", ("td", "th")), lambda r: r["section"] == "body"), lambda r: r["cells"])
    x = x.select("page_id", "element", "_season", body.alias("_rows"))
    x = x.select("page_id", "element", "_season", F.posexplode(_pairs(F.col("_rows"))).alias("pair", "_p"))
    return x.select("page_id", "element", "pair", *[F.get(F.col("_p.stat"), F.lit(i)).alias(n) for i, n in enumerate(names)],
                    strip_brackets(F.get(F.col("_p.team"), F.lit(0))).alias("team"), F.col("_season").alias("season"))


def header_cells(pages: DataFrame, html: str = "html", head_re: str = HEAD_RE) -> DataFrame:
    """Header texts of every page in order: ``page_id, header``."""
    return pages.select("page_id", _cells(F.col(html), head_re).alias("header"))


def name_cells(rows: DataFrame, names: list[str], cells: str = "cells") -> DataFrame:
    """Cells to columns by position; a row with fewer cells has NULL in the rest."""
    others = [c for c in rows.columns if c != cells]
    return rows.select(*others, *[F.get(F.col(cells), F.lit(i)).alias(n) for i, n in enumerate(names)])


def table_pairs(pages: DataFrame, names: list[str], row_re: str = ROW_RE, cell_re: str = CELL_RE,
                html: str = "html", url: str = "url") -> DataFrame:
    """Tables that give each player a stat row and then a team row: ``page_id, pair``, the
    stat cells under ``names``, ``team`` without brackets, ``season``.

    A row is paired with the one after it inside the page's array, so nothing is
    shuffled; a last stat row without a team row has a NULL team.
    """
    rows = F.filter(F.transform(F.regexp_extract_all(F.col(html), F.lit(row_re), 1), lambda r: _cells(r, cell_re)),
                    lambda c: F.size(c) > 0)
    x = pages.select("page_id", season_of(url).alias("season"), rows.alias("_rows"))
    x = x.select("page_id", "season", F.posexplode(_pairs(F.col("_rows"))).alias("pair", "_p"))
    return x.select("page_id", "pair", *[F.get(F.col("_p.stat"), F.lit(i)).alias(n) for i, n in enumerate(names)],
                    strip_brackets(F.get(F.col("_p.team"), F.lit(0))).alias("team"), "season")


def _pairs(items: Column) -> Column:
    """Items 0 and 1, 2 and 3, ... as structs (stat, team); an odd last item has a NULL team."""
    starts = F.filter(F.sequence(F.lit(0), F.size(items)), lambda i: (i % 2 == 0) & (i < F.size(items)))
    return F.transform(starts, lambda i: F.struct(F.get(items, i).alias("stat"), F.get(items, i + 1).alias("team")))


def _texts(pattern: str, html: str) -> Column:
    return F.regexp_extract_all(F.col(html), F.lit(pattern), 2)


def link_rows(pages: DataFrame, pattern: str = ITEM_RE, html: str = "html", url: str | None = None) -> DataFrame:
    """Every match of a link pattern in a page, with its 0-based position: ``page_id, pos,
    href, text`` (groups 1 and 2), and with ``url`` the page's season (C9)."""
    season = [season_of(url).alias("season")] if url else []
    items = F.arrays_zip(F.regexp_extract_all(F.col(html), F.lit(pattern), 1).alias("href"),
                         _texts(pattern, html).alias("text"))
    x = pages.select("page_id", *season, items.alias("_items"))
    x = x.select("page_id", *x.columns[1:-1], F.posexplode("_items").alias("pos", "_item"))
    return x.select("page_id", "pos", F.col("_item.href").alias("href"), F.col("_item.text").alias("text"),
                    *(["season"] if url else []))


def pair_rows(pages: DataFrame, pattern: str = ITEM_RE, html: str = "html", url: str = "url") -> DataFrame:
    """Each stat item (even position) with the team item after it (J7), from link lists.

    The team loses its brackets (C8), the stat gets a numeric twin when it parses as
    a number (C7), and the page's season is added (C9).  Items are paired inside the
    page's array and the season comes in the same projection: no shuffle.
    """
    x = pages.select("page_id", season_of(url).alias("season"), _texts(pattern, html).alias("_items"))
    x = x.select("page_id", "season", F.posexplode(_pairs(F.col("_items"))).alias("pair", "_p"))
    return x.select("page_id", "pair", F.col("_p.stat").alias("stat"), soft_cast(F.col("_p.stat")).alias("stat_value"),
                    strip_brackets(F.col("_p.team")).alias("team"), "season")
