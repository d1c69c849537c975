"""Layout extractors made of built-in expressions: text or HTML to the parse result (VARIANT).

They are what a parse step calls per document, with no Python in the tasks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

# Boxes of the text layout, in pixels: where lines start, how far apart and how high they are, and
# the size of a page.
LEFT, TOP, LINE_STEP, LINE_HEIGHT, MAX_LINE_WIDTH = 50, 40, 60, 40, 500
PAGE_WIDTH, PAGE_HEIGHT = 612, 792

# The HTML parts that become elements, in any case of letters. A table is taken whole, up to its own end, so what it
# holds does not become elements (ends of inner tables are marked before the search); there is no backreference, so any
# other part ends at the first closing tag of any kind.
HTML_PARTS = (
    r"(?is)<table(?:\s[^>]*)?>.*?</table>"
    r"|<(?:title|h1|p|li|footer)(?:\s[^>]*)?>.*?</(?:title|h1|p|li|footer|table)>|<img(?:\s[^>]*)?>"
)

# A stretch of a page up to its next table tag or its end, and the tags alone.
_TABLE_PIECE = r"(?is).*?(?:<table(?:\s[^>]*)?>|</table>|\z)"
_TABLE_TAG = r"(?i)(<table(?:\s[^>]*)?>|</table>)\z"
# Set before the ">" of an end tag or after the "<" of a start tag; not a character of text. Tags that hold it get one more.
_MARK = "\ufdd0"

# What every rule about tables asks for; pages without it take none of them.
_ANY_TABLE = f"(?i)<[/{_MARK}]*table"

_TITLES = ("title", "h1")


def box(page_id: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """A bounding box of the parse result."""
    return F.struct(page_id.cast("int").alias("page_id"), F.array(*[c.cast("int") for c in (x1, y1, x2, y2)]).alias("coord"))


def payload(elements: Column, pages: Column, errors: Column) -> Column:
    """The parse result from an array of element structs, one of page structs and one of error structs."""
    document = F.struct(elements.alias("elements"), pages.alias("pages"))
    return F.to_variant_object(F.struct(document.alias("document"), errors.alias("error_status")))


def no_errors() -> Column:
    return F.array().cast("array<struct<page_id:int>>")


def _pages(last_page: Column) -> Column:
    return F.transform(
        F.sequence(F.lit(0), last_page.cast("int")),
        lambda p: F.struct(
            p.alias("id"),
            F.lit(None).cast("string").alias("image_uri"),
            F.lit(PAGE_WIDTH).alias("width"),
            F.lit(PAGE_HEIGHT).alias("height"),
        ),
    )


def layout_from_text(text: Column, lines_per_page: int = 12, errors: Column | None = None) -> Column:
    """Each line an element, the first the title, ``lines_per_page`` to a page, boxes by line."""

    def element(line: Column, at: Column) -> Column:
        row = at % lines_per_page
        top = F.lit(TOP) + row * LINE_STEP
        right = F.lit(LEFT) + F.least(F.length(line), F.lit(MAX_LINE_WIDTH))
        return F.struct(
            at.alias("id"),
            F.when(at == 0, "title").otherwise("text").alias("type"),
            line.alias("content"),
            F.array(box(F.floor(at / lines_per_page), F.lit(LEFT), top, right, top + LINE_HEIGHT)).alias("bbox"),
        )

    def document(lines: Column) -> Column:
        last_page = F.floor((F.size(lines) - 1) / lines_per_page)
        return payload(F.transform(lines, element), _pages(last_page), no_errors() if errors is None else errors)

    return bound(F.split(text, "\n"), document)


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` mentions it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _inner_tables_marked(html: Column) -> Column:
    """The page with marks in the end tags of tables inside other whole tables, and in the start tags of tables without an end."""

    def folded(changes: Column, opening: int) -> Column:
        """For each change its depth, and 0 for what is not paired, counted from the side of the ``opening`` tags."""

        def step(state: Column, change: Column) -> Column:
            depth = F.greatest(state["depth"] + change * opening, F.lit(0))
            paired = F.when(change == opening, depth).otherwise(state["depth"])
            return F.struct(depth.alias("depth"), F.concat(state["levels"], F.array(F.when(change == 0, 0).otherwise(paired))).alias("levels"))

        start = F.struct(F.lit(0).alias("depth"), F.array().cast("array<int>").alias("levels"))
        return F.aggregate(changes, start, step, lambda state: state["levels"])

    def change(piece: Column) -> Column:
        tag = F.lower(F.regexp_extract(piece, _TABLE_TAG, 1))
        return F.when(tag == "", 0).when(tag == "</table>", -1).otherwise(1)

    def marked(pieces: Column) -> Column:
        def join(changes: Column) -> Column:
            # Ends without a start count for nothing; the rest, from the back, tells how deep an end stands in whole tables.
            own = F.zip_with(changes, folded(changes, 1), lambda c, level: F.when(level > 0, c).otherwise(0))
            inside = bound(own, lambda c: F.reverse(folded(F.reverse(c), -1)))
            inner = F.zip_with(own, inside, lambda c, level: (c == -1) & (level > 1))
            open_ended = F.zip_with(own, inside, lambda c, level: (c == 1) & (level == 0))
            ends = F.zip_with(pieces, inner, lambda p, at: F.when(at, F.regexp_replace(p, r"(?i)(</table)>\z", f"$1{_MARK}>")).otherwise(p))
            starts = F.zip_with(ends, open_ended, lambda p, at: F.when(at, F.regexp_replace(p, r"(?i)<(table(?:\s[^>]*)?>)\z", f"<{_MARK}$1")).otherwise(p))
            return F.array_join(starts, "")

        return bound(F.transform(pieces, change), join)

    raised = F.regexp_replace(html, f"(?i)(</table{_MARK}+)>", f"$1{_MARK}>")
    raised = F.regexp_replace(raised, rf"(?i)<({_MARK}+table[\s>])", f"<{_MARK}$1")
    nested = F.exists(F.regexp_extract_all(html, F.lit(r"(?is)<table(?:\s[^>]*)?>.*?</table>"), F.lit(0)), lambda t: F.regexp_count(t, F.lit(r"(?i)<table[\s>]")) > 1)
    return F.when(nested, bound(F.regexp_extract_all(raised, F.lit(_TABLE_PIECE), F.lit(0)), marked)).otherwise(raised)


def _unmarked(text: Column) -> Column:
    text = F.regexp_replace(text, f"(?i)(</table{_MARK}*){_MARK}>", "$1>")
    return F.regexp_replace(text, rf"(?i)<{_MARK}({_MARK}*table[\s>])", "<$1")


def html_parts(html: Column) -> Column:
    """``array<struct<tag, body>>`` of the parts of a page, in order; an image's body is NULL.

    One search over the page finds the parts; tag and body are cut out of each part. An opening tag
    holds no ``>`` before its end, and the closing one starts at the last ``</``.
    """

    tables = F.rlike(html, F.lit(_ANY_TABLE))

    def part(found: Column, has_tables: Column) -> Column:
        tag = F.lower(F.regexp_extract(found, r"(?i)\A<([a-z0-9]+)", 1))
        start = F.instr(found, ">") + 1
        length = F.length(found) - F.length(F.substring_index(found, "</", -1)) - 1 - start
        inner = F.substring(found, start, length)
        body = F.when(tag != "img", F.when(has_tables, _unmarked(inner)).otherwise(inner))
        return F.struct(tag.alias("tag"), body.alias("body"))

    def parts(has_tables: Column) -> Column:
        page = F.when(has_tables, _inner_tables_marked(html)).otherwise(html)
        return F.transform(F.regexp_extract_all(page, F.lit(HTML_PARTS), F.lit(0)), lambda found: part(found, has_tables))

    return bound(tables, parts)


def html_element_type(tag: Column) -> Column:
    return (
        F.when(tag.isin(*_TITLES), "title")
        .when(tag == "img", "figure")
        .when(tag.isin("table", "footer"), tag)
        .otherwise("text")
    )


def layout_from_html(html: Column, parts_per_page: int = 12, errors: Column | None = None) -> Column:
    """Titles, paragraphs, list items, tables (kept as HTML), images and footers as elements."""

    def element(part: Column, at: Column) -> Column:
        top = F.lit(TOP) + at % parts_per_page * LINE_STEP
        width = F.coalesce(F.least(F.length(part["body"]), F.lit(MAX_LINE_WIDTH)), F.lit(MAX_LINE_WIDTH))
        as_html = F.concat(F.lit("<table>"), part["body"], F.lit("</table>"))
        return F.struct(
            at.alias("id"),
            html_element_type(part["tag"]).alias("type"),
            F.when(part["tag"] == "table", as_html).otherwise(part["body"]).alias("content"),
            F.array(
                box(F.floor(at / parts_per_page), F.lit(LEFT), top, F.lit(LEFT) + width, top + LINE_HEIGHT)
            ).alias("bbox"),
        )

    def document(parts: Column) -> Column:
        last_page = F.floor(F.greatest(F.size(parts) - 1, F.lit(0)) / parts_per_page)
        return payload(F.transform(parts, element), _pages(last_page), no_errors() if errors is None else errors)

    return bound(html_parts(html), document)
