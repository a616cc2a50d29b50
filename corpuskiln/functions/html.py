"""HTML to text by built-in expressions: what isn't shown goes, blocks end lines, character references are resolved."""

from __future__ import annotations

from functools import lru_cache, reduce
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpuskiln.functions import text as T
from corpuskiln.functions.masking import replaced

#: Elements that are never shown, and those that a reader of the running text doesn't want.
HIDDEN = ["script", "style", "noscript", "template"]
BESIDE = ["nav", "header", "footer", "aside", "form", "table"]
#: Elements that stand on lines of their own.
BLOCKS = ["address", "article", "aside", "blockquote", "body", "br", "dd", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h[1-6]", "head", "header", "hr", "html", "li", "main", "nav", "ol", "option", "p", "pre", "section", "table", "td", "th", "title", "tr", "ul"]
COMMENT, TAG = r"(?s)<!--.*?(?:-->|$)", r"(?s)<[a-zA-Z/!?][^>]*(?:>|$)"
BLOCK = rf"(?is)</?(?:{'|'.join(BLOCKS)})(?:[\s/][^>]*)?>"


def element(name: str) -> str:
    """An element with all it holds, to the end of the page if it isn't closed."""
    return rf"(?is)<{name}(?:[\s/][^>]*)?>.*?(?:</{name}[^>]*>|$)"


@lru_cache(maxsize=1)
def names() -> dict[str, str]:
    """The standard library's named characters."""
    return {k: chr(v) for k, v in name2codepoint.items()}


def resolved(text: Column) -> Column:
    """Named and numeric character references as characters; unknown ones as they are."""
    table = F.create_map(*[F.lit(x) for pair in sorted(names().items()) for x in pair])
    named = lambda p: F.coalesce(F.try_element_at(table, F.regexp_extract(p, "[a-zA-Z0-9]+", 0)), p)
    digits = lambda p: F.regexp_extract(p, "[0-9a-fA-F]+", 0)
    code = lambda p: F.when(p.rlike("^&#[xX]"), digits(p)).otherwise(F.hex(F.regexp_extract(p, "[0-9]+", 0).cast("bigint")))
    valid = lambda c: (F.length(c) <= 6) & (F.conv(c, 16, 10).cast("bigint") < 0x110000) & (F.conv(c, 16, 10).cast("bigint") > 0) & ~c.rlike("^0*[dD][89a-fA-F][0-9a-fA-F]{2}$")
    number = lambda p: F.when(valid(code(p)), F.decode(F.unhex(F.lpad(code(p), 8, "0")), "UTF-32")).otherwise(p)
    both = lambda p: F.when(p.startswith("&#"), number(p)).otherwise(named(p))
    return F.when(text.contains("&"), replaced(text, "&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z][a-zA-Z0-9]{1,31});?", both)).otherwise(text)


def without_open_tag(html: Column) -> Column:
    """html less a tag that isn't closed at its end: with it gone, every other one finds its bracket at once."""
    closed = F.regexp_extract(html, "(?s)^.*>", 0)
    return F.concat(closed, F.regexp_replace(F.substr(html, F.length(closed) + 1), "(?s)<[a-zA-Z/!?].*", ""))


def shown(html: Column, beside=()) -> Column:
    """html without comments, elements that are never shown and those named; runs of white space are one space."""
    out = reduce(lambda c, e: F.regexp_replace(c, element(e), ""), [*HIDDEN, *beside], without_open_tag(F.regexp_replace(html, COMMENT, "")))
    return F.regexp_replace(out, f"[{T.P.SPACES}]+", " ")


def html_text(html, extractor: str = "plain") -> Column:
    """Text of a page, a line a block. extractor: ``plain`` for all that is shown, ``main`` without what stands
    beside the running text (menus, heads, feet, forms, tables)."""
    if extractor not in ("plain", "main"):
        raise ValueError(f"no extractor {extractor}")
    out = F.regexp_replace(shown(T._col(html), BESIDE if extractor == "main" else []), BLOCK, "\n")
    return T.line_spaces(resolved(F.regexp_replace(out, TAG, "")))


def html_aware_paragraphs(text) -> Column:
    """Paragraphs at blank lines; where a text holds HTML, the lines of what is shown."""
    c = T._col(text)
    plain = F.filter(F.split(c, "\n\n+"), lambda p: p != "")
    return F.when(T.has_html(c), F.filter(F.split(html_text(c), "\n"), lambda p: p != "")).otherwise(plain)
