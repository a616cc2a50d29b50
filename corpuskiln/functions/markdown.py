"""Markdown to running text, by built-in expressions: a table of rules over lines and one over spans.

The rules cover what forum posts hold: headings, quotes, lists, rules, fences, tables, emphasis, code, links,
images, strikethrough, spoilers and escaped HTML. Text comes out as a reader would see it, without marks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpuskiln.functions import text as T

#: Marks at the start of lines, and lines that are nothing else. Groups are possessive, which takes no stack.
LINE_RULES = [
    (r"^ {0,3}(?:```|~~~).*$", ""), (r"^ {0,3}(?:[-*_] *+){3,}+$", ""), (r"^ {0,3}(?:=++|-++) *+$", ""),
]
HEADING, HEADING_END = r"^ {0,3}#{1,6} ++", r"(?<! ) ++#++$"
MORE_LINE_RULES = [(r"^(?: {0,3}> ?)++", ""), (r"^( *+)[*+-] ++", "$1* ")]
#: What the line under the head of a table consists of; both of the marks are there.
TABLE_RULE, TABLE_MARKS = r"^[| :-]*+$", "-|"


def spans(mark: str, end: str) -> tuple[str, str]:
    """A rule for spans between two marks of a line. Where an opening mark has no end, no later one of the line has: the
    rest of the line is then taken as it is, so that a line is gone through twice at most."""
    return rf"{mark}(?=\S)([^\n]+?)(?<=\S){end}|({mark}(?=\S)[^\n]*+)", "$1$2"


#: Marks around spans, the longer before the shorter. The second group of each takes what can't begin a span, as it is.
SPAN_RULES = [
    (r"!\[([^\]\n]*+)\]\([^)\n]*+\)|(!\[[^\]\n]*+(?:\](?!\()|\z|(?=\n)|\]\([^)\n]*+))", "$1$2"),
    (r"\[([^\]\n]++)\]\((?:[^()\n]++|\([^()\n]*+\))*+\)|(\[[^\]\n]++(?:\]\(?|\z|(?=\n)))", "$1$2"),
    (r"<(https?://[^>\s]++)>|(<https?://[^>\s]++)", "$1$2"), (r"(?<!`)`++([^`\n]++)`++", "$1"),
    spans(r"(?<!\\)\*\*\*", r"\*\*\*"), spans(r"(?<!\\)\*\*", r"\*\*"),
    (r"(?<![\\*])\*(?=[^\s*])([^*\n]+?)(?<=\S)\*(?!\*)", "$1"), spans(r"(?<![\p{L}\p{N}_\\])__", r"__(?![\p{L}\p{N}_])"),
    (r"(?<![\p{L}\p{N}_\\])_(?=\S)([^_\n]+?)(?<=\S)_(?![\p{L}\p{N}_])", "$1"), (r"<[/]?[a-zA-Z][^<>\n]*>", ""), (r"\\([\\`*_{}\[\]()#+.!|~>-])", "$1"),
]
#: Named characters of HTML that posts hold; &amp; comes last.
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&#x200B;", "​"), ("&amp;", "&")]


def _line(x: Column) -> Column:
    x = reduce(lambda c, r: F.regexp_replace(c, *r), LINE_RULES, x)
    x = F.when(x.rlike(HEADING), F.regexp_replace(F.regexp_replace(x, HEADING, ""), HEADING_END, "")).otherwise(x)
    x = reduce(lambda c, r: F.regexp_replace(c, *r), MORE_LINE_RULES, x)
    blanks = r"(?:(?<! )|\G) *+"  # begun where the blanks begin
    cells = F.regexp_replace(F.regexp_replace(x, rf"^ *+\| *+|{blanks}\| *+$", ""), rf"{blanks}\| *+", "  ")
    return F.when(x.rlike(r"^ *+\|.*\| *+$"), cells).otherwise(x)


def markdown_text(md) -> Column:
    """The text of a post: strikethrough and spoilers keep their words, lines keep their ends."""
    c = T._col(md)
    c = F.regexp_replace(F.replace(c, F.lit("~~"), F.lit("")), "(?:&gt;|>)!(.*?)!(?:&lt;|<)|((?:&gt;|>)!.*+)", "$1$2")
    c = F.regexp_replace(c, "(?m)^(?:&gt; ?)++", "")
    under_head = lambda x: x.rlike(TABLE_RULE) & x.contains(TABLE_MARKS[0]) & x.contains(TABLE_MARKS[1])
    lines = F.array_join(F.transform(F.filter(F.split(c, "\n"), lambda x: ~under_head(x)), _line), "\n")
    spans = reduce(lambda x, r: F.regexp_replace(x, *r), SPAN_RULES, lines)
    plain = reduce(lambda x, e: F.replace(x, F.lit(e[0]), F.lit(e[1])), ENTITIES, spans)
    return T.forum_spaces(plain)


def post_text(title, body) -> Column:
    """A post's title, if it has one, a blank line and its body."""
    t = T._col(title)
    head = markdown_text(T.collapse(t))
    both = T.forum_spaces(F.concat(head, F.lit("\n\n"), markdown_text(body)))
    return F.when(F.coalesce(t, F.lit("")) == "", markdown_text(body)).otherwise(both)
