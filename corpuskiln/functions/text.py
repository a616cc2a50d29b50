"""Text functions over columns: words, paragraphs, ratios, tokens and space normalisers.

All are built-in expressions. A null text gives null; lengths are code points.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpuskiln.functions import patterns as P


#: White space at the end. A run is tried from its first character only, so that many blanks inside a text cost no more.
TRAILING = f"(?<![{P.SPACES}])[{P.SPACES}]++$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bound(value: Column, use) -> Column:
    """use(value), the value computed once however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def matches(text, pattern: str) -> Column:
    return F.regexp_extract_all(_col(text), F.lit(pattern), F.lit(0))


def is_blank(text) -> Column:
    return _col(text).rlike(f"^[{P.SPACES}]*$")


def collapse(text, by: str = " ") -> Column:
    """Runs of white space become one space; none at the edges."""
    return F.regexp_replace(F.regexp_replace(_col(text), f"[{P.SPACES}]+", by), "^ | $", "")


def strip(text) -> Column:
    return F.regexp_replace(_col(text), f"^[{P.SPACES}]++|{TRAILING}", "")


def word_runs(text) -> Column:
    return matches(text, f"[{P.WORD_CHAR}]+")


def alone(body: str) -> str:
    """A pattern for whole runs of word characters that are this."""
    return f"(?<![{P.WORD_CHAR}])(?:{body})(?![{P.WORD_CHAR}])"


def word_count(text) -> Column:
    """Size of words(text), without the array."""
    return F.regexp_count(_col(text), F.lit(alone(P.WORD_BODY.strip("^$"))))


def short_word_count(text) -> Column:
    return F.regexp_count(_col(text), F.lit(alone(P.SHORT_BODY.strip("^$"))))


def words(text) -> Column:
    """Word-character runs that are lower-case words of two letters or more, or capitalised ones."""
    return F.filter(word_runs(text), lambda w: w.rlike(P.WORD_BODY))


def short_words(text) -> Column:
    return F.filter(word_runs(text), lambda w: w.rlike(P.SHORT_BODY))


def paragraphs(text) -> Column:
    return F.filter(F.split(_col(text), "\n\n+"), lambda p: ~is_blank(p))


def ratio(n: Column, total: Column) -> Column:
    return F.try_divide(n.cast("double"), total.cast("double"))


def digits(text) -> Column:
    return F.regexp_count(_col(text), F.lit(P.DIGIT))


def uppers(text) -> Column:
    return F.regexp_count(_col(text), F.lit(P.UPPER))


def foreign_letters(text) -> Column:
    return F.regexp_count(_col(text), F.lit(rf"[{P.LETTERLIKE[1:-1]}&&[^{P.NATIVE[1:-1]}]]"))


def punctuation(text) -> Column:
    c = _col(text)
    return F.length(c) - F.length(F.translate(c, P.PUNCTUATION, ""))


#: Letters, digits and blanks are told from the patterns' characters by one look into a table of bits.
_STRIPPED, _ALONE = f"[[^ -~À-ÿ]&&{P.STRIPPED}]", f"[[^a-zA-Z0-9 À-ÿ]&&{P.ALONE}]"
_SPACE = f"[[^!-~À-ÿ]&&[{P.SPACES}]]"


def _apart(text) -> Column:
    return F.regexp_replace(F.regexp_replace(_col(text), _STRIPPED, ""), _ALONE, " $0 ")


def basic_tokens(text) -> Column:
    """Tokens at white space, with punctuation and ideographs as tokens of their own."""
    return F.filter(F.split(_apart(text), f"{_SPACE}+"), lambda t: t != "")


def basic_sentence(text, start: str, end: str) -> Column:
    """basic_tokens between two marks, joined by spaces."""
    whole = F.concat(F.lit(f"{start} "), _apart(text), F.lit(f" {end}"))
    return F.regexp_replace(whole, f"[{_SPACE}&&[^ ]]{_SPACE}*| {_SPACE}+", " ")


def tokens(text) -> Column:
    """Letter runs, and every other character that isn't white space."""
    return matches(text, P.TOKEN)


def type_token_ratio(text) -> Column:
    return ratio(F.size(F.array_distinct(tokens(text))), F.regexp_count(_col(text), F.lit(P.TOKEN)))


def repeats_unit(text, max_repeat: int) -> Column:
    """A unit of one to three characters, none a line end, max_repeat + 2 times or more in a row."""
    return _col(text).rlike(rf"(?d)(.{{1,3}})\1{{{max_repeat + 1}}}")


def is_punctuation(token) -> Column:
    return _col(token).rlike(r"^\p{P}*$")


def si_format(number) -> Column:
    """1000 is 1000.0, 1001 is 1.0K: divided by 1000 while larger than 1000."""
    n = _col(number).cast("double")
    out = F.format_string("%.1f", n)
    for k, unit in enumerate("KMGTPEZY", 1):
        out = F.when(n / F.lit(1000.0 ** (k - 1)) > 1000, F.concat(F.format_string("%.1f", n / F.lit(1000.0**k)), F.lit(unit))).otherwise(out)
    return out


def line_spaces(text, keep_blank: bool = False) -> Column:
    """White space of every line collapsed; blank lines dropped unless kept."""
    lines = F.transform(F.split(_col(text), "\n"), lambda x: collapse(x))
    return F.array_join(lines if keep_blank else F.filter(lines, lambda x: x != ""), "\n")


def web_spaces(text) -> Column:
    return line_spaces(strip(text))


def forum_spaces(text) -> Column:
    """Paragraphs at blank lines, lines stripped, runs of white space to two spaces."""
    two = lambda x: strip(F.regexp_replace(x, f"[{P.SPACES}]{{2,}}", "  "))
    paragraph = lambda p: F.array_join(F.filter(F.transform(F.split(strip(p), "\n"), two), lambda x: x != ""), "\n")
    parts = F.split(strip(text), f"\n[{P.SPACES}]*\n")
    return F.array_join(F.filter(F.transform(parts, paragraph), lambda p: p != ""), "\n\n")


def wiki_spaces(text) -> Column:
    """Paragraphs right-stripped, no-break spaces plain, runs of white space to two spaces."""
    one = lambda p: F.regexp_replace(F.regexp_replace(F.regexp_replace(p, TRAILING, ""), " ", " "), f"[{P.SPACES}]{{2,}}", "  ")
    parts = F.transform(F.split(_col(text), "\n\n+"), one)
    return F.array_join(F.filter(parts, lambda p: ~is_blank(p)), "\n\n")


def corpus_spaces(text) -> Column:
    """Paragraphs at two or more line ends, each with white space collapsed."""
    parts = F.split(F.regexp_replace(_col(text), "  +", " "), "\n\n+")
    return F.array_join(F.filter(F.transform(parts, lambda p: collapse(p)), lambda p: p != ""), "\n\n")


# fixed values: dashes that keep their line, and from when on lines are kept: the share of short lines, their length, the length of all
DASHES = "-‐‑‒–—―−﹣－"
LISTED, SHORT_LINE, LONG_TEXT = 0.8, 60, 800


def news_paragraph(text) -> Column:
    """Long or list-like paragraphs keep their lines; others become one line, but for lines led by a dash."""
    c = _col(text)
    lines = F.split(c, "\n")
    filled = F.filter(lines, lambda x: ~is_blank(x))
    listed = F.size(F.filter(filled, lambda x: F.length(x) < SHORT_LINE)).cast("double") / F.size(lines) > LISTED
    flowing = F.transform(filled, lambda x: F.concat(F.when(x.rlike(f"^[{DASHES}]"), "\n").otherwise(" "), collapse(x)))
    parts = F.when(listed | (F.length(c) > LONG_TEXT), F.array(F.array_join(F.transform(lines, lambda x: collapse(x)), "\n"))).otherwise(flowing)
    return strip(F.array_join(parts, ""))


def news_spaces(text) -> Column:
    parts = F.transform(F.split(_col(text), f"\n[{P.SPACES}]*\n"), news_paragraph)
    return F.array_join(F.filter(parts, lambda p: p != ""), "\n\n")


def has_html(text) -> Column:
    c = _col(text)
    comment = c.contains("<!--") | c.contains("-->")
    possible = (c.contains("<") & c.contains(">")) | c.contains("&")
    return comment | (possible & c.rlike(P.HTML_HINT))


def drop_nul(text) -> Column:
    return F.translate(_col(text), "\u0000", "")


def unescape_markup(text) -> Column:
    """&lt; &gt; &amp; in that order."""
    return F.replace(F.replace(F.replace(_col(text), F.lit("&lt;"), F.lit("<")), F.lit("&gt;"), F.lit(">")), F.lit("&amp;"), F.lit("&"))


def quote_lines(text) -> Column:
    return F.array_join(F.transform(F.split(_col(text), "\n"), lambda x: F.concat(F.lit("> "), x)), "\n")


# fixed values: media types
PLAIN_TYPES = ["text/plain"]
HTML_TYPES = ["text/html", "application/xhtml+xml", "application/xml", "application/http"]
UNSUPPORTED_TYPES = ["application/pdf", "application/rtf", "application/rdf+xml", "application/atom+xml", "application/rss+xml", "application/json", "application/octet-stream", "application/zip", "text/calendar"]
UNSUPPORTED_MAIN_TYPES = ["image", "audio", "video", "application"]


def media_class(mime) -> Column:
    """plain, html, unsupported or other. Exact names decide first, then a supported name with
    parameters, then the main type; what only starts like an HTML type is html if not unsupported."""
    m = _col(mime)
    known = PLAIN_TYPES + HTML_TYPES
    with_parameters = F.lit(False)
    for t in known:
        with_parameters = with_parameters | m.startswith(f"{t};")
    unsupported = F.lit(False)
    for t in UNSUPPORTED_MAIN_TYPES:
        unsupported = unsupported | m.startswith(f"{t}/")
    like_html = F.lit(False)
    for t in HTML_TYPES:
        like_html = like_html | m.startswith(t)
    refused = ~m.isin(known) & (m.isin(UNSUPPORTED_TYPES) | (~with_parameters & unsupported))
    return F.when(refused, "unsupported").when(m.isin(PLAIN_TYPES), "plain").when(like_html, "html").otherwise("other")


def mask_ids(text, replacement: str = "010101-001Z") -> Column:
    """National identity numbers that stand alone."""
    return F.regexp_replace(_col(text), rf"(?<![{P.WORD_CHAR}]){P.NATIONAL_ID}(?![{P.WORD_CHAR}])", replacement)


#: A heading is shorter than so many characters, and so is what is joined to it: more parts than this can't be joined.
HEADING, JOINED = 50, 26


def join_split_headings(parts) -> Column:
    """A short lower-case paragraph goes on the short capitalised one before it, neither of them ended; more of them do
    until the heading is no longer short."""
    ended = lambda s: strip(s).rlike(r"[.:!?]$")
    short = lambda s: (F.length(s) < HEADING) & ~ended(s)
    tail = lambda s: s.rlike(r"^\p{Ll}") & short(s)
    start = lambda s: s.rlike(r"^[\p{Lu}\p{Nd}]") & short(s)

    def taken(all_: Column, head: Column, i: Column) -> Column:
        """How many of the parts after a heading it takes."""
        state = F.struct(F.length(head).alias("chars"), F.lit(0).alias("n"), F.lit(True).alias("on"))

        def step(s: Column, p: Column) -> Column:
            on = s["on"] & (s["chars"] < HEADING) & tail(p)
            return F.struct((s["chars"] + F.when(on, F.length(p) + 1).otherwise(0)).alias("chars"), (s["n"] + on.cast("int")).alias("n"), on.alias("on"))

        return F.when(start(head), F.aggregate(F.slice(all_, i + 2, F.lit(JOINED)), state, step, lambda s: s["n"])).otherwise(0)

    def joined(all_: Column, n: Column) -> Column:
        before = F.sequence(F.lit(1), F.lit(JOINED))
        gone = lambda i: F.exists(before, lambda d: F.coalesce(F.get(n, i - d) >= d, F.lit(False)))
        heads = F.transform(all_, lambda p, i: F.when(~gone(i), F.when(F.get(n, i) > 0, F.array_join(F.slice(all_, i + 1, F.get(n, i) + 1), " ")).otherwise(p)))
        return F.filter(heads, lambda p: p.isNotNull())

    return bound(_col(parts), lambda all_: bound(F.transform(all_, lambda p, i: taken(all_, p, i)), lambda n: joined(all_, n)))
