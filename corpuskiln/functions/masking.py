"""Masking of e-mail addresses, phone-like numbers and national ids, as built-in expressions.

A text is cut at the places where an address or a run of numbers can be; each such piece is judged by
itself, and what lies between is never touched. Whether a domain is one is looked up in a list.
"""

from __future__ import annotations

from functools import lru_cache
from importlib import resources

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskiln.functions import patterns as P
from corpuskiln.functions.text import _col, bound, mask_ids, strip

W, D = f"[{P.WORD_CHAR}]", r"\p{Nd}"
START, END = f"(?<!{W})", f"(?!{W})"

# fixed values: ways to write an at-sign and a dot; words among them stand alone
AT_MARKS, AT_WORDS = ["@", r"\(at\)", r"\[at\]", r"\(ät\)", r"\(a\)", r"\[a\]"], ["at", "ät"]
DOT_MARKS, DOT_WORDS = [r"\.", r"\(dot\)", r"\[dot\]", r"\(piste\)", r"\[piste\]"], ["dot", "piste"]
# fixed values: what may stand before the at-sign, the labels of a domain, its last part, and what is put in their place
LOCAL, LABEL, LAST = "[a-zA-Z0-9.!#$%&'*+/=?^_`{}~-]", "[a-zA-Z0-9][a-zA-Z0-9-]{0,61}[a-zA-Z0-9]", "(?:[a-z]{2,8}|[A-Z]{2,8})"
MASKED_LOCAL, MASKED_DOMAIN = "email", "example.com"


def _one_of(marks: list[str], words: list[str]) -> str:
    return "(?:" + "|".join([*marks, *(START + w + END for w in words)]) + ")"


GAP, AT, DOT = f"[{P.SPACES}]*", _one_of(AT_MARKS, AT_WORDS), _one_of(DOT_MARKS, DOT_WORDS)
#: A label of a domain with the dot after it, and labels up to one that can be followed by the domain's last part:
#: possessive, so that a domain of any length takes no stack.
DOTTED = f"{LABEL}{GAP}+{DOT}{GAP}+"
TO_LAST = f"(?:{DOTTED}(?!{LAST}{END}))*+{DOTTED}(?={LAST}{END})"
#: Local part, at-sign, domain. A match begins where a run of local characters begins, or where the one before ended.
ADDRESS = rf"(?:\G|(?<!{LOCAL}))({LOCAL}+)({GAP}{AT}{GAP})((?:{TO_LAST})++{LAST}){END}"


@lru_cache(maxsize=1)
def all_tlds() -> frozenset[str]:
    """All top-level domains, of the list that comes with the package; lines with # are skipped."""
    lines = resources.files("corpuskiln").joinpath("data/tlds-alpha-by-domain.txt").read_text(encoding="utf-8").splitlines()
    return frozenset(x.strip().lower() for x in lines if not x.startswith("#"))


def replaced(text: Column, shape: str, each) -> Column:
    """The text with each(piece) in place of every piece of that shape."""

    def joined(between: Column) -> Column:
        pieces = F.regexp_extract_all(text, F.lit(shape), F.lit(0))
        rest = F.zip_with(pieces, F.slice(between, F.lit(2), F.size(between)), lambda p, b: F.concat(each(p), b))
        return F.concat(F.element_at(between, 1), F.array_join(rest, ""))

    return bound(F.split(text, shape), joined)


def masked_address(piece: Column, tlds) -> Column:
    """An address up to the first part that is a top-level domain; as it is where none is."""
    part = lambda k: F.regexp_extract(piece, f"^{ADDRESS}", k)
    labels, dots = F.split(part(3), DOT), F.regexp_extract_all(part(3), F.lit(DOT), F.lit(0))
    known = F.transform(labels, lambda x, i: (i > 0) & F.lower(strip(x)).isin(*tlds))
    n = F.array_position(known, True).cast("int")  # parts of the domain; 0 if there is none
    width = F.length(F.array_join(F.slice(labels, 1, n), "")) + F.length(F.array_join(F.slice(dots, 1, F.greatest(n - 1, F.lit(0))), ""))
    rest = F.substr(part(3), width + 1)
    return F.when(n > 0, F.concat(F.lit(MASKED_LOCAL), F.replace(part(2), F.lit("\n"), F.lit("")), F.lit(MASKED_DOMAIN), rest)).otherwise(piece)


def mask_emails(text, tlds=None) -> Column:
    """tlds: known top-level domains (a few thousand at most), all of them if none are given."""
    t = _col(text)
    known = sorted(all_tlds() if tlds is None else {x.lower() for x in tlds})
    return F.when(t.rlike(r"@|at|ät|\(a\)|\[a\]") & t.rlike(DOT), replaced(t, ADDRESS, lambda p: masked_address(p, known))).otherwise(t)


# fixed values: white space within a line, ASCII symbols that count as punctuation, and signs inside dates and phone numbers
LINE_SPACE = P.SPACES.replace(r"\t\n", r"\t").replace(r"\r", "")
MARK = r"\p{P}$+<=>^`|~"
DATE_SIGN, PHONE_SIGN = "[.–—-]", "[().+–—-]"
# fixed values: years, months, days; years of a range; units, some of which need an end
YEAR, MONTH, DAY = f"(?:20{D}{{2}}|1[0-9]{D}{{2}}|{D}{{2}})", f"[01]?{D}", f"[0-3]?{D}"
LONG_YEAR = f"(?:1[0-9]{D}{{2}}|20{D}{{2}})"
UNITS = ["metri", "euro", "markka", "markal", r"mk\.", "dollar", "kruunu", "ihmistä", "henkeä", "henkilöä", "asukasta", "katsojaa", "sotilasta", "suomalaista", "vuotta", "merkkiä", "kappaletta", r"kpl\.", f"e{END}(?!-)", "€", r"\$"]
# fixed values: digits of a phone-like number beside the last, and those of it that stay
DIGITS, SHOWN = (6, 12), 2

SIGN = f"[{LINE_SPACE}]*{DATE_SIGN}[{LINE_SPACE}]*"
NUMBER = f"(?:{D}[{LINE_SPACE}{PHONE_SIGN[1:-1]}]*+){{{DIGITS[0]},{DIGITS[1]}}}{D}{END}"
#: What stays: dates in three orders, ranges of years, numbers with a unit.
KEPT = [SIGN.join(order) + END for order in ((DAY, MONTH, YEAR), (YEAR, MONTH, DAY), (YEAR, DAY, MONTH), (LONG_YEAR, LONG_YEAR))]
TO_UNIT = f"{D}[{D}{MARK}{LINE_SPACE}]*(?:{'|'.join(UNITS)})"
#: A run of numbers and signs with the word after it, which can be a unit: no number or date reaches further.
RUN = f"(?<!{W}){D}[{D}{MARK}{LINE_SPACE}]*+(?:€|{W}*+[.-]?)"


#: From the first number of a run to its last unit, and what is left of the unit's word: no number in it is masked.
HELD = f"^{TO_UNIT}(?:(?<={W}){W}*+)?"
#: A number of a run with all that stands before the next; of it the spans that stay, and the phone-like number.
START_OF_NUMBER = f"(?<!{W}){D}"
PIECE = f"{START_OF_NUMBER}(?:[^{D}]|(?<={W}){D})*+"
SPANS = f"(?<!{W})" + "".join(f"(?=({k})?)" for k in [*KEPT, NUMBER]) + D
#: Numbers that are masked together, and those before and after them that are looked at: a phone-like number has at most 13
#: digits, so it ends at most 12 numbers on, and a span that stays reaches less far.
BLOCK, BESIDE = 32, 32


def masked_pieces(pieces: Column) -> Column:
    """Neighbouring pieces, joined, with the digits of phone-like numbers masked, but for the first two of each."""

    def masked(run: Column) -> Column:
        width = lambda k: F.transform(F.regexp_extract_all(run, F.lit(SPANS), F.lit(k)), F.length)
        places = F.transform(pieces, lambda p, i: F.aggregate(F.slice(pieces, 1, i), F.lit(1), lambda n, q: n + F.length(q)))
        found = F.arrays_zip(places.alias("at"), *[width(k + 1).alias(f"k{k}") for k in range(len(KEPT))], width(len(KEPT) + 1).alias("n"))
        spans = F.transform(found, lambda s: F.struct(s["at"].alias("at"), F.greatest(*[s[f"k{k}"] for k in range(len(KEPT))]).alias("kept"), s["n"].alias("n")))
        clear = lambda s, kept: ~F.exists(kept, lambda k: (s["at"] < k["at"] + k["kept"]) & (s["at"] + s["n"] > k["at"]))
        numbers = bound(spans, lambda all_: bound(F.filter(all_, lambda s: s["kept"] > 0), lambda kept: F.filter(all_, lambda s: (s["n"] > 0) & clear(s, kept))))
        head = lambda x: F.regexp_extract(x, f"^(?:{D}[^{D}]*+){{{SHOWN}}}", 0)
        hidden = lambda x: F.concat(head(x), F.regexp_replace(F.substr(x, F.length(head(x)) + 1), D, "0"))
        return F.aggregate(numbers, run, lambda text, s: F.overlay(text, hidden(F.substr(text, s["at"], s["n"])), s["at"], s["n"]))

    return bound(F.array_join(pieces, ""), masked)


def masked_run(run: Column) -> Column:
    """A run with its phone-like numbers masked, in blocks of so many numbers with those beside them."""

    def blocks(pieces: Column) -> Column:
        def block(first: Column) -> Column:
            low = F.greatest(first - BESIDE, F.lit(0))
            text = masked_pieces(F.slice(pieces, low + 1, F.lit(BLOCK + 2 * BESIDE)))
            before, own = F.array_join(F.slice(pieces, low + 1, first - low), ""), F.array_join(F.slice(pieces, first + 1, F.lit(BLOCK)), "")
            return F.substr(text, F.length(before) + 1, F.length(own))  # masking changes no lengths

        return F.when(F.size(pieces) > 0, F.array_join(F.transform(F.sequence(F.lit(0), F.size(pieces) - 1, F.lit(BLOCK)), block), "")).otherwise("")

    held = F.regexp_extract(run, HELD, 0)
    rest = lambda h: bound(F.substr(run, F.length(h) + 1), lambda r: F.concat(h, F.regexp_extract(r, f"(?s)^(?:(?!{START_OF_NUMBER}).)*+", 0), bound(F.regexp_extract_all(r, F.lit(PIECE), F.lit(0)), blocks)))
    return bound(held, rest)


def mask_numbers(text) -> Column:
    """Phone-like numbers that overlap no date, range of years or number with a unit."""
    t = _col(text)
    many = f"(?:{D}[^{D}]*+){{{DIGITS[0] + 1}}}"
    return F.when(t.rlike(many), replaced(t, RUN, lambda r: F.when(r.rlike(many), masked_run(r)).otherwise(r))).otherwise(t)


def mask_all(docs: DataFrame, text_col: str = "text", tlds=None) -> DataFrame:
    """docs with e-mail addresses, ids and numbers masked, in that order; other columns as they are."""
    out = docs.withColumn(text_col, mask_emails(text_col, tlds)).withColumn(text_col, mask_ids(text_col))
    return out.withColumn(text_col, mask_numbers(text_col))
