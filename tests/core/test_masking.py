"""Masks against goldens, and against a plain scan with the regex module over mixed texts."""

import random

import pytest
import regex
from corpuskiln.functions import masking
from corpuskiln.functions import text as T

TLDS = frozenset(("fi", "com", "net"))
# fixed values: ways to write an at-sign and a dot, and the shape of an address
AT = r"(?:@|\bat\b|\(at\)|\[at\]|\bät\b|\(ät\)|\(a\)|\[a\])"
DOT = r"(?:\.|\bdot\b|\(dot\)|\[dot\]|\bpiste\b|\(piste\)|\[piste\])"
MAIL = regex.compile(rf"([a-zA-Z0-9.!#$%&'*+/=?^_`{{}}~-]+)(\s*{AT}\s*)((?:[a-zA-Z0-9][a-zA-Z0-9-]{{0,61}}[a-zA-Z0-9]\s*{DOT}\s*)+(?:[a-z]{{2,8}}|[A-Z]{{2,8}}))\b")


def plain_mails(text):
    def one(m):
        spots = [k.span() for k in regex.finditer(DOT, m[3])]
        ends = [b for (_, a), (b, _) in zip(spots, [*spots[1:], (len(m[3]), 0)]) if m[3][a:b].strip().lower() in TLDS]
        return "email" + m[2].replace("\n", "") + "example.com" + m[3][ends[0] :] if ends else m[0]

    return MAIL.sub(one, text)


# fixed values: signs in dates, years, some units, what stays as it is, and the shape of a phone-like number
GAP = r"[^\S\r\n]*[.–—-][^\S\r\n]*"
YEAR, LONG = r"(?:20\d\d|1[0-9]\d\d|\d\d)", r"(?:1[0-9]\d\d|20\d\d)"
UNITS = r"(?:metri|euro|mk\.|henkeä|kpl\.|e\b(?!-)|€|\$)"
KEEP = [rf"[0-3]?\d{GAP}[01]?\d{GAP}{YEAR}\b", rf"{YEAR}{GAP}[01]?\d{GAP}[0-3]?\d\b", rf"{YEAR}{GAP}[0-3]?\d{GAP}[01]?\d\b", rf"{LONG}{GAP}{LONG}\b", rf"\d(?:\d|[[:punct:]]|[^\S\r\n])*{UNITS}"]
PHONE = r"(?:\d(?:[^\S\r\n]|[().+–—-])*){6,12}\d\b"


def plain_numbers(text):
    starts = [m.start() for m in regex.finditer(r"\b\d", text)]
    keeps = [(a, max(m.end() for k in KEEP if (m := regex.compile(k).match(text, a)))) for a in starts if any(regex.compile(k).match(text, a) for k in KEEP)]
    spans = [(a, m.end()) for a in starts if (m := regex.compile(PHONE).match(text, a))]
    out = list(text)
    for a, b in spans:
        if not any(a < d and b > c for c, d in keeps):
            for k in [k for k in range(a, b) if out[k].isdigit()][2:]:
                out[k] = "0"
    return "".join(out)


def column(spark, texts, each):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string").select("i", each("text").alias("x")).collect()
    return [r["x"] for r in sorted(rows, key=lambda r: r["i"])]


def test_goldens(spark):
    numbers = {
        "Soita 040 123 4567 heti": "Soita 040 000 0000 heti", "Tel. +358 40 1234567": "Tel. +350 00 0000000", "ISBN 951-0-12345-6": "ISBN 950-0-00000-0",
        "24.12.2022 klo 18": None, "vuosina 1995-2005": None, "hinta 1234567 euroa": None, "123456": None, "12345678901234": None,
        "040 123 4567 890 123 456": "040 000 0000 000 000 000",
    }
    assert column(spark, [*numbers, None], masking.mask_numbers) == [m or t for t, m in numbers.items()] + [None]
    mails = {
        "Ota yhteyttä matti.meikalainen@yritys.fi nyt": "Ota yhteyttä email@example.com nyt", "matti (at) yritys piste fi": "email (at) example.com",
        "u@foo.fi.bar": "email@example.com.bar", "u@mail.foo.com,": "email@example.com,", "a@b.fi": "a@b.fi", "x@foo.zzzz": "x@foo.zzzz",
    }
    assert column(spark, [*mails, None], lambda c: masking.mask_emails(c, TLDS)) == [*mails.values(), None]
    rows = [(i, t, "x") for i, t in enumerate([*numbers, *mails, None, "plain"])]
    df = spark.createDataFrame(rows, "id int, text string, other string")
    got = masking.mask_all(df, tlds=TLDS)
    assert got.columns == df.columns and got.count() == len(rows) and got.where("id = 0").first()["text"] == "Soita 040 000 0000 heti"
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("seed", [1, 2])
def test_masks_against_a_plain_scan(spark, seed):
    rnd = random.Random(seed)
    mail = ["a", "bb", "x1", "@", "(at)", " at ", "[at]", ".", "(dot)", " piste ", "fi", "com", "FI", "foo", "zz", " ", "\n", "-", "_", "ä", "ät", ",", "at"]
    number = ["1", "22", "040", "1234", "19", "2005", "1995", " ", " ", "-", ".", "–", "(", ")", "+", "e", "euro", "€", "$", "kpl.", "a", "_", "\n", ",", "mk", "ää", "/", "e-"]
    texts = ["".join(rnd.choice(mail) for _ in range(rnd.randrange(1, 25))) for _ in range(700)]
    assert column(spark, texts, lambda c: masking.mask_emails(c, TLDS)) == [plain_mails(t) for t in texts]
    texts = ["".join(rnd.choice(number) for _ in range(rnd.randrange(1, 40))) for _ in range(700)]
    assert column(spark, texts, masking.mask_numbers) == [plain_numbers(t) for t in texts]


def test_long_texts(spark):
    texts = ["x" * 300_000 + " u@foo.fi", "12 34 " * 2000, "word " * 100_000 + "040 123 4567"]
    got = column(spark, texts, lambda c: masking.mask_numbers(masking.mask_emails(c, TLDS)))
    assert got[0].endswith(" email@example.com") and got[1].startswith("12 00 00") and got[2].endswith(" 040 000 0000") and list(map(len, got))[1:] == list(map(len, texts))[1:]


def test_all_top_level_domains_are_masked(spark):
    known = masking.all_tlds()
    assert len(known) > 1400 and {"it", "nl", "ru", "com", "biz"} <= known and not any(x.startswith("#") or x != x.strip().lower() for x in known)
    rows = [(i, f"write to user@firm{i}.{t} now") for i, t in enumerate(["it", "nl", "ru", "pl", "ch", "at", "jp", "ca", "biz", "com"])] + [(99, "user@firm.zzzz")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for got in (masking.mask_all(df), df.select("doc_id", masking.mask_emails("text").alias("text"))):
        texts = {r["doc_id"]: r["text"] for r in got.collect()}
        assert all(texts[i] == "write to email@example.com now" for i in range(10)) and texts[99] == "user@firm.zzzz"
    assert T.mask_ids is not None
