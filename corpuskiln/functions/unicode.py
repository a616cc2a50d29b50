"""Unicode forms, repair and decoding. Normal forms have no built-in function, so they run in Arrow
batches, and only on texts that aren't plain ASCII."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def normal_text(text: str, form: str = "NFKC", combining: bool = True) -> str:
    """The normal form; in composed forms a space and an acute are an apostrophe, and combining marks
    U+0300 to U+036F that are left go, unless kept."""
    if not combining and form.endswith("C"):
        text = text.replace(" ́", "'")
    text = unicodedata.normalize(form, text)
    return text if combining or not form.endswith("C") else "".join(c for c in text if not "̀" <= c <= "ͯ")


def repaired_text(text: str) -> str:
    """UTF-8 that was read as Latin-1 or Windows-1252, read again; other texts as they are."""
    for name in ("cp1252", "latin-1"):
        try:
            fixed = text.encode(name).decode("utf-8")
        except UnicodeError:
            continue
        return fixed if len(fixed) < len(text) else text
    return text


def over_batches(docs: DataFrame, text_col: str, each) -> DataFrame:
    """docs with each(text) in place of texts that aren't ASCII; the others never leave the JVM."""
    ascii_ = F.coalesce(F.octet_length(text_col) == F.length(text_col), F.lit(True))
    run = F.pandas_udf(lambda s: pd.Series([None if t is None else each(t) for t in s]), "string")
    rest = docs.where(~ascii_).withColumn(text_col, run(F.col(text_col)))
    return docs.where(ascii_).union(rest.select(*docs.columns))


def normalized(docs: DataFrame, form: str = "NFKC", combining: bool = True, text_col: str = "text") -> DataFrame:
    return over_batches(docs, text_col, lambda t: normal_text(t, form, combining))


def repaired(docs: DataFrame, text_col: str = "text") -> DataFrame:
    return over_batches(docs, text_col, repaired_text)


def decoded(content) -> Column:
    """Bytes as UTF-8 where they are valid, else as ISO-8859-1."""
    c = F.col(content) if isinstance(content, str) else content
    return F.when(F.is_valid_utf8(c.cast("string")), c.cast("string")).otherwise(F.decode(c, "ISO-8859-1"))
