"""Document filters: first-failure cascade, report, line filter and label filters."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskiln.functions import text as T
from corpuskiln.operators import language_model
from corpuskiln.operators.joins import spread_join
from corpuskiln.storage import materialize


@dataclass(frozen=True)
class FilterConfig:
    """Thresholds; None is off. Comparisons are strict."""

    avg_len: int | None = None
    punct_ratio: float | None = None
    upper_ratio: float | None = None
    digit_ratio: float | None = None
    foreign_ratio: float | None = None
    short_ratio: float | None = None
    type_token_ratio: float | None = None
    min_words: int | None = None
    max_repeat: int | None = None
    lang_prob: float | None = None
    invert: bool = False


# fixed values: the thresholds of each kind of corpus
PRESETS = {
    "forum": FilterConfig(5, 0.1, 0.1, 0.1, 0.01, 0.05, 0.5, 5, 5, 0.9),
    "encyclopedia": FilterConfig(5, 0.1, 0.1, 0.1, 0.05, 0.1, None, 15, None, 0.99),
    "news": FilterConfig(5, 0.1, 0.1, 0.1, 0.01, 0.05, None, 25, None, 0.999),
    "books": FilterConfig(lang_prob=0.9),
}


def measures(text_col: str = "text", words: Column | None = None) -> dict[str, Column]:
    """Every metric by name; ratios of empty texts are null."""
    t = F.col(text_col)
    n, w, s = F.length(t), T.word_count(t) if words is None else words, T.short_word_count(t)
    return {
        "chars": n.cast("bigint"), "words": w, "short_words": s, "paragraphs": F.size(T.paragraphs(t)),
        "avg_len": T.ratio(w, F.size(T.paragraphs(t))), "punct_ratio": T.ratio(T.punctuation(t), n),
        "upper_ratio": T.ratio(T.uppers(t), n), "digit_ratio": T.ratio(T.digits(t), n), "foreign_ratio": T.ratio(T.foreign_letters(t), n),
        "short_ratio": F.coalesce(T.ratio(s, w + s), F.lit(0.0)), "type_token_ratio": T.type_token_ratio(t),
    }


def with_metrics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with a struct column ``metrics``."""
    return docs.withColumn("metrics", F.struct(*[c.alias(k) for k, c in measures(text_col).items()]))


def reason(config: FilterConfig, text_col: str = "text", lang_prob: Column | None = None, words: Column | None = None) -> Column:
    """The first condition that a text fails, null if none; a metric is computed only for texts that reach its
    condition. The language probability, where one is given, comes last."""
    m = measures(text_col, words)
    out = F.when(F.col(text_col).isNull() | T.is_blank(text_col), "empty")
    steps = [
        ("avg-len", config.avg_len, lambda x: m["avg_len"] < x), ("punct-ratio", config.punct_ratio, lambda x: m["punct_ratio"] > x),
        ("upper-ratio", config.upper_ratio, lambda x: m["upper_ratio"] > x), ("digit-ratio", config.digit_ratio, lambda x: m["digit_ratio"] > x),
        ("foreign-ratio", config.foreign_ratio, lambda x: m["foreign_ratio"] > x), ("short-ratio", config.short_ratio, lambda x: m["short_ratio"] > x),
        ("type-token-ratio", config.type_token_ratio, lambda x: m["type_token_ratio"] < x), ("min-words", config.min_words, lambda x: m["words"] < x),
        ("max-repeat", config.max_repeat, lambda x: T.repeats_unit(text_col, x)),
        ("lang-prob", config.lang_prob if lang_prob is not None else None, lambda x: lang_prob < x),
    ]
    for name, threshold, failed in steps:
        if threshold is not None:
            out = out.when(failed(threshold), name)
    return out


def judged(docs: DataFrame, config: FilterConfig, text_col: str = "text", lang_prob: Column | None = None) -> DataFrame:
    """docs with their outcome: a reason, or pass-all. Words are counted once for the three conditions on them."""
    counted = docs.withColumn("__words", T.word_count(text_col))
    return counted.withColumn("outcome", F.coalesce(reason(config, text_col, lang_prob, F.col("__words")), F.lit("pass-all"))).drop("__words")


def kept(docs: DataFrame, config: FilterConfig, text_col: str = "text", lang_prob: Column | None = None) -> DataFrame:
    """The rows that pass, all columns as they were; those that don't if inverted."""
    ok = F.col("outcome") == "pass-all"
    return judged(docs, config, text_col, lang_prob).where(~ok if config.invert else ok).drop("outcome")


def report(docs: DataFrame, config: FilterConfig, text_col: str = "text") -> DataFrame:
    """(outcome, n, share) of all outcomes; share in percent of the total."""
    counts = judged(docs, config, text_col).groupBy("outcome").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    return counts.join(F.broadcast(total)).select("outcome", "n", (F.col("n") * 100.0 / F.col("total")).alias("share"))


def filter_lines(lines: Column, scores: Column, threshold: float, min_remaining: float | None = None) -> Column:
    """A text's lines whose score is below the threshold; blank lines stay.

    Nothing removed leaves the text as it is; else blank edges go and blank lines between paragraphs
    become one. With min_remaining, a text that keeps less of its length is emptied.
    """
    text = F.array_join(lines, "\n")
    good = F.filter(F.arrays_zip(lines.alias("line"), scores.alias("score")), lambda x: T.is_blank(x["line"]) | (x["score"] < threshold))
    left = F.array_join(F.transform(good, lambda x: x["line"]), "\n")
    tidy = F.regexp_replace(T.strip(left), f"\n[{T.P.SPACES}]*\n", "\n\n")
    out = F.when(F.size(good) == F.size(lines), text).otherwise(tidy)
    if min_remaining is not None:
        out = F.when(F.length(out) < F.length(text) * F.lit(min_remaining), "").otherwise(out)
    return out


def label_filter(docs: DataFrame, labels: DataFrame, label_col: str, id_col: str = "doc_id", invert: bool = False) -> DataFrame:
    """docs without (or, inverted, only) those that the label table marks with 1."""
    marked = labels.where(F.col(label_col) == 1).select(F.col(id_col).alias("__marked")).distinct()
    return docs.join(marked, docs[id_col] == marked["__marked"], "left_semi" if invert else "left_anti")


def toxicity_filter(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5, invert: bool = False) -> DataFrame:
    """docs, all columns, without (or, inverted, only) the toxic ones.

    A label of 1 or 0 decides where there is one (1 if an id has both); every other text is scored whole by
    language_model's word classifier, learned from the labels, and is toxic if its probability, by the labels' share of
    toxic ones (half at most), reaches the threshold. Equal texts are scored once. A null text has no score and stays, and so do rows with a null id whose text isn't toxic.
    """
    marks = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("__marked")).agg(F.max(label_col).cast("int").alias("__mark"))
    rows = docs.join(marks, docs[id_col] == marks["__marked"], "left").withColumn("__digest", F.sha2(F.col(text_col).cast("binary"), 256))
    model = language_model.word_gains(rows.select(F.col(text_col).alias("text"), F.col("__mark").cast("string").alias("lang")))
    unmarked = rows.where("__mark is null and __digest is not null").groupBy("__digest").agg(F.first(text_col).alias("text"))
    share = marks.agg(F.least(F.avg("__mark"), F.lit(0.5)).alias("__share"))  # the scores are of labels equally likely
    p, prior = F.col("lang_prob"), F.col("__share")
    posterior = p * prior / (p * prior + (1 - p) * (1 - prior))
    scores = language_model.label_shares(unmarked, model, "1", "__digest").where("lang_prob > 0").join(F.broadcast(share))
    scores = materialize(scores.where(posterior >= threshold).select(F.col("doc_id").alias("__digest"), F.lit(True).alias("__found")), "toxic")
    # a text that a third of all rows hold is judged in several tasks
    judged = spread_join(rows, scores, "__digest", rows.groupBy("__digest").agg(F.count("*").alias("n")), id_col, "left")
    toxic = F.coalesce(F.col("__mark") == 1, F.col("__found").isNotNull())
    return judged.where(toxic if invert else ~toxic).select(*docs.columns)


def label_sets(docs: DataFrame, labels: DataFrame, label_cols: list[str], id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """(doc_id, labels array<string>): the labels, in alphabetical order, whose probability reaches the threshold.

    Each label column (0, 1 or null) has a word classifier of its own, learned from its labelled rows; a document
    is toxic, say, if any of its labels is one of the toxic ones.
    """
    marks = labels.groupBy(F.col(id_col).alias("__i")).agg(*[F.max(c).cast("string").alias(f"__{c}") for c in label_cols])
    rows = docs.join(marks, docs[id_col] == marks["__i"], "left").select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *[f"__{c}" for c in label_cols])
    found = None
    for c in sorted(label_cols):  # a handful
        hits = language_model.language_classes(rows, "1", lang_col=f"__{c}").where(F.col("lang_prob") >= threshold).select("doc_id", F.lit(c).alias("label"))
        found = hits if found is None else found.union(hits)
    sets = found.groupBy(F.col("doc_id").alias("__d")).agg(F.array_sort(F.collect_set("label")).alias("labels"))
    out = docs.select(F.col(id_col).alias("doc_id")).join(sets, F.col("doc_id") == F.col("__d"), "left")
    return out.select("doc_id", F.coalesce("labels", F.expr("cast(array() as array<string>)")).alias("labels"))


def register_filter(docs: DataFrame, register: str, lex_ppl: str, delex_ppl: str, max_ppl: float | None = None, max_delex_ppl: float | None = None, registers: tuple[str, ...] = ("machine translated",), invert: bool = False) -> DataFrame:
    """docs of other registers whose perplexities don't exceed the maxima, nulls pass; inverted, the others."""
    bad = F.coalesce(F.lower(F.col(register)).isin(*registers), F.lit(False))
    for column, most in ((lex_ppl, max_ppl), (delex_ppl, max_delex_ppl)):
        if most is not None:
            bad = bad | F.coalesce(F.col(column) > most, F.lit(False))
    return docs.where(bad if invert else ~bad)


def config_from(**options) -> FilterConfig:
    known = {f.name for f in fields(FilterConfig)}
    if unknown := set(options) - known:
        raise ValueError(f"unknown options: {sorted(unknown)}")
    return FilterConfig(**options)
