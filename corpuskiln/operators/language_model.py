"""A bigram language model as tables: counting, scoring by joins, perplexity and its filters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskiln.functions import text as T
from corpuskiln.operators import encoded
from corpuskiln.operators.joins import spread_join
from corpuskiln.storage import if_small, materialize

#: So many of the commonest words at most are broadcast; all others are joined by a shuffle.
COMMON_WORDS = 50_000


def line_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, line, t): tokens of every line that isn't blank, between sentence marks."""
    lines = docs.select(F.col(id_col).alias("doc_id"), F.posexplode(F.split(text_col, "\n")).alias("line", "x")).where(~T.is_blank("x"))
    return lines.select("doc_id", "line", F.concat(F.array(F.lit("<s>")), T.basic_tokens("x"), F.array(F.lit("</s>"))).alias("t"))


def line_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, line, s): line_tokens joined by spaces."""
    lines = docs.select(F.col(id_col).alias("doc_id"), F.posexplode(F.split(text_col, "\n")).alias("line", "x")).where(~T.is_blank("x"))
    return lines.select("doc_id", "line", T.basic_sentence("x", "<s>", "</s>").alias("s"))


def bigrams(tokens: DataFrame) -> DataFrame:
    pairs = F.transform(F.sequence(F.lit(1), F.size("t") - 1), lambda i: F.struct(F.element_at("t", i).alias("a"), F.element_at("t", i + 1).alias("b")))
    return tokens.select("doc_id", "line", F.explode(pairs).alias("p")).select("doc_id", "line", "p.a", "p.b")


def bigram_model(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(pairs with their counts and add-one log-probabilities, first-word counts, one row with the number of words) of a corpus."""
    rows = bigrams(line_tokens(docs, id_col, text_col))
    counts = materialize(rows.groupBy("a", "b").agg(F.count("*").alias("n_ab")), "pairs")
    firsts = materialize(counts.groupBy("a").agg(F.sum("n_ab").alias("n_a"), F.count("*").alias("pairs")), "firsts")
    size = counts.agg(F.countDistinct("b").alias("v"))
    pairs = spread_join(counts, firsts.select("a", "n_a"), "a", firsts.select("a", F.col("pairs").alias("n")), "b").join(F.broadcast(size))
    pairs = pairs.select("a", "b", "n_ab", F.log10((F.col("n_ab") + 1) / (F.col("n_a") + F.col("v"))).alias("log10p"))
    return materialize(pairs, "pairs"), firsts.select("a", "n_a"), size


def line_scores(docs: DataFrame, model: tuple[DataFrame, DataFrame, DataFrame], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, line, n, log10p): add-one log-probability of each line and its number of transitions.

    Equal transitions of a line are counted before they are joined with the model's pairs; only those that the model
    lacks are then looked up by their first word.
    """
    pairs, firsts, size = model
    seen = bigrams(line_tokens(docs, id_col, text_col)).groupBy("a", "b", "doc_id", "line").agg(F.count("*").alias("k"))
    seen = seen.select(F.struct("a", "b").alias("ab"), "doc_id", "line", "k")
    # every line begins with the same mark, and many with the same word: such keys are cut into parts
    known = pairs.select(F.struct("a", "b").alias("ab"), "n_ab", "log10p")
    both = spread_join(seen, known.select("ab", "log10p"), "ab", known.select("ab", F.col("n_ab").alias("n")), "doc_id", "left")
    unknown = F.collect_list(F.when(F.col("log10p").isNull(), F.struct(F.col("ab.a").alias("a"), "k"))).alias("unknown")
    lines = both.groupBy("doc_id", "line").agg(F.sum("k").alias("n"), F.coalesce(F.sum(F.col("k") * F.col("log10p")), F.lit(0.0)).alias("log10p"), unknown)
    lines = materialize(lines, "line-scores")
    rest = lines.select("doc_id", "line", F.explode("unknown").alias("u")).select("doc_id", "line", "u.a", "u.k")
    rest = spread_join(rest, firsts, "a", firsts.withColumnRenamed("n_a", "n"), "doc_id", "left").join(F.broadcast(size))
    rest = rest.select("doc_id", "line", F.lit(0).cast("bigint"), F.col("k") * F.log10(1 / (F.coalesce("n_a", F.lit(0)) + F.col("v"))))
    return lines.select("doc_id", "line", "n", "log10p").union(rest).groupBy("doc_id", "line").agg(F.sum("n").alias("n"), F.sum("log10p").alias("log10p"))


def own_line_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """line_scores of docs under the bigram model of docs themselves: no transition is unknown, and none is sent with its line."""
    lines = encoded.pair_scores(line_texts(docs, id_col, text_col))
    return lines.groupBy("doc_id", "line").agg(F.sum("n").alias("n"), F.sum("log10p").alias("log10p"))


def scored(docs: DataFrame, model: tuple | None, id_col: str, text_col: str) -> DataFrame:
    return own_line_scores(docs, id_col, text_col) if model is None else line_scores(docs, model, id_col, text_col)


def document_perplexity(docs: DataFrame, model: tuple | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, perplexity): 10 ** (-sum of log-probabilities / transitions); texts without tokens have none.

    Without a model it is that of docs themselves."""
    s = scored(docs, model, id_col, text_col).groupBy("doc_id").agg(F.sum("n").alias("n"), F.sum("log10p").alias("p"))
    return s.select("doc_id", F.pow(F.lit(10.0), -F.col("p") / F.col("n")).alias("perplexity"))


def drop_lines(docs: DataFrame, model: tuple | None, threshold: float, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text): lines at or over the perplexity threshold go, see filters.filter_lines; documents
    left without text go too. Without a model it is that of docs themselves."""
    from corpuskiln.operators.filters import filter_lines

    scores = scored(docs, model, id_col, text_col).select("doc_id", "line", F.pow(F.lit(10.0), -F.col("log10p") / F.col("n")).alias("ppl"))
    bad = scores.where(F.col("ppl") >= threshold).groupBy("doc_id").agg(F.collect_set("line").alias("bad"))
    bad = materialize(bad, "bad-lines")  # the only lines that documents must hear of
    lines = docs.select(F.col(id_col).alias("doc_id"), F.split(text_col, "\n").alias("lines")).join(if_small(bad), "doc_id", "left")
    worst = F.transform("lines", lambda x, i: F.when(F.array_contains("bad", i), F.lit(float(threshold))).otherwise(F.lit(float("-inf"))))
    out = lines.withColumn("scores", worst).select("doc_id", filter_lines(F.col("lines"), F.col("scores"), threshold).alias("text"))
    return out.where(F.trim("text") != "")


def word_list(text_col: str):
    return F.filter(F.split(F.lower(text_col), f"[{T.P.SPACES}]+"), lambda w: w != "")


def word_gains(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple[DataFrame, int]:
    """((word, n, gains array<(lang, x)>) of all words of the rows with a label, number of labels).

    x is the log-odds that a word speaks for a label, ln(1 + 2 * count / share of the label's words):
    naive Bayes with half a word of pseudo-count, dealt by the labels' shares. A label that a word never
    had has 0, so only the labels that occur are held.
    """
    rows = labelled.where(F.col(lang_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.explode(word_list(text_col)).alias("word"))
    counts = materialize(rows.groupBy("word", "lang").agg(F.count("*").alias("k")), "word-labels")
    totals = materialize(counts.groupBy("lang").agg(F.sum("k").alias("of_lang")), "labels")
    every = totals.agg(F.sum("of_lang").alias("of_all"))
    gain = F.log1p(2.0 * F.col("k") * F.col("of_all") / F.col("of_lang"))
    known = counts.join(if_small(totals), "lang").join(F.broadcast(every)).select("word", "k", F.struct("lang", gain.alias("x")).alias("g"))
    return materialize(known.groupBy("word").agg(F.sum("k").alias("n"), F.collect_list("g").alias("gains")), "word-gains"), totals.count()


def label_shares(texts: DataFrame, model: tuple[DataFrame, int], target: str, id_col: str = "doc_id", text_col: str = "text", common: int = COMMON_WORDS) -> DataFrame:
    """(doc_id, lang_prob): probability of the target, 0.0 where another label is likelier or no word is known.

    The commonest words are broadcast, all others are joined as a shuffled table, counted by document before.
    """
    gains, n_langs = model
    seen = texts.select(F.col(id_col).alias("doc_id"), F.explode(word_list(text_col)).alias("word"))
    if gains.count() <= common:
        hits = seen.join(F.broadcast(gains), "word").select("doc_id", F.lit(1).alias("k"), "gains")
    else:
        cut = gains.orderBy(F.desc("n")).limit(common + 1).agg(F.min("n").alias("n")).first()["n"]
        head, rest = F.broadcast(gains.where(F.col("n") > cut)), gains.where(F.col("n") <= cut)
        hits = seen.join(head, "word").select("doc_id", F.lit(1).alias("k"), "gains")
        rare = seen.join(head.select("word"), "word", "left_anti").groupBy("doc_id", "word").agg(F.count("*").cast("int").alias("k"))
        hits = hits.union(rare.join(rest, "word").select("doc_id", "k", "gains"))
    each = hits.select("doc_id", "k", F.explode("gains").alias("g")).groupBy("doc_id", "g.lang").agg(F.sum(F.col("k") * F.col("g.x")).alias("s"))
    each = each.union(texts.select(F.col(id_col).alias("doc_id"), F.lit(None).cast("string").alias("lang"), F.lit(None).cast("double").alias("s")))
    sums = each.groupBy("doc_id").agg(F.max("s").alias("best"), F.max(F.when(F.col("lang") == target, F.col("s"))).alias("own"), F.collect_list("s").alias("all"))
    unseen = (F.lit(n_langs) - F.size("all")) * F.exp(-F.col("best"))
    total = F.aggregate(F.transform("all", lambda x: F.exp(x - F.col("best"))), F.lit(0.0), lambda a, x: a + x) + unseen
    return sums.select("doc_id", F.when(F.col("own") == F.col("best"), 1.0 / total).otherwise(0.0).alias("lang_prob"))


def language_classes(docs: DataFrame, target: str, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(doc_id, lang_prob): probability of the target by naive Bayes over all words of the labelled rows,
    0.0 where another language is likelier or no word is known."""
    return label_shares(docs, word_gains(docs, text_col, lang_col), target, id_col, text_col)


def fold_of(id_col: str, folds: int):
    """Which fold a row is in, by its id; rows with a null id are in the first."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds, F.lit(0)).cast("int")


def cross_fitted(docs: DataFrame, target: str, folds: int = 5, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(doc_id, lang_prob) as language_classes gives it, but no row is scored by a model that saw it or a row of its id.

    Words are counted by label and fold once. A row's model is made when it is scored, by taking its fold's counts from the
    totals, so there are no tables a fold: a word is one row, with a count and the counts of the folds for each label.

    Defined cases: rows without a label are scored, not learned from; a word that only the row's own fold has is unknown;
    a label that only one fold has is unknown to that fold; rows that repeat an id count as one text, the words of all.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), fold_of(id_col, folds).alias("f"), F.col(lang_col).alias("lang"), word_list(text_col).alias("words"))
    counts = rows.where("lang is not null").select("f", "lang", F.explode("words").alias("word")).groupBy("word", "lang", "f").agg(F.count("*").alias("k"))
    counts = materialize(counts, "fold-words")
    by_fold = F.map_from_entries(F.collect_list(F.struct("f", "k")))
    labels = counts.groupBy("word", "lang").agg(F.sum("k").alias("k"), by_fold.alias("folds")).groupBy("word").agg(F.collect_list(F.struct("lang", "k", "folds")).alias("labels"))
    labels = materialize(labels, "word-labels")
    of = counts.groupBy("lang", "f").agg(F.sum("k").alias("k"))
    every = F.broadcast(docs.sparkSession.range(folds).select(F.col("id").cast("int").alias("f")))
    totals = of.groupBy("lang").agg(F.sum("k").alias("k"), by_fold.alias("folds")).crossJoin(every)  # labels times folds
    left = F.col("k") - F.coalesce(F.try_element_at("folds", F.col("f")), F.lit(0))
    totals = materialize(totals.select("lang", "f", left.alias("of_lang")).where("of_lang > 0"), "fold-labels")
    sums = totals.groupBy("f").agg(F.sum("of_lang").alias("of_all"), F.count("*").alias("n_langs"))
    shares = totals.join(F.broadcast(sums), "f").select("lang", "f", (F.col("of_all") / F.col("of_lang")).alias("share"))
    seen = rows.select("doc_id", "f", F.explode("words").alias("word")).groupBy("doc_id", "f", "word").agg(F.count("*").alias("n"))
    seen = materialize(seen, "document-words")
    hits = spread_join(seen, labels, "word", seen.groupBy("word").agg(F.count("*").alias("n")), "doc_id")
    hits = hits.select("doc_id", "f", "n", F.explode("labels").alias("g"))
    k = F.col("g.k") - F.coalesce(F.try_element_at("g.folds", F.col("f")), F.lit(0))
    hits = hits.select("doc_id", "f", "n", F.col("g.lang").alias("lang"), k.alias("k")).where("k > 0").join(if_small(materialize(shares, "shares")), ["lang", "f"])
    each = hits.groupBy("doc_id", "f", "lang").agg(F.sum(F.col("n") * F.log1p(2.0 * F.col("k") * F.col("share"))).alias("s"))
    each = each.union(rows.select("doc_id", "f", F.lit(None).cast("string"), F.lit(None).cast("double")).distinct())
    best = each.groupBy("doc_id", "f").agg(F.max("s").alias("best"), F.max(F.when(F.col("lang") == target, F.col("s"))).alias("own"), F.collect_list("s").alias("all"))
    best = best.join(F.broadcast(sums.select("f", "n_langs")), "f", "left")
    total = F.aggregate(F.transform("all", lambda x: F.exp(x - F.col("best"))), F.lit(0.0), lambda a, x: a + x) + (F.col("n_langs") - F.size("all")) * F.exp(-F.col("best"))
    return best.select("doc_id", F.when(F.col("own") == F.col("best"), 1.0 / total).otherwise(0.0).alias("lang_prob"))


def read_arpa(spark: SparkSession, path: str) -> DataFrame:
    """(order, ngram, log10p, backoff) of an ARPA text file; headers and section marks are skipped."""
    parts = F.split("value", "\t")
    rows = spark.read.text(path).where(F.col("value").rlike("^-?[0-9.]+\t"))
    return rows.select(F.size(F.split(parts[1], " ")).alias("order"), parts[1].alias("ngram"), parts[0].cast("double").alias("log10p"), F.coalesce(F.try_element_at(parts, F.lit(3)).cast("double"), F.lit(0.0)).alias("backoff"))


def backoff_scores(tokens: DataFrame, arpa: DataFrame, highest: int, unknown: float = -100.0) -> DataFrame:
    """(doc_id, line, n, log10p) of (doc_id, line, t) token arrays between sentence marks, by a back-off model.

    A word's probability is that of the longest n-gram the model has that ends in it, times the back-off weights
    of the longer histories. Every place looks up its n-grams of all orders and its histories in one join;
    a word that the model lacks counts as <unk>, or as ``unknown``.
    """
    words = arpa.where("order = 1").select(F.col("ngram").alias("w"))
    flat = tokens.select("doc_id", "line", F.posexplode("t").alias("pos", "w"))
    sizes = flat.groupBy("w").agg(F.count("*").alias("n"))
    known = spread_join(flat, words.withColumn("in_model", F.lit(True)), "w", sizes, "doc_id", "left")
    named = known.select("doc_id", "line", F.struct("pos", F.when(F.col("in_model"), F.col("w")).otherwise("<unk>").alias("w")).alias("x"))
    lines = named.groupBy("doc_id", "line").agg(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["w"]).alias("t"))
    gram = lambda end, n: F.array_join(F.slice("t", end - n + 1, n), " ")
    at = F.sequence(F.lit(2), F.size("t"))
    orders = F.sequence(F.lit(1), F.lit(highest))
    asked = F.flatten(F.transform(at, lambda i: F.flatten(F.transform(F.filter(orders, lambda n: n <= i), lambda n: F.array(
        F.struct(i.alias("pos"), n.alias("n"), F.lit(True).alias("whole"), gram(i, n).alias("ngram")),
        F.struct(i.alias("pos"), n.alias("n"), F.lit(False).alias("whole"), F.when((n < highest) & (n < i), gram(i - 1, n)).alias("ngram")))))))
    asked = lines.where(F.size("t") > 1).select("doc_id", "line", F.explode(asked).alias("q")).select("doc_id", "line", "q.*").where("ngram is not null")
    asked = materialize(asked, "asked")
    found = spread_join(asked, arpa.select("ngram", "log10p", "backoff"), "ngram", asked.groupBy("ngram").agg(F.count("*").alias("n")), "doc_id", "left")
    whole = F.col("whole") & F.col("log10p").isNotNull()
    longest = F.max(F.when(whole, F.struct("n", "log10p")))
    weights = F.map_from_entries(F.collect_list(F.when(~F.col("whole") & F.col("backoff").isNotNull(), F.struct("n", "backoff"))))
    each = found.groupBy("doc_id", "line", "pos").agg(longest.alias("best"), weights.alias("w"))
    n = F.coalesce("best.n", F.lit(1))
    missed = F.aggregate(F.filter(F.map_entries("w"), lambda e: e["key"] >= n), F.lit(0.0), lambda a, e: a + e["value"])
    each = each.select("doc_id", "line", (F.coalesce("best.log10p", F.lit(unknown)) + missed).alias("p"))
    return each.groupBy("doc_id", "line").agg(F.count("*").alias("n"), F.sum("p").alias("log10p"))


def retention(before: DataFrame, after: DataFrame, text_col: str = "text") -> DataFrame:
    """(docs_in, docs_out, chars_in, chars_out, kept_share): what a filter left of documents and characters."""
    count = lambda df, x: df.agg(F.count("*").alias(f"docs_{x}"), F.coalesce(F.sum(F.length(text_col)), F.lit(0)).alias(f"chars_{x}"))
    both = count(before, "in").join(F.broadcast(count(after, "out")))
    return both.select("docs_in", "docs_out", "chars_in", "chars_out", F.try_divide(F.col("chars_out").cast("double"), F.col("chars_in")).alias("kept_share"))


def tokenized_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, line, tokens): one line of tokens joined by spaces for every line that isn't blank."""
    lines = docs.select(F.col(id_col).alias("doc_id"), F.posexplode(F.split(text_col, "\n")).alias("line", "x")).where(~T.is_blank("x"))
    return lines.select("doc_id", "line", F.array_join(T.basic_tokens("x"), " ").alias("tokens"))
