"""Estimation of back-off language models with interpolated modified Kneser-Ney smoothing.

Chen and Goodman, "An empirical study of smoothing techniques for language modeling", 1999; the treatment of sentence
marks and of unknown words is that of Heafield and others, "Scalable modified Kneser-Ney language model estimation", 2013.

The highest order has the counts of its n-grams, and every lower order the number of different words that stand before
an n-gram, except for those at the start of a sentence, which nothing precedes and which keep their counts. Each order
is made from the one above by one aggregation. Three discounts an order come from its numbers of n-grams of count
1 to 4; what they take off a history's n-grams is dealt out by the distribution of the shorter history:

    p(w | h) = (a(h w) - D(a(h w))) / sum_x a(h x) + b(h) * p(w | h')        b(h) = sum_x D(a(h x)) / sum_x a(h x)

and below the single words by an even share of the vocabulary, which counts the unknown word. In general all n-grams of
an order are a table; histories and shorter n-grams are joined to it by keys whose numbers of rows are known before
(spread_join), so that neither the start of a sentence nor a frequent word meets in one task. To the driver come four
counts an order.

Three orders go by numbered words instead (encoded.py): a bucket of sentences sends its trigrams once to the parts of their
histories and once to those of their last two words, which tell it counts; words have parts of their own. A bucket then
has all that its n-grams' probabilities need. Of the buckets that hold an n-gram one is told to write it.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskiln.operators import encoded as E
from corpuskiln.operators.joins import spread_join
from corpuskiln.storage import materialize

START, UNKNOWN = "<s>", "<unk>"
#: Discounts of counts 1, 2 and above where the counts of counts give none: too few n-grams, or repeated ones.
FALLBACK = (0.5, 1.0, 1.5)
#: Log-probability of the start of a sentence, which is never predicted.
NEVER = -99.0


def ngram_counts(tokens: DataFrame, highest: int) -> DataFrame:
    """(order, ngram, n): of the n-gram of the highest order that ends at each place of (t), or the shorter one from the start."""
    ends = F.sequence(F.lit(2), F.size("t"))
    grams = F.transform(ends, lambda i: F.array_join(F.slice("t", F.greatest(i - highest + 1, F.lit(1)), F.least(i, F.lit(highest))), " "))
    counts = tokens.where(F.size("t") > 1).select(F.explode(grams).alias("ngram")).groupBy("ngram").agg(F.count("*").alias("n"))
    return counts.select(F.size(F.split("ngram", " ")).alias("order"), "ngram", "n")


def history(ngram: str) -> Column:
    """An n-gram without its last word; the empty string for a word."""
    return F.regexp_replace(ngram, " ?[^ ]*$", "")


def shorter(ngram: str) -> Column:
    """An n-gram without its first word."""
    return F.regexp_replace(ngram, "^[^ ]* ?", "")


def adjusted_counts(counts: DataFrame, highest: int) -> dict[int, DataFrame]:
    """{order: (ngram, n)}: counts of the highest order, numbers of words before them of the others."""
    out = {highest: materialize(counts.where(F.col("order") == highest).select("ngram", "n"), f"grams-{highest}")}
    for k in range(highest - 1, 0, -1):
        wider = out[k + 1].select(shorter("ngram").alias("ngram")).groupBy("ngram").agg(F.count("*").alias("n"))
        starts = counts.where(F.col("order") == k).select("ngram", "n")
        out[k] = materialize(wider.unionByName(starts), f"grams-{k}")
    return out


def discounts(grams: DataFrame) -> tuple[float, float, float]:
    """Of counts 1, 2, and 3 or more."""
    return discounts_of({r["n"]: r["t"] for r in grams.where("n <= 4").groupBy("n").agg(F.count("*").alias("t")).collect()})


def discounts_of(t: dict[int, int]) -> tuple[float, float, float]:
    """Of the numbers of n-grams of counts 1 to 4."""
    if not all(t.get(k) for k in (1, 2, 3, 4)):
        return FALLBACK
    y = t[1] / (t[1] + 2.0 * t[2])
    d = tuple(k - (k + 1) * y * t[k + 1] / t[k] for k in (1, 2, 3))
    return d if all(0 <= x <= k for k, x in zip((1, 2, 3), d, strict=True)) else FALLBACK


def estimated(tokens: DataFrame, highest: int = 3) -> DataFrame:
    """(order, ngram, log10p, backoff) of all orders up to the highest, from sentences (t array<string>) between their marks.

    Defined cases: sentences that are null or have one token or none are left out; without sentences the model holds
    the unknown word, with all probability, and the start mark; a history that never goes on has back-off weight 0;
    tokens with blanks inside aren't told apart from several tokens.
    """
    if highest == 3:
        return trigram_model(tokens.where(F.size("t") > 1).select(F.lit(0).alias("doc_id"), F.lit(0).alias("line"), F.array_join("t", " ").alias("s")))
    return general_model(tokens, highest)


def general_model(tokens: DataFrame, highest: int) -> DataFrame:
    """estimated() of any number of orders, by tables of n-grams as texts."""
    grams = adjusted_counts(materialize(ngram_counts(tokens, highest), "ngrams"), highest)
    rows, low = {}, None
    weights = {k: history_weights(grams[k], discounts(grams[k])) for k in grams}
    for k in range(1, highest + 1):
        d = discounts(grams[k])
        taken = F.when(F.col("n") >= 3, d[2]).when(F.col("n") == 2, d[1]).otherwise(d[0])
        if k == 1:
            types = grams[1].count() + 1
            of = weights[1].first()
            total, b = (float(of["total"]), of["b"]) if of else (1.0, 1.0)
            p = grams[1].select("ngram", ((F.col("n") - taken) / F.lit(total) + F.lit(b / types)).alias("p"))
            spark = tokens.sparkSession
            p = p.union(spark.createDataFrame([(UNKNOWN, b / types)], "ngram string, p double"))
        else:
            both = spread_join(grams[k].withColumn("h", history("ngram")), weights[k].select("h", "total", "b"), "h", weights[k].select("h", F.col("types").alias("n")), "ngram")
            both = both.withColumn("tail", shorter("ngram"))
            # as many n-grams end in a shorter one as words stand before it
            both = spread_join(both, low.select(F.col("ngram").alias("tail"), F.col("p").alias("q")), "tail", grams[k - 1].select(F.col("ngram").alias("tail"), "n"), "ngram")
            p = both.select("ngram", ((F.col("n") - taken) / F.col("total") + F.col("b") * F.col("q")).alias("p"))
        low = materialize(p, f"probabilities-{k}")
        rows[k] = low.select(F.lit(k).alias("order"), "ngram", F.log10("p").alias("log10p"))
    rows[1] = rows[1].union(tokens.sparkSession.createDataFrame([(1, START, NEVER)], "order int, ngram string, log10p double"))
    out = None
    for k in range(1, highest + 1):
        if k < highest:
            after = weights[k + 1].select(F.col("h").alias("ngram"), F.log10("b").alias("backoff"))
            part = rows[k].join(after, "ngram", "left").select("order", "ngram", "log10p", F.coalesce("backoff", F.lit(0.0)).alias("backoff"))
        else:
            part = rows[k].withColumn("backoff", F.lit(0.0))
        out = part if out is None else out.unionByName(part)
    return out


def history_weights(grams: DataFrame, d: tuple[float, float, float]) -> DataFrame:
    """(h, total, types, b) of every history: the counts of its n-grams, their number, and the share that discounts take."""
    of = grams.groupBy(history("ngram").alias("h")).agg(
        F.sum("n").alias("total"), F.count("*").alias("types"), F.count_if(F.col("n") == 1).alias("n1"), F.count_if(F.col("n") == 2).alias("n2"), F.count_if(F.col("n") >= 3).alias("n3")
    )
    b = (F.lit(d[0]) * F.col("n1") + F.lit(d[1]) * F.col("n2") + F.lit(d[2]) * F.col("n3")) / F.col("total")
    return materialize(of.select("h", "total", "types", b.alias("b")), "histories")


#: Kinds of what buckets and parts send: trigrams by their histories, pairs with the words before them, single words.
HISTORIES, PAIRS, SINGLE = 2, 3, 4


def few(n: np.ndarray) -> np.ndarray:
    """How many of n are 1, 2, 3 and 4."""
    return np.bincount(np.minimum(n, 5), minlength=6)[1:5]


def sums_of(at: np.ndarray, n: np.ndarray, size: int) -> list[np.ndarray]:
    """For each of size places: the sum of n, and how many of n are 1, 2 and 3 or more."""
    return [np.bincount(at, n, size).astype(np.int64), *(np.bincount(at[x], minlength=size) for x in (n == 1, n == 2, n >= 3))]


def firsts(index: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros(size, dtype=np.int64)
    out[index] = 1
    return out


def all_pairs(b: E.Bucket) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(different pairs of a bucket, which one begins at each place, places where trigrams begin); sentences' last places have no pair."""
    at = E.not_last(b.sizes)
    pairs, inv = np.unique((b.x[at] << 32) | b.x[at + 1], return_inverse=True)
    which = np.zeros(len(b.x), dtype=np.int64)
    which[at] = inv
    return pairs, which, E.not_last(b.sizes, 2)


def counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(different keys in order, their counts)."""
    keys = np.sort(keys)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, dtype=np.int64)
    return keys[first], np.diff(first, append=len(keys))


def sent_trigrams(number: int, b: E.Bucket, parts: int) -> pa.Table:
    """What a bucket sends of its trigrams, pairs and words."""
    rows, (every, which, at) = [], all_pairs(b)
    named = E.numbered(every, b.ids)
    part = E.part_of(named, parts)
    for kind, before in ((HISTORIES, False), (PAIRS, True)):
        keys, extra = counted((which[at + 1] << 32) | b.x[at] if before else (which[at] << 32) | b.x[at + 2])
        pairs, third, sizes = named, b.ids[keys & E.LOW], np.bincount(keys >> 32, minlength=len(every))
        if before:
            extra = np.bincount(which[np.cumsum(b.sizes) - b.sizes], minlength=len(every))
        begin = np.cumsum(sizes) - sizes
        order, cut = E.by_part(part, parts)
        places = E.runs(begin[order], sizes[order])
        pairs, sizes, third, extra = pairs[order], sizes[order], third[places], extra[order if before else places]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        anew = np.zeros(len(third), dtype=bool)
        anew[ends[:-1][sizes > 0]] = True
        steps = np.where(anew, third, np.diff(third, prepend=0))
        for p, i, j in E.sliced(cut):
            k, m = ends[i], ends[j]
            rows.append((number, kind, p, E.pack(*E.pair_deltas(pairs[i:j]), sizes[i:j], steps[k:m], extra[i:j] if before else extra[k:m])))
    order, cut = E.by_part(b.ids % parts, parts)
    rows += [(number, SINGLE, p, E.pack(np.diff(b.ids[order[i:j]], prepend=0))) for p, i, j in E.sliced(cut)]
    return E.out_rows(rows)


def read_thirds(asks: list[list[np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(different pairs, which each sent one is, where each was sent first, keys pair << 32 | third of all sent)."""
    pairs, first, which = np.unique(np.concatenate([E.pair_keys(a[0], a[1]) for a in asks]), return_index=True, return_inverse=True)
    sizes = E.joined(asks, 2)
    ends = np.cumsum(sizes)
    anew = np.zeros(int(sizes.sum()), dtype=bool)
    anew[(ends - sizes)[sizes > 0]] = True
    return pairs, which, first, (np.repeat(which, sizes) << 32) | E.restarted(E.joined(asks, 3), anew)


def count_trigrams(rows: pa.Table, parts: int, owners: bool) -> pa.Table:
    """A part's answers to what buckets sent by histories or by pairs; of pairs also what their words' parts must hear."""
    kind, part, of = rows["kind"][0].as_py(), rows["part"][0].as_py(), rows["bucket"].to_pylist()
    asks = [E.unpack(d.as_py()) for d in rows["data"]]
    pairs, which, first, keys = read_thirds(asks)
    at = E.lengths([a[0] for a in asks])
    if kind == HISTORIES:
        grams, begin, gram = np.unique(keys, return_index=True, return_inverse=True)
        n = np.bincount(gram, E.joined(asks, 4), len(grams)).astype(np.int64)
        own, sums, to = firsts(begin if owners else begin[:0], len(gram)), sums_of(grams >> 32, n, len(pairs)), E.lengths([a[3] for a in asks])
        out = [(b, kind, part, E.pack(n[gram[to[k] : to[k + 1]]], own[to[k] : to[k + 1]], *(s[which[at[k] : at[k + 1]]] for s in sums))) for k, b in enumerate(of)]
        return E.out_rows([*out, (-1, kind, part, E.pack(few(n)))])
    n = np.bincount(counted(keys)[0] >> 32, minlength=len(pairs)) + np.bincount(which, E.joined(asks, 4), len(pairs)).astype(np.int64)
    own = firsts(first if owners else first[:0], len(which))
    out = [(b, kind, part, E.pack(n[which[at[k] : at[k + 1]]], own[at[k] : at[k + 1]])) for k, b in enumerate(of)]
    words, place = np.unique(np.concatenate([pairs >> 32, pairs & E.LOW]), return_inverse=True)
    sums = [*sums_of(place[: len(pairs)], n, len(words)), np.bincount(place[len(pairs) :], minlength=len(words))]
    order, cut = E.by_part(words % parts, parts)
    out += [(-1, SINGLE, p, E.pack(np.diff(words[order[i:j]], prepend=0), *(s[order[i:j]] for s in sums))) for p, i, j in E.sliced(cut)]
    return E.out_rows([*out, (-1, kind, part, E.pack(few(n)))])


def count_words(rows: pa.Table) -> pa.Table:
    """Of a part's words: the sums of the pairs that each begins, and the number of words before it."""
    part, of = rows["part"][0].as_py(), rows["bucket"].to_numpy()
    sent = [E.unpack(d.as_py()) for d in rows["data"]]
    told, asks = [s for s, b in zip(sent, of, strict=True) if b < 0], [np.cumsum(s[0]) for s, b in zip(sent, of, strict=True) if b >= 0]
    words, place = np.unique(np.concatenate([np.cumsum(s[0]) for s in told]), return_inverse=True)
    sums = [np.bincount(place, E.joined(told, k), len(words)).astype(np.int64) for k in range(1, 6)]
    which, at = np.searchsorted(words, np.concatenate(asks)), E.lengths(asks)
    own = firsts(np.unique(which, return_index=True)[1], len(which))
    out = [(int(b), SINGLE, part, E.pack(*(s[which[i:j]] for s in sums), own[i:j])) for b, i, j in zip(of[of >= 0], at[:-1], at[1:], strict=True)]
    n = sums[4][sums[4] > 0]
    return E.out_rows([*out, (-1, SINGLE, part, E.pack(np.concatenate([few(n), [np.count_nonzero(n >= 3), n.sum(), len(n)]])))])


def logs(x: np.ndarray) -> np.ndarray:
    """Decimal logarithms; 0 of 0."""
    return np.log10(x, out=np.zeros(len(x)), where=x > 0)


def trigram_buckets(lines: DataFrame, each: Callable, schema: str, texts: bool) -> tuple[DataFrame, float]:
    """(each(doc_ids, lines, Bucket, of trigrams, of pairs, of words) of every bucket, probability of the unknown word).

    lines as encoded() takes them. Of trigrams: (which one begins at each place that has one, keys pair << 32 | word, p, written
    here); of pairs: (which one begins at each place, pairs, p, written here, back-off weights); of words: (p, back-off weights,
    known, written here). With texts, buckets have their words, and are told which n-grams to write.
    """
    enc = E.encoded(lines, texts)
    parts = enc.parts
    sent = E.asked(enc, lambda number, b: sent_trigrams(number, b, parts))

    def count(rows: pa.Table) -> pa.Table:  # what buckets ask of words is passed on
        return rows.select(["bucket", "kind", "part", "data"]) if rows["kind"][0].as_py() == SINGLE else count_trigrams(rows, parts, texts)

    grams = materialize(sent.groupBy("kind", "part").applyInArrow(count, E.ROW), "trigram-counts")
    words = materialize(grams.where(F.col("kind") == SINGLE).groupBy("part").applyInArrow(count_words, E.ROW), "word-counts")
    d = {k: discounts_of(dict(zip((1, 2, 3, 4), sum(E.part_values(df, kind), np.zeros(7 if k == 1 else 4, dtype=np.int64)).tolist()))) for k, kind, df in ((3, HISTORIES, grams), (2, PAIRS, grams), (1, SINGLE, words))}
    n1, n2, _, _, n3, total, types = sum(E.part_values(words, SINGLE), np.zeros(7, dtype=np.int64)).tolist()
    even = ((d[1][0] * n1 + d[1][1] * n2 + d[1][2] * n3) / total if total else 1.0) / (types + 1)
    taken = lambda k, n: np.choose(np.minimum(n, 3) - 1, d[k], mode="clip")
    share = lambda k, s: (d[k][0] * s[1] + d[k][1] * s[2] + d[k][2] * s[3]) / np.maximum(s[0], 1)

    def finish(doc_ids, lines, b, found):
        def placed(kind, ks, part):
            order, _ = E.by_part(part, parts)
            out = np.empty((len(ks), len(order)), dtype=np.int64)
            for i, k in enumerate(ks):
                out[i, order] = E.joined(found.get(kind, []), k)
            return out

        s = placed(SINGLE, range(6), b.ids % parts)
        p1 = (s[4] - taken(1, s[4])) / max(total, 1) + even
        b2 = share(2, s)
        pairs, which, at = all_pairs(b)
        part = E.part_of(E.numbered(pairs, b.ids), parts)
        n, own2 = placed(PAIRS, range(2), part)
        p2 = (n - taken(2, n)) / s[0][pairs >> 32] + b2[pairs >> 32] * p1[pairs & E.LOW]
        h = placed(HISTORIES, range(2, 6), part)
        keys, gram = np.unique((which[at] << 32) | b.x[at + 2], return_inverse=True)
        sizes = np.bincount(keys >> 32, minlength=len(pairs))
        order, _ = E.by_part(part, parts)
        places = E.runs((np.cumsum(sizes) - sizes)[order], sizes[order])
        n, own3 = np.empty((2, len(keys)), dtype=np.int64)
        n[places], own3[places] = E.joined(found.get(HISTORIES, []), 0), E.joined(found.get(HISTORIES, []), 1)
        b3, of = share(3, h), keys >> 32
        tail = np.empty(len(keys), dtype=np.int64)
        tail[gram] = which[at + 1]
        p3 = (n - taken(3, n)) / h[0][of] + b3[of] * p2[tail]
        return each(doc_ids, lines, b, (gram, keys, p3, own3), (which, pairs, p2, own2, b3), (p1, b2, s[4] > 0, s[5]))

    return E.answered(enc, [grams.where(F.col("kind") != SINGLE), words], finish, schema), even


def trigram_model(lines: DataFrame) -> DataFrame:
    """estimated() of three orders, of encoded()'s lines."""

    def write(doc_ids, lines, b, trigrams, pairs, single):
        p1, b2, known, own1 = single
        is_start = pc.equal(b.words, START).to_numpy(zero_copy_only=False)
        at = np.flatnonzero((own1 > 0) & (known | is_start))
        word = lambda i: b.words.take(pa.array(i))
        outs = [(1, word(at), np.where(known[at], np.log10(p1[at]), NEVER), logs(b2)[at])]
        _, keys, p3, own3 = trigrams
        _, of, p2, own2, b3 = pairs
        at, weights = np.flatnonzero(own2), logs(b3)
        outs.append((2, pc.binary_join_element_wise(word(of[at] >> 32), word(of[at] & E.LOW), " "), np.log10(p2[at]), weights[at]))
        at = np.flatnonzero(own3)
        h = of[keys[at] >> 32]
        outs.append((3, pc.binary_join_element_wise(word(h >> 32), word(h & E.LOW), word(keys[at] & E.LOW), " "), np.log10(p3[at]), np.zeros(len(at))))
        cols = {"order": pa.concat_arrays([pa.array(np.full(len(g), k, dtype=np.int32)) for k, g, _, _ in outs]), "ngram": pa.concat_arrays([g for _, g, _, _ in outs])}
        return pa.table(cols | {"log10p": np.concatenate([p for _, _, p, _ in outs]), "backoff": np.concatenate([w for _, _, _, w in outs])})

    schema = "order int, ngram string, log10p double, backoff double"
    model, even = trigram_buckets(lines, write, schema, True)
    spark = lines.sparkSession
    others = [(1, UNKNOWN, float(np.log10(even)), 0.0)]
    if not lines.where(F.concat(F.lit(" "), "s", F.lit(" ")).contains(f" {START} ")).head(1):
        others.append((1, START, NEVER, 0.0))
    return model.unionByName(spark.createDataFrame(others, schema))


def own_scores(lines: DataFrame) -> DataFrame:
    """(doc_id, line, n, log10p) of encoded()'s lines by the model of three orders that they give, which is never written.

    Equals backoff_scores() by estimated(): the lines' own model has all their n-grams, so none needs a back-off."""

    def score(doc_ids, lines, b, trigrams, pairs, single):
        n = b.sizes - 1
        p = np.empty(int(n.sum()))
        first = np.zeros(len(p), dtype=bool)
        first[np.cumsum(n) - n] = True
        p[first] = pairs[2][pairs[0][np.cumsum(b.sizes) - b.sizes]]
        p[~first] = trigrams[2][trigrams[0]]
        return E.line_rows(doc_ids, lines, n, np.add.reduceat(np.log10(p), np.cumsum(n) - n))

    kinds = dict(lines.dtypes)
    return trigram_buckets(lines, score, f"doc_id {kinds['doc_id']}, line {kinds['line']}, n bigint, log10p double", False)[0]


def write_arpa(model: DataFrame, path: str) -> None:
    """model as an ARPA text: part files in order, which read_arpa takes as they are, and which put together are one file."""
    sizes = {r["order"]: r["n"] for r in model.groupBy("order").agg(F.count("*").alias("n")).collect()}  # a row an order
    heads = [(0, 0, "\\data\\"), *((0, k, f"ngram {k}={n}") for k, n in sorted(sizes.items())), (max(sizes) + 1, 0, "\\end\\")]
    heads += [(k, 0, f"\n\\{k}-grams:") for k in sizes]
    number = lambda c: F.format_string("%.9f", F.col(c))
    weight = F.when((F.col("order") < max(sizes)) & (F.col("backoff") != 0), F.concat(F.lit("\t"), number("backoff"))).otherwise("")
    lines = model.select("order", F.lit(1).alias("place"), F.concat(number("log10p"), F.lit("\t"), F.col("ngram"), weight).alias("value"))
    lines = lines.union(model.sparkSession.createDataFrame(heads, "order int, place int, value string"))
    lines.orderBy("order", "place", "value").select("value").write.text(path)
