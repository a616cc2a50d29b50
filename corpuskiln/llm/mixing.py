"""Mixing documents to target weights of domains by soft membership. DataFrame functions only.

A naive-Bayes classifier learned from labelled rows gives every document a posterior over domains,
whatever its own label says. Document i gets a rate r_i >= floor (how often it is to be read), so
that the expected tokens of domain d, sum_i p(d | i) * tokens_i * r_i, match the targets. That is a
least-squares problem with one row a domain; its rates are found by projected gradient steps from r = 1,
in the variables r_i * sqrt(tokens_i), with every domain's residual divided by the domain's own tokens: the
posteriors of a document sum to 1, so the largest eigenvalue is then 1 and a step of 1 is always safe. It
is lengthened to 2 / (2 - q) once the first steps have shown by which factor q they shrink the residual. A
step's residuals are one aggregation over the documents and one number a domain on the driver; the rates
are a column.

The classifier's words are all those of a bounded sample (train_rows rows of each domain, smallest hashes of
the id first, whole texts). Their table goes to all tasks if it was measured to take at most TABLE_BYTES, else the
documents' words are joined with it by a shuffle, counted first. Every labelled domain is learned, however many there are.

Defined cases: null and empty texts have no tokens and rate 1; texts without a known word have the
prior of the domains; rows with a null domain aren't
learned from but get a rate; without labelled rows all rates are 1; domains without tokens in the corpus
can't be raised and keep weight 0; targets that can't be met leave a residual, which is returned; rows that
repeat are rated alike; a very long text is split into an array of its words, in the JVM, and counted word
by word; an empty table gives an empty result; further columns of the input are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuskiln.llm.common import if_small, materialize, spread_join, table
from corpuskiln.storage import measured

TRAIN_ROWS = 500
#: Bytes of the table of words up to which every executor holds it; a hash table of it takes about twice that.
TABLE_BYTES = 64_000_000
#: Steps of the projected gradient at most, and the residual at which it stops, as a share of a target.
STEPS, TOLERANCE = 100, 1e-6
#: Steps end too where five of them leave more than this share of the residual: the floor keeps the targets out of reach.
STALLED = 0.98
#: How much of a document's evidence counts: posteriors of long texts stay soft.
EVIDENCE = 0.2
SPACE = r"[\x20\x09-\x0D]+"


def tokens(text: str) -> Column:
    """Words [^\\x20\\x09-\\x0D]+ in lower case."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), SPACE), lambda w: w != "")


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", domain_col: str = "lang", rows: int = TRAIN_ROWS) -> tuple[list[str], dict[str, float], DataFrame | None]:
    """(domains, prior, (word, l array<double>: log-likelihood in each domain)) from labelled rows."""
    named = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"), F.col(domain_col).cast("string").alias("d")).where("d is not null")
    sizes = named.groupBy("d").count().orderBy("d").collect()  # one row a domain
    domains = [r["d"] for r in sizes]
    if not domains:
        return [], {}, None
    total = sum(r["count"] for r in sizes)
    prior = {r["d"]: r["count"] / total for r in sizes}
    place = F.row_number().over(Window.partitionBy("d").orderBy("h", "i"))  # cut down in each task before the shuffle
    picks = named.select("i", "d", F.xxhash64("i").alias("h")).withColumn("n", place).where(F.col("n") <= rows).select(F.col("i").alias("j"), F.col("d").alias("e")).distinct()
    sample = named.join(if_small(materialize(picks, "picks")), F.col("i").eqNullSafe(F.col("j")) & (F.col("d") == F.col("e")), "left_semi")
    counts = materialize(sample.select("d", F.explode(tokens("t")).alias("word")).groupBy("word", "d").count(), "word-counts")
    sums = {r["d"]: r["n"] for r in counts.groupBy("d").agg(F.sum("count").alias("n")).collect()}
    of = F.map_from_entries(F.collect_list(F.struct("d", "count")))
    known = counts.groupBy("word").agg(of.alias("of"))
    size = known.count()
    all_words = F.lit([float(sums.get(d, 0) + 0.5 * size + 1) for d in domains])
    likely = F.transform(F.lit(domains), lambda d, k: F.log((F.coalesce(F.try_element_at("of", d), F.lit(0)) + 0.5) / all_words[k]))
    return domains, prior, materialize(known.select("word", likely.alias("l")), "likelihood")


def posteriors(docs: DataFrame, model: tuple, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, doc_id, tokens, p array<double>): p in the order of the model's domains."""
    domains, prior, likely = model
    rows = docs.select(F.col(id_col).alias("doc_id"), tokens(text_col).alias("w"))
    # all words of a document are in one task: sums are complete before the shuffle
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    seen = rows.select("row", "doc_id", F.size("w").alias("tokens"), F.explode_outer("w").alias("word")).withColumn("n", F.lit(1))
    if measured(likely) <= TABLE_BYTES:
        seen = seen.join(F.broadcast(likely), "word", "left")
    else:
        seen = materialize(seen.groupBy("row", "doc_id", "tokens", "word").agg(F.sum("n").alias("n")), "document-words")
        seen = spread_join(seen, likely, "word", seen.groupBy("word").agg(F.count("*").alias("n")), "row", "left")
    sums = seen.groupBy("row", "doc_id", "tokens").agg(*[F.sum(F.col("n") * F.col("l")[k]).alias(f"s{k}") for k in range(len(domains))])
    logs = F.array(*[F.coalesce(f"s{k}", F.lit(0.0)) * EVIDENCE + F.lit(math.log(prior[d])) for k, d in enumerate(domains)])
    sums = sums.withColumn("g", logs).withColumn("g", F.transform("g", lambda x: F.exp(x - F.array_max("g"))))
    share = F.aggregate("g", F.lit(0.0), lambda a, x: a + x)
    return sums.select("row", "doc_id", F.col("tokens").cast("bigint").alias("tokens"), F.transform("g", lambda x: x / share).alias("p"))


def expected(found: DataFrame, n: int, weight: Column) -> list[float]:
    """Sum of p * weight of each of n domains: one row a domain comes to the driver."""
    got = found.select(F.posexplode("p").alias("k", "x"), weight.alias("w")).groupBy("k").agg(F.sum(F.col("x") * F.col("w")).alias("t")).collect()
    out = [0.0] * n
    for r in got:
        out[r["k"]] = float(r["t"] or 0.0)
    return out


def rates(found: DataFrame, targets: list[float], floor: float = 0.0) -> tuple[DataFrame, list[float], int]:
    """found with a column rate; also the expected totals they reach, and the steps taken.

    found: (…, tokens, p); targets: expected tokens of each domain.
    """
    n = len(targets)
    own = expected(found, n, F.col("tokens").cast("double"))
    scale = [1 / t if t > 0 else 0.0 for t in own]
    now, reached, size, shrink, norms = found.withColumn("rate", F.lit(1.0)), own, 1.0, 0.0, []
    for steps in range(1, STEPS + 1):
        gap = [reached[k] - targets[k] if scale[k] else 0.0 for k in range(n)]
        norm = math.sqrt(sum(g * g * s for g, s in zip(gap, scale, strict=True)))
        met = all(abs(g) <= TOLERANCE * max(t, 1.0) for g, t in zip(gap, targets, strict=True))
        if met or steps == STEPS or (len(norms) >= 10 and norm > STALLED * norms[-5]):
            break
        if norms and norms[-1]:
            if steps <= 6:  # the first steps have length 1
                shrink = max(shrink, min(norm / norms[-1], 0.95))
            elif norm > norms[-1]:
                shrink = 0.0
            size = 2 / (2 - shrink) if steps >= 6 else 1.0
        norms.append(norm)
        move = F.lit([gap[k] * scale[k] * size for k in range(n)])
        step = F.aggregate(F.zip_with("p", move, lambda x, y: x * y), F.lit(0.0), lambda a, x: a + x)
        now = now.withColumn("rate", F.greatest(F.col("rate") - step, F.lit(float(floor))))
        if steps % 5 == 0:
            now = materialize(now, "rates")
        reached = expected(now, n, F.col("tokens") * F.col("rate"))
    return now, reached, steps


def flattened(totals: list[float], power: float) -> list[float]:
    """Targets in proportion to totals ** power, large enough that no domain has to shrink."""
    weight = [t**power if t > 0 else 0.0 for t in totals]
    need = max((t / w for t, w in zip(totals, weight, strict=True) if w), default=0.0)
    return [need * w for w in weight]


def mixed(docs: DataFrame, weights: dict[str, float] | float | None = None, power: float = 0.8, floor: float = 0.0, id_col: str = "doc_id", text_col: str = "text", domain_col: str = "lang") -> tuple[DataFrame, list[str], list[float]]:
    """((row, doc_id, tokens, p, rate, copies), domains, residuals as a share of each domain's target).

    weights: target share of each domain (or one number for every learned domain), of as many tokens as the
    corpus has; residuals over TOLERANCE mean that the steps ended before the targets were met. Without weights the
    targets are the domains' own totals flattened by power, at a size that no domain has to shrink.
    copies is the rate rounded to one of its two neighbours by a hash of the id, right on average.
    """
    model = learn(docs, id_col, text_col, domain_col)
    domains = model[0]
    if not domains:
        rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), F.size(tokens(text_col)).cast("bigint").alias("tokens"))
        return rows.withColumn("p", F.expr("cast(array() as array<double>)")).withColumn("rate", F.lit(1.0)).withColumn("copies", F.lit(1)), [], []
    found = materialize(posteriors(docs, model, id_col, text_col), "posteriors")
    totals = expected(found, len(domains), F.col("tokens").cast("double"))
    if weights is None:
        targets = flattened(totals, power)
    else:
        weights = weights if isinstance(weights, dict) else dict.fromkeys(domains, weights)
        named = sum(weights.get(d, 0.0) for d in domains) or 1.0
        targets = [weights.get(d, 0.0) / named * sum(totals) for d in domains]
    rated, reached, _ = rates(found, targets, floor)
    residuals = [(r - t) / max(t, 1.0) for r, t in zip(reached, targets, strict=True)]
    even = F.pmod(F.xxhash64(F.lit(17), "doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return rated.withColumn("copies", F.floor(F.col("rate") + even).cast("int")), domains, residuals


def op4_mixing(spark, sf_dir: str) -> DataFrame:
    """All documents, mixed to equal weights of their languages: posterior, rate and copies of each, and in every
    row the residual of the mix, the largest miss of a target as a share of it."""
    docs = table(spark, sf_dir, "documents")
    found, domains, residuals = mixed(docs, 1.0)
    names = F.lit(domains) if domains else F.expr("cast(array() as array<string>)")
    return found.select("doc_id", "tokens", F.map_from_arrays(names, "p").alias("posterior"), "rate", "copies", F.lit(float(max(map(abs, residuals), default=0.0))).alias("residual"))


def resampled(docs: DataFrame, power: float = 0.8, id_col: str = "doc_id", text_col: str = "text", domain_col: str = "lang") -> DataFrame:
    """docs, all columns, each row as often as its copies say and never less than once.

    Weak domains are raised towards the targets (flattened totals); no document is lost.
    """
    found, domains, _ = mixed(docs, None, power, 1.0, id_col, text_col, domain_col)
    if not domains:
        return docs
    more = materialize(found.where("copies > 1").select(F.col("doc_id").alias("__id"), F.col("copies").alias("__copies")).groupBy("__id").agg(F.max("__copies").alias("__copies")), "copies")
    both = docs.join(if_small(more), docs[id_col] == more["__id"], "left")
    many = F.explode(F.sequence(F.lit(1), F.coalesce("__copies", F.lit(1)))).alias("__copy")
    return both.select(*docs.columns, many).drop("__copy")
