"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad; its features describe it and its neighbouring lines. Forward-backward
marginals of "good", weighted by line length, give a document's mean quality, which a logistic
curve fitted on the training rows turns into a probability of label 1.

The model is learned from a bounded sample: train_rows labelled rows of each class, smallest hashes
of the id first. Their whole texts are made features in tasks; of a text of more than TRAIN_LINES lines the
chain is learned from runs of RUN lines that are spread evenly over all of it, so that what comes to the
driver is bounded.

Defined cases: null and empty texts (and texts of blank lines only) score the share of label 1 among the
labelled rows; without labelled rows of both classes every text scores that share (0.5 without any);
repeated label rows of one id count once, with the lowest quality; documents that repeat an id are each
scored, and the least of their texts is learned from; scores that tie need no order; an empty table gives an
empty result; other columns of either table are ignored; a very long text is one sequence, which takes some
80 bytes a character and 400 bytes a line in its task.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskiln.llm.common import CHUNK_CHARS, fmix, map_arrow, release, table

#: Bounds of the training sample: rows of each class, lines of a row, lines of a run where a row has more.
TRAIN_ROWS, TRAIN_LINES, RUN = 2000, 200, 25
#: A document is predicted good from this score on.
THRESHOLD = 0.7
RIDGE = 0.02

# character classes
SPACE, LETTER, UPPER, DIGIT, PLAIN, LOUD, SYMBOL = range(7)
N_OWN, N_NEAR = 11, 6


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """Class of each code point up to the last plane with letters; the others are letters."""
    out = np.full(0x110000, LETTER, dtype=np.int8)
    for c in range(0x30000):
        ch = chr(c)
        if ch.isspace():
            out[c] = SPACE
        elif ch.isupper():
            out[c] = UPPER
        elif ch.isalpha():
            out[c] = LETTER
        elif ch.isdigit():
            out[c] = DIGIT
        elif ch in ".,;:'\"-()’“”«»¿¡–—":
            out[c] = PLAIN
        elif ch in "!?":
            out[c] = LOUD
        elif c < 0x300 or 0x2000 <= c < 0x2C00:
            out[c] = SYMBOL
    return out


@dataclass(frozen=True)
class Lines:
    x: np.ndarray  # [line, feature]
    length: np.ndarray  # characters that are not white space
    counts: np.ndarray  # lines of each text


def sums(x: np.ndarray, line: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(line, weights=x, minlength=n)


def lines_of(texts: list[str | None]) -> Lines:
    """Features of all lines of all texts, computed over the joined characters."""
    texts = [t or "" for t in texts]
    counts = np.array([t.count("\n") + 1 for t in texts], dtype=np.int64)
    code = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    kind = classes()[code]
    ends = np.flatnonzero(code == 10)
    n = len(ends)
    starts = np.concatenate(([0], ends[:-1] + 1))
    line = np.repeat(np.arange(n), ends - starts + 1)
    per = np.bincount(line * 7 + kind, minlength=7 * n).reshape(n, 7).astype(np.float64)
    length = per.sum(axis=1) - per[:, SPACE]
    letters = per[:, LETTER] + per[:, UPPER]
    safe = np.maximum(length, 1)
    # words: runs that are not white space
    solid = kind != SPACE
    edge = np.diff(np.concatenate(([0], solid.astype(np.int8), [0])))
    begin, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    m = len(begin)
    if m:
        place = np.arange(len(code)) - np.repeat(begin, np.diff(np.concatenate((begin, [len(code)])))) if begin[0] == 0 else np.concatenate((np.zeros(begin[0], dtype=np.int64), np.arange(begin[0], len(code)) - np.repeat(begin, np.diff(np.concatenate((begin, [len(code)]))))))
        mixed = np.where(solid, fmix(code.astype(np.uint64) + (place.astype(np.uint64) << np.uint64(21))), np.uint64(0))
        word = np.add.reduceat(mixed, begin)
        at = line[begin]
        words = np.bincount(at, minlength=n).astype(np.float64)
        same = np.concatenate(([False], (word[1:] == word[:-1]) & (at[1:] == at[:-1])))
        repeats = sums(same, at, n)
        owner = fmix(word + fmix(at.astype(np.uint64)))
        distinct = np.bincount(at[np.unique(owner, return_index=True)[1]], minlength=n).astype(np.float64)
        ends_odd = sums(kind[stop - 1] >= LOUD, at, n)
        place_in_line = (np.arange(m) - np.searchsorted(at, at)).astype(np.uint64)
        line_hash = np.zeros(n, dtype=np.uint64)
        np.add.at(line_hash, at, fmix(word + place_in_line))
    else:
        words = repeats = ends_odd = np.zeros(n)
        distinct, line_hash = np.zeros(n), np.zeros(n, dtype=np.uint64)
    some = np.maximum(words, 1)
    doc = np.repeat(np.arange(len(texts)), counts)
    first = np.unique(fmix(line_hash + fmix(doc.astype(np.uint64))), return_index=True)[1]
    again = np.ones(n)
    again[first] = 0
    again[length == 0] = 0
    own = np.stack(
        [
            per[:, UPPER] / np.maximum(letters, 1), per[:, SYMBOL] / safe, per[:, LOUD] / safe, repeats / some,
            np.where(words > 0, 1 - distinct / some, 0), ends_odd / some, per[:, DIGIT] / safe, per[:, PLAIN] / safe,
            np.log1p(length) / 8, np.minimum(length / some, 40) / 20, again,
        ], axis=1,
    )
    near = own[:, :N_NEAR]
    is_first = np.concatenate(([True], doc[1:] != doc[:-1]))
    is_last = np.concatenate((doc[1:] != doc[:-1], [True]))
    before = np.where(is_first[:, None], 0, np.roll(near, 1, axis=0))
    after = np.where(is_last[:, None], 0, np.roll(near, -1, axis=0))
    return Lines(np.concatenate((np.ones((n, 1)), own, before, after), axis=1), length, counts)


def lines_in_parts(texts: list[str], chunk: int = CHUNK_CHARS) -> Lines:
    """The same for many texts, few at a time: only the lines' features are held together."""
    parts, at = [], 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= chunk):
            size += len(texts[end])
            end += 1
        parts.append(lines_of(texts[at:end]))
        at = end
    return Lines(*(np.concatenate([getattr(p, k) for p in parts]) for k in ("x", "length", "counts")))


def grouped(counts: np.ndarray, cells: int = 400_000):
    """Texts in groups of like numbers of lines: (texts, first line of each, lines of each)."""
    first = np.concatenate(([0], np.cumsum(counts)[:-1]))
    order = np.argsort(counts, kind="stable")
    at = 0
    while at < len(order):
        end = at + 1
        while end < len(order) and counts[order[end]] * (end + 1 - at) <= cells and counts[order[end]] <= 1.3 * counts[order[at]] + 8:
            end += 1
        part = order[at:end]
        yield part, first[part], counts[part]
        at = end


def forward_backward(unary: np.ndarray, counts: np.ndarray, trans: np.ndarray):
    """Marginals of state 1 of every line and the expected transitions [2, 2]; unary: score of state 1."""
    marginal = np.zeros(len(unary))
    pairs = np.zeros((2, 2))
    norm = 0.0
    for part, begin, n in grouped(counts):
        steps, rows = int(n.max()), len(part)
        u = np.zeros((steps, rows, 2))
        for t in range(steps):
            u[t, :, 1] = unary[begin + np.minimum(t, n - 1)]
        a = np.zeros((steps, rows, 2))
        b = np.zeros((steps, rows, 2))
        a[0] = u[0]
        for t in range(1, steps):
            on = (t < n)[:, None]
            nxt = np.logaddexp(a[t - 1, :, :1] + trans[0], a[t - 1, :, 1:] + trans[1]) + u[t]
            a[t] = np.where(on, nxt, a[t - 1])
        z = np.logaddexp(a[-1, :, 0], a[-1, :, 1])
        norm += z.sum()
        for t in range(steps - 2, -1, -1):
            on = (t + 1 < n)[:, None]
            c = u[t + 1] + b[t + 1]
            nxt = np.stack([np.logaddexp(trans[s, 0] + c[:, 0], trans[s, 1] + c[:, 1]) for s in (0, 1)], axis=1)
            b[t] = np.where(on, nxt, 0)
            live = on[:, 0]
            if live.any():
                for s in (0, 1):
                    for r in (0, 1):
                        pairs[s, r] += np.exp(a[t, live, s] + trans[s, r] + c[live, r] - z[live]).sum()
        post = np.exp(a[:, :, 1] + b[:, :, 1] - z)
        for t in range(steps):
            on = np.flatnonzero(t < n)
            marginal[begin[on] + t] = post[t, on]
    return np.clip(marginal, 0, 1), pairs, norm


@dataclass(frozen=True)
class Model:
    w: np.ndarray  # feature weights of state good
    trans: np.ndarray
    curve: tuple[float, float]  # logistic curve over the mean marginal
    base: float  # score of texts without content

    def score(self, texts: list[str | None]) -> np.ndarray:
        return self.judged(texts)[0]

    def judged(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(scores, whether each could be judged: there is a model, and the text has content)."""
        if not len(self.w) or not texts:
            return np.full(len(texts), self.base), np.zeros(len(texts), dtype=bool)
        mean, weight = self.mean_marginals(texts)
        return np.where(weight > 0, sigmoid(self.curve[0] * mean + self.curve[1]), self.base), weight > 0

    def mean_marginals(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        f = lines_in_parts([t or "" for t in texts], CHUNK_CHARS)
        good, _, _ = forward_backward(f.x @ self.w, f.counts, self.trans)
        doc = np.repeat(np.arange(len(texts)), f.counts)
        weight = sums(f.length, doc, len(texts))
        return sums(good * f.length, doc, len(texts)) / np.maximum(weight, 1), weight


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float, rounds: int = 30) -> np.ndarray:
    """Ridge logistic regression by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = sigmoid(x @ w)
        g = x.T @ (weight * (y - p)) - ridge * w
        h = (x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


@dataclass(frozen=True)
class Example:
    """What is learned from a text: the features and lengths of its lines, and how many lines each run has."""

    label: int
    x: np.ndarray
    length: np.ndarray
    runs: np.ndarray


def examples(texts: list[str], labels: list[int]) -> list[Example]:
    """Of texts of more than TRAIN_LINES lines runs of RUN lines spread over the text."""
    f = lines_in_parts(texts)
    out = []
    for label, end, n in zip(labels, np.cumsum(f.counts), f.counts, strict=True):
        if n <= TRAIN_LINES:
            at, runs = np.arange(end - n, end), np.array([n])
        else:
            begin = np.linspace(0, n - RUN, TRAIN_LINES // RUN).astype(np.int64)
            at, runs = (end - n + begin[:, None] + np.arange(RUN)).ravel(), np.full(len(begin), RUN)
        out.append(Example(label, f.x[at], f.length[at], runs))
    return out


def fit(rows: list[tuple[str, int]], base: float = 0.5, rounds: int = 120) -> Model:
    """A model of (text, label) rows held in memory; base: share of label 1 where it is known better."""
    return fit_examples(examples([t for t, _ in rows], [y for _, y in rows]) if rows else [], base, rounds)


def fit_examples(rows: list[Example], base: float = 0.5, rounds: int = 120) -> Model:
    y = np.array([r.label for r in rows], dtype=np.float64)
    if not len(y) or y.min() == y.max():
        return Model(np.zeros(0), np.zeros((2, 2)), (0.0, 0.0), float(base))
    # the rarer class is repeated to about the size of the other, so that neither drowns
    rare = float(y.mean() < 0.5)
    again = int((y != rare).sum() // (y == rare).sum()) - 1
    rows = [*rows, *([r for r in rows if r.label == rare] * again)]
    y = np.array([r.label for r in rows], dtype=np.float64)
    x, length, runs = (np.concatenate([getattr(r, k) for r in rows]) for k in ("x", "length", "runs"))
    doc = np.repeat(np.arange(len(rows)), [len(r.length) for r in rows])
    # lines start with their document's label; in bad documents those that look good become good,
    # but for the worst line of each
    w = logistic(x, y[doc], length / max(length.mean(), 1), RIDGE)
    p = sigmoid(x @ w)
    worst = np.full(len(rows), np.inf)
    np.minimum.at(worst, doc, p)
    line_y = np.where(y[doc] == 1, 1.0, ((p > 0.5) & (p > worst[doc])).astype(float))
    w = logistic(x, line_y, np.ones(len(p)), RIDGE)
    # conditional likelihood of the chains by Adam
    run = np.repeat(np.arange(len(runs)), runs)
    follows = run[1:] == run[:-1]
    state = line_y.astype(int)
    seen = np.zeros((2, 2))
    np.add.at(seen, (state[:-1][follows], state[1:][follows]), 1)
    trans = np.zeros((2, 2))
    m = v = np.zeros(len(w) + 4)
    for k in range(1, rounds + 1):
        good, pairs, _ = forward_backward(x @ w, runs, trans)
        g = np.concatenate((x.T @ (line_y - good) - RIDGE * w, (seen - pairs).ravel() - RIDGE * trans.ravel())) / len(rows)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        step = 0.1 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)
        w, trans = w + step[: len(w)], trans + step[len(w) :].reshape(2, 2)
    good, _, _ = forward_backward(x @ w, runs, trans)
    weight = sums(length, doc, len(rows))
    ok = weight > 0
    mean = sums(good * length, doc, len(rows))[ok] / weight[ok]
    share = y[ok].mean()
    prior = np.where(y[ok] == 1, base / max(share, 1e-6), (1 - base) / max(1 - share, 1e-6)) if 0 < base < 1 else np.ones(ok.sum())
    curve = logistic(np.stack((mean, np.ones(ok.sum())), axis=1), y[ok], prior, 0.05)
    return Model(w, trans, (float(curve[0]), float(curve[1])), float(base))


def learn(docs: DataFrame, labels: DataFrame, allowed=None, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", rows: int = TRAIN_ROWS) -> Model:
    """Fit on a bounded sample; allowed: condition on the label table's id column."""
    marked = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
    marked = marked.where(allowed) if allowed is not None else marked
    marked = marked.groupBy(F.col(id_col).alias("i")).agg(F.min(label_col).cast("int").alias("y"))
    share = marked.agg(F.avg("y").alias("p")).first()["p"]
    if share is None:
        return fit([], 0.5)
    picks = [(r["i"], y) for y in (0, 1) for r in marked.where(F.col("y") == y).orderBy(F.xxhash64("i"), "i").limit(rows).collect()]
    wanted = docs.sparkSession.createDataFrame(picks, f"i {dict(labels.dtypes)[id_col]}, y int")
    got = docs.select(F.col(id_col).alias("d"), F.col(text_col).alias("t")).where("t is not null")
    got = got.join(F.broadcast(wanted), F.col("d") == F.col("i")).groupBy("i", "y").agg(F.min("t").alias("t"))

    def each(cols: dict, n: int) -> dict:
        made = examples(cols["t"], cols["y"])
        return {
            "i": cols["i"], "y": cols["y"], "x": [e.x.astype(np.float64).tobytes() for e in made],
            "length": [e.length.astype(np.float64).tobytes() for e in made], "runs": [e.runs.tolist() for e in made],
        }

    found = map_arrow(got, f"i {dict(labels.dtypes)[id_col]}, y int, x binary, length binary, runs array<int>", each).toArrow().to_pylist()
    found.sort(key=lambda r: (r["y"], r["i"]))
    as_floats = lambda b: np.frombuffer(b, dtype=np.float64)
    return fit_examples([Example(r["y"], as_floats(r["x"]).reshape(len(r["length"]) // 8, -1), as_floats(r["length"]), np.array(r["runs"])) for r in found], share)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, predicted) of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def each(cols: dict, n: int) -> dict:
        s = shared.value.score(cols["text"])
        return {"doc_id": cols["doc_id"], "score": s, "predicted": (s >= THRESHOLD).astype(np.int32)}

    kind = dict(docs.dtypes)[id_col]
    return map_arrow(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), f"doc_id {kind}, score double, predicted int", each)


def only_good(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of docs, all columns, that aren't predicted bad; what the model cannot judge (there is none, or a
    text without content) stays."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def good(texts: pd.Series) -> pd.Series:
        values, out, at = texts.tolist(), [], 0
        while at < len(values):
            end, size = at, 0
            while end < len(values) and (end == at or size + len(values[end] or "") <= CHUNK_CHARS):
                size += len(values[end] or "")
                end += 1
            score, known = shared.value.judged(values[at:end])
            out.append((score >= THRESHOLD) | ~known)
            at = end
        release()
        return pd.Series(np.concatenate(out) if out else np.zeros(0, dtype=bool))

    return docs.where(good(F.col(text_col)))


def held_out(id_col: str = "doc_id"):
    return F.crc32(F.col(id_col).cast("string")) % 4 == 2


def op9_quality(spark, sf_dir: str) -> DataFrame:
    """The contract query: learned from label rows that are not held out, scored for all documents."""
    docs = table(spark, sf_dir, "documents")
    model = learn(docs, table(spark, sf_dir, "labels"), ~held_out())
    return score(docs, model).select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", "predicted")
