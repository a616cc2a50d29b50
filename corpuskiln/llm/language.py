"""Language identification of mixed-language text.

Script ranges narrow the candidates of each word to the languages seen in that script, words are
scored by smoothed letter-trigram log-probabilities, and Viterbi with a switching penalty labels
spans. The text's language is the one whose spans hold most letters; the score is its share.

The model is learned from a bounded sample of labelled rows (train_rows per language, smallest
hashes of the id first), whose whole texts are counted in tasks; what comes to the driver is the model, one
number a language and letter trigram. Every language that has a label is learned.

Defined cases: null texts, texts without letters: ``und`` with score 0; letters are those of all of Unicode;
ties between languages go to the first in alphabetical order; without labelled rows every text is ``und``;
rows with a null lang are predicted like others; repeated rows get equal results; an empty table gives an
empty result; further columns of the input, lang and score included, are ignored; a very long text is scored
in pieces cut at white space and then takes some 8 bytes a word and language.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuskiln.llm.common import CHUNK_CHARS, if_small, map_arrow, materialize, table

#: Bound of the training sample: rows a language.
TRAIN_ROWS = 400
#: Log-probability that a change of language between two words costs.
SWITCH = 6.0
BITS = 16
UND = "und"

# fixed values: first code point of each script range and its script number; 0 is no letter script
SCRIPT_STARTS = [0, 0x41, 0x370, 0x400, 0x530, 0x590, 0x600, 0x700, 0x900, 0xE00, 0xE80, 0x10A0, 0x1100, 0x1200, 0x1E00, 0x1F00, 0x2C60, 0x2E80, 0x3040, 0x3100, 0x3400, 0xA000, 0xAC00, 0xD7B0, 0xFB50, 0xFE00, 0xFF00]
SCRIPT_NUMBERS = [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 1, 2, 1, 14, 15, 14, 14, 7, 12, 7, 6, 7, 1]
N_SCRIPTS = 16


@lru_cache(maxsize=1)
def alphabet() -> tuple[np.ndarray, np.ndarray]:
    """For each code point: whether it is a letter, and its lower case."""
    n = sys.maxunicode + 1
    letter = np.zeros(n, dtype=bool)
    lower = np.arange(n, dtype=np.uint32)
    for c in range(n):
        ch = chr(c)
        if ch.isalpha():
            letter[c] = True
            low = ch.lower()
            if len(low) == 1:
                lower[c] = ord(low)
    return letter, lower


@dataclass(frozen=True)
class Words:
    """Words (runs of letters) of a batch of texts, with the trigram slots of each."""

    text: np.ndarray  # number of the text that a word is from
    length: np.ndarray
    script: np.ndarray
    slots: np.ndarray  # trigram slot of every letter
    starts: np.ndarray  # where a word's slots begin


def words_of(texts: list[str | None]) -> Words:
    letter, lower = alphabet()
    joined = "\n".join(t or "" for t in texts)
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    sizes = np.array([len(t or "") + 1 for t in texts], dtype=np.int64)
    is_letter = letter[code]
    code = np.where(is_letter, lower[code], 0)
    padded = np.concatenate(([0], code, [0])).astype(np.uint64)
    slot = (padded[:-2] * np.uint64(0x9E3779B1) + padded[1:-1]) * np.uint64(0x85EBCA77) + padded[2:]
    slot = ((slot * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)).astype(np.int32)
    edge = np.diff(np.concatenate(([0], is_letter.astype(np.int8), [0])))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    length = end - begin
    script = np.array(SCRIPT_NUMBERS)[np.searchsorted(SCRIPT_STARTS, code[begin], side="right") - 1] if len(begin) else np.zeros(0, dtype=np.int64)
    text = np.searchsorted(np.cumsum(sizes), begin, side="right")
    return Words(text, length, script, slot[is_letter], np.concatenate(([0], np.cumsum(length)[:-1])) if len(length) else np.zeros(0, dtype=np.int64))


@dataclass(frozen=True)
class Model:
    langs: list[str]
    table: np.ndarray  # [slot, language] log-probabilities
    allowed: np.ndarray  # [script, language] whether a script was seen in a language

    def scores(self, w: Words) -> np.ndarray:
        """[word, language]; languages that a word's script rules out get a very low score."""
        out = np.add.reduceat(self.table[w.slots], w.starts, axis=0)
        return np.where(self.allowed[w.script], out, np.float32(-1e6))


def counted(texts: list[str | None]) -> np.ndarray:
    """Letters of each trigram slot, then words of each script, over some texts."""
    out = np.zeros((1 << BITS) + N_SCRIPTS, dtype=np.int64)
    for part in in_parts([p for t in texts for p in text_pieces(t or "")]):
        w = words_of(part)
        out += np.concatenate((np.bincount(w.slots, minlength=1 << BITS), np.bincount(w.script, minlength=N_SCRIPTS)))
    return out


def model_of(langs: list[str], counts: np.ndarray) -> Model:
    """A model from the counts [language, slot or script]."""
    letters = np.ones((1 << BITS, max(1, len(langs))), dtype=np.float64) * 0.05
    seen = np.zeros((N_SCRIPTS, max(1, len(langs))), dtype=np.int64)
    if langs:
        letters += counts[:, : 1 << BITS].T
        seen += counts[:, 1 << BITS :].T
    allowed = seen > 0.001 * np.maximum(seen.sum(axis=0), 1)
    allowed[~allowed.any(axis=1)] = True  # a script seen in no language rules none out
    return Model(langs, np.log(letters / letters.sum(axis=0)).astype(np.float32), allowed)


def fit(rows: list[tuple[str, str]]) -> Model:
    """A model of (text, language) rows held in memory."""
    langs = sorted({x for _, x in rows})
    return model_of(langs, np.array([counted([t for t, x in rows if x == lang]) for lang in langs]))


def learn(sample: DataFrame) -> Model:
    """A model of a table (t, l) of texts and languages, counted where the texts are."""

    def each(cols: dict, n: int) -> dict:
        out: dict[str, list] = {"l": [], "slot": [], "n": []}
        for lang in sorted(set(cols["l"])):
            c = counted([t for t, x in zip(cols["t"], cols["l"], strict=True) if x == lang])
            some = np.flatnonzero(c)
            out["l"] += [lang] * len(some)
            out["slot"].append(some)
            out["n"].append(c[some])
        return {"l": out["l"], **{k: np.concatenate(out[k]) if out[k] else [] for k in ("slot", "n")}}

    found = map_arrow(sample.select("t", "l"), "l string, slot int, n bigint", each).groupBy("l", "slot").agg(F.sum("n").alias("n")).toArrow()
    names = found.column("l").to_pylist()
    langs = sorted(set(names))
    counts = np.zeros((len(langs), (1 << BITS) + N_SCRIPTS), dtype=np.int64)
    where = {lang: k for k, lang in enumerate(langs)}
    np.add.at(counts, ([where[x] for x in names], found.column("slot").to_numpy()), found.column("n").to_numpy())
    return model_of(langs, counts)


def viterbi(scores: np.ndarray, counts: np.ndarray, penalty: float) -> np.ndarray:
    """Best language of every word; counts: words of each text, one after another in scores.

    Texts of like length are stepped through together, so that a step is one array operation.
    """
    n_lang = scores.shape[1]
    first = np.concatenate(([0], np.cumsum(counts)[:-1]))
    best = np.zeros(len(scores), dtype=np.int16)
    order = np.argsort(counts, kind="stable")
    order = order[counts[order] > 0]
    at = 0
    while at < len(order):
        end = at + 1
        longest = counts[order[at]]
        while end < len(order) and end - at < 1024 and counts[order[end]] * (end + 1 - at) <= 2_000_000 and counts[order[end]] <= 1.3 * longest + 8:
            end += 1
        part = order[at:end]
        n, begin = counts[part], first[part]
        steps = int(n.max())
        back = np.zeros((steps, len(part)), dtype=np.int16)
        stay = np.ones((steps, len(part), n_lang), dtype=bool)
        v = scores[begin].astype(np.float64)
        for t in range(1, steps):
            on = t < n
            top = v.argmax(axis=1)
            jump = v[np.arange(len(part)), top] - penalty
            keep = v >= jump[:, None]
            step = np.where(keep, v, jump[:, None]) + scores[begin + np.minimum(t, n - 1)]
            v = np.where(on[:, None], step, v)
            back[t], stay[t] = top, keep
        state = v.argmax(axis=1)
        for t in range(steps - 1, -1, -1):
            on = np.flatnonzero(t < n)
            best[begin[on] + t] = state[on]
            if t:
                kept = stay[t, on, state[on]]
                state[on] = np.where(kept, state[on], back[t, on])
        at = end
    return best


def text_pieces(text: str, size: int = CHUNK_CHARS) -> list[str]:
    """A text in pieces of about size, cut at white space, so that no word is cut."""
    out, start = [], 0
    while len(text) - start > size:
        cut = max(text.rfind(c, start, start + size) for c in " \n\t")
        if cut <= start:  # a word longer than a piece
            cut = min((i for c in " \n\t" if (i := text.find(c, start + 1)) > 0), default=len(text))
        out.append(text[start:cut])
        start = cut
    return [*out, text[start:]]


def in_parts(texts: list[str], size: int = CHUNK_CHARS) -> Iterator[list[str]]:
    """Texts in order, few at a time."""
    part, n = [], 0
    for t in texts:
        if part and n + len(t) > size:
            yield part
            part, n = [], 0
        part.append(t)
        n += len(t)
    if part:
        yield part


def predict_batch(model: Model, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    if not model.langs or not texts:
        return [UND] * len(texts), np.zeros(len(texts))
    cut = [text_pieces(t or "") for t in texts]
    owner_of = np.repeat(np.arange(len(texts)), [len(c) for c in cut])
    scores, lengths, owners, at = [], [], [], 0
    for part in in_parts([p for c in cut for p in c]):  # features of few pieces at a time, spans of all together
        w = words_of(part)
        if len(w.text):
            scores.append(model.scores(w))
            lengths.append(w.length)
            owners.append(owner_of[w.text + at])
        at += len(part)
    if not scores:
        return [UND] * len(texts), np.zeros(len(texts))
    owner, length = np.concatenate(owners), np.concatenate(lengths)
    label = viterbi(np.concatenate(scores), np.bincount(owner, minlength=len(texts)), SWITCH)
    n_lang = len(model.langs)
    share = np.bincount(owner * n_lang + label, weights=length, minlength=len(texts) * n_lang).reshape(-1, n_lang)
    total = share.sum(axis=1)
    top = share.argmax(axis=1)
    score = np.where(total > 0, share[np.arange(len(texts)), top] / np.maximum(total, 1), 0.0)
    return [model.langs[i] if n else UND for i, n in zip(top, total, strict=True)], score


def spans_of(model: Model, text: str | None) -> list[tuple[int, int, str]]:
    """(first word, words, language) of the spans of one text; words are runs of letters."""
    w = words_of([text])
    if not model.langs or not len(w.text):
        return []
    label = viterbi(model.scores(w), np.array([len(w.text)]), SWITCH)
    cut = np.concatenate(([0], np.flatnonzero(np.diff(label)) + 1, [len(label)]))
    return [(int(a), int(b - a), model.langs[label[a]]) for a, b in zip(cut[:-1], cut[1:], strict=True)]


def training_rows(docs: DataFrame, allowed, id_col: str, text_col: str, lang_col: str, rows: int) -> DataFrame:
    """(t, l): whole texts of at most ``rows`` rows of each language, those with the smallest hash of their id."""
    labelled = docs.where(allowed & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    few = labelled.select(F.col(id_col).alias("i"), F.col(lang_col).alias("l"), F.xxhash64(id_col).alias("h"))
    place = F.row_number().over(Window.partitionBy("l").orderBy("h", "i"))  # cut down in each task before the shuffle
    wanted = materialize(few.withColumn("place", place).where(F.col("place") <= rows).select(F.col("i").alias("__i")).distinct(), "picks")
    got = labelled.join(if_small(wanted), F.col(id_col).eqNullSafe(F.col("__i")), "left_semi")
    # repeated ids must not break the bound
    first = F.row_number().over(Window.partitionBy("i").orderBy("l", "t"))
    return got.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"), F.col(lang_col).alias("l")).withColumn("n", first).where("n = 1").select("t", "l")


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def each(cols: dict, n: int) -> dict:
        lang, score = predict_batch(shared.value, cols["text"])
        return {"doc_id": cols["doc_id"], "lang_pred": lang, "score": score}

    kind = dict(docs.dtypes)[id_col]
    return map_arrow(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), f"doc_id {kind}, lang_pred string, score double", each, 20 * CHUNK_CHARS)


def spans(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans array<struct<first_word, n_words, lang>>) of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def each(cols: dict, n: int) -> dict:
        rows = [[{"first_word": a, "n_words": b, "lang": c} for a, b, c in spans_of(shared.value, t)] for t in cols["text"]]
        return {"doc_id": cols["doc_id"], "spans": rows}

    kind = dict(docs.dtypes)[id_col]
    return map_arrow(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), f"doc_id {kind}, spans array<struct<first_word: bigint, n_words: bigint, lang: string>>", each)


def held_out(id_col: str = "doc_id"):
    return F.crc32(F.col(id_col).cast("string")) % 3 == 1


def op5_language(spark, sf_dir: str) -> DataFrame:
    """The contract query: learned from rows that are not held out, predicted for all."""
    docs = table(spark, sf_dir, "documents")
    allowed = F.coalesce(~held_out(), F.lit(False))
    model = learn(training_rows(docs, allowed, "doc_id", "text", "lang", TRAIN_ROWS))
    return identify(docs, model).select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score")
