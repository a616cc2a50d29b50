"""BPE encoding and decoding by forced-boundary splitting.

A pair of neighbouring byte symbols that occurs inside no vocabulary token can never end up inside
one token, so the text is cut there and the fragments are encoded independently and concatenated.
Decoding goes from the ids: their tokens, joined by one space, as files without a decoder say.
The vocabulary is a tokenizers-library BPE file with word ends; its path is a parameter, and a file with another
normaliser, pre-tokenizer, decoder or merge rule than those built here is an error.

Defined cases: null and empty texts give no ids and an empty decoded text; the strings of special
tokens in a text become their ids, as the library does by default; of pairs of equal rank the leftmost is
joined first; repeated rows are encoded alike; a very long text is encoded in one task and takes some 100
bytes a character there; an empty table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskiln.llm.common import map_arrow, table

#: Entries of a worker's cache of encoded pieces; it is cleared when full.
CACHE = 350_000
#: Fragments up to this many symbols are merged by scanning a short list.
SHORT = 64
NONE = 1 << 60

# fixed values: the byte alphabet of byte-level BPE: printable bytes stand for themselves,
# the others are moved to 256 and on
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]


def byte_symbols() -> list[str]:
    moved = iter(range(256, 512))
    return [chr(b) if b in PRINTABLE else chr(next(moved)) for b in range(256)]


# fixed values: what the file has to say of the steps around the merges
EXPECTED = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "byte_level": {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    "split": {"behavior": "Removed", "invert": True},
    "decoder": None,
    "model": {"type": "BPE", "dropout": None, "continuing_subword_prefix": None, "byte_fallback": False, "ignore_merges": False},
}


def understood(spec: dict) -> None:
    """Raise ValueError where the file asks for steps that this module doesn't have."""
    pre = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}, {}]
    got = {
        "normalizer": spec.get("normalizer"), "byte_level": pre[-1], "split": {k: pre[0].get(k) for k in EXPECTED["split"]},
        "decoder": spec.get("decoder"), "model": {k: spec["model"].get(k) for k in EXPECTED["model"]},
    }
    for name, value in EXPECTED.items():
        if got[name] != value or len(pre) != 2:
            raise ValueError(f"{name} of the vocabulary file: {got[name]!r} instead of {value!r}")


class ForcedBoundaryBPE:
    """Encoder and decoder for one vocabulary file; one per Python worker."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        understood(spec)
        model = spec["model"]
        self.end = model["end_of_word_suffix"] or ""
        self.vocab: dict[str, int] = model["vocab"]
        self.rank = {tuple(m): i for i, m in enumerate(model["merges"])}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        pre = spec["pre_tokenizer"]["pretokenizers"]
        self.pieces = regex.compile(pre[0]["pattern"]["Regex"]).findall
        symbols = byte_symbols()
        self.to_symbols = {i: symbols[i] for i in range(256)}
        # a pair may be joined only if it stands side by side in some token
        inside = set()
        for token in self.vocab:
            body = token.removesuffix(self.end) if self.end and token != self.end else token
            inside.update(zip(body, body[1:], strict=False))
        self.inside = inside
        self.by_piece: dict[str, bytes] = {}

    def normalize(self, text: str) -> str:
        """NFC, white space to one space, lower case character by character (no final-sigma rule)."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return text.lower()

    def fragments(self, word: str) -> list[str]:
        """The byte symbols of a word cut at every pair that no token holds."""
        out, start = [], 0
        for i in range(1, len(word)):
            if (word[i - 1], word[i]) not in self.inside:
                out.append(word[start:i])
                start = i
        out.append(word[start:])
        return out

    def merge(self, fragment: str, last: bool) -> list[str]:
        """Tokens of one fragment: the pair of lowest rank is joined again and again."""
        parts = list(fragment)
        if last:
            parts[-1] += self.end
        return self.merge_short(parts) if len(parts) <= SHORT else self.merge_long(parts)

    def merge_short(self, parts: list[str]) -> list[str]:
        """Joins the pair of lowest rank, leftmost first, until no pair has a rank."""
        get = self.rank.get
        ranks = [get(p, NONE) for p in zip(parts, parts[1:], strict=False)]
        while ranks and (low := min(ranks)) != NONE:
            i = ranks.index(low)
            parts[i] += parts.pop(i + 1)
            del ranks[i]
            if i:
                ranks[i - 1] = get((parts[i - 1], parts[i]), NONE)
            if i < len(ranks):
                ranks[i] = get((parts[i], parts[i + 1]), NONE)
        return parts

    def merge_long(self, parts: list[str]) -> list[str]:
        """The same order by a heap over linked symbols: n log n for very long fragments."""
        n, get = len(parts), self.rank.get
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap = [(r, i, p) for i, p in enumerate(zip(parts, parts[1:], strict=False)) if (r := get(p)) is not None]
        heapify(heap)
        while heap:
            _, i, pair = heappop(heap)
            j = after[i] if parts[i] is not None else -1
            if j < 0 or (parts[i], parts[j]) != pair:
                continue
            parts[i] += parts[j]
            parts[j], after[i] = None, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for left in (before[i], i):
                right = after[left] if left >= 0 else -1
                if right >= 0 and (r := get(p := (parts[left], parts[right]))) is not None:
                    heappush(heap, (r, left, p))
        return [p for p in parts if p is not None]

    def piece(self, piece: str) -> bytes:
        """Ids of one piece as little-endian unsigned 32-bit integers."""
        known = self.by_piece.get(piece)
        if known is None:
            cut = self.fragments(piece.encode("utf-8").decode("latin-1").translate(self.to_symbols))
            known = b"".join(self.vocab[t].to_bytes(4, "little") for i, f in enumerate(cut) for t in self.merge(f, i == len(cut) - 1))
            if len(self.by_piece) >= CACHE:
                self.by_piece.clear()
            self.by_piece[piece] = known
        return known

    def encode(self, text: str | None) -> bytes:
        """Ids of a text, as those of a piece."""
        if not text:
            return b""
        out, get, make = [], self.by_piece.get, self.piece
        for part in self.split_special.split(text) if self.split_special else [text]:
            if part in self.special:
                out.append(self.special[part].to_bytes(4, "little"))
            elif part:
                out += [get(p) or make(p) for p in self.pieces(self.normalize(part))]
        return b"".join(out)

    def decode(self, ids: list[int]) -> str:
        """What the library's decode(ids, skip_special_tokens=False) gives; ids of no token are left out."""
        get = self.tokens.get
        return " ".join([t for i in ids if (t := get(i)) is not None])

    def both(self, text: str | None) -> tuple[bytes, str]:
        """Ids of a text, and the text that these ids decode to."""
        ids = self.encode(text)
        return ids, self.decode(np.frombuffer(ids, dtype="<u4").tolist())


@lru_cache(maxsize=2)
def encoder(path: str) -> ForcedBoundaryBPE:
    return ForcedBoundaryBPE(path)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, token_ids array<int>, decoded string) of every whole text. See the module for null and empty texts."""
    def each(cols: dict, n: int) -> dict:
        e = encoder(path)
        got = [e.both(t) for t in cols["text"]]
        return {"doc_id": cols["doc_id"], "token_ids": [np.frombuffer(a, dtype="<u4").astype(np.int32) for a, _ in got], "decoded": [b for _, b in got]}

    kind = dict(docs.dtypes)[id_col]
    return map_arrow(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), f"doc_id {kind}, token_ids array<int>, decoded string", each)


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "token_ids") -> DataFrame:
    """(id, decoded string) of arrays of ids; a null array decodes to the empty text."""

    def each(cols: dict, n: int) -> dict:
        e = encoder(path)
        return {"doc_id": cols["doc_id"], "decoded": [e.decode(x or []) for x in cols["ids"]]}

    kind = dict(encoded.dtypes)[id_col]
    return map_arrow(encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids")), f"doc_id {kind}, decoded string", each)


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: n_tokens, and SHA-256 of its ids (little-endian uint32) and of its decoded text."""

    def each(cols: dict, n: int) -> dict:
        e, sha = encoder(path), hashlib.sha256
        got = [e.both(t) for t in cols["text"]]
        return {
            "doc_id": cols["doc_id"], "n_tokens": [len(a) // 4 for a, _ in got],
            "ids_sha256": [sha(a).hexdigest() for a, _ in got], "decoded_sha256": [sha(b.encode("utf-8")).hexdigest() for _, b in got],
        }

    kind = dict(docs.dtypes)[id_col]
    return map_arrow(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string", each)


def tokenized(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, token_ids, n_tokens, ids_sha256, decoded_sha256), a row for every row of docs."""
    def each(cols: dict, n: int) -> dict:
        e, sha = encoder(path), hashlib.sha256
        got = [e.both(t) for t in cols["text"]]
        return {
            "doc_id": cols["doc_id"], "token_ids": [np.frombuffer(a, dtype="<u4").astype(np.int32) for a, _ in got], "n_tokens": [len(a) // 4 for a, _ in got],
            "ids_sha256": [sha(a).hexdigest() for a, _ in got], "decoded_sha256": [sha(b.encode("utf-8")).hexdigest() for _, b in got],
        }

    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return map_arrow(rows, f"doc_id {kind}, token_ids array<int>, n_tokens bigint, ids_sha256 string, decoded_sha256 string", each)


def encoded_chunks(lines: DataFrame, path: str, size: int, file: str = "file", pos: str = "pos", value: str = "value") -> DataFrame:
    """(file, chunk, token_ids): every so many lines of a file joined and encoded together."""
    from corpuskiln.operators.packing import line_chunks

    chunks = line_chunks(lines, size, file, pos, value)
    return map_arrow(chunks.select(F.col(file).cast("string").alias("file"), "chunk", "text"), "file string, chunk bigint, token_ids array<int>", lambda cols, n: {
        "file": cols["file"], "chunk": cols["chunk"], "token_ids": [np.frombuffer(encoder(path).encode(t), dtype="<u4").astype(np.int32) for t in cols["text"]],
    })


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op8_bpe(spark, sf_dir: str) -> DataFrame:
    """The contract query: every whole text of documents, encoded and decoded."""
    return digests(table(spark, sf_dir, "documents"), default_vocabulary())
