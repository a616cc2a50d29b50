import hashlib
import random

import numpy as np
import pytest
from corpuskiln.llm import bpe
from corpuskiln.llm.common import table
from tokenizers import Tokenizer


@pytest.fixture(scope="module")
def both():
    path = bpe.default_vocabulary()
    return bpe.encoder(path), Tokenizer.from_file(path)


def test_documents_match_the_library(spark, sf, both):
    texts = {r["doc_id"]: r["text"] for r in table(spark, sf, "documents").collect()}
    for r in bpe.op8_bpe(spark, sf).collect():
        ids = both[1].encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        text = both[1].decode(ids, skip_special_tokens=False)
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def test_odd_texts_match_the_library(both):
    rnd = random.Random(1)
    alphabet = "abcxyzABC ÉéßΣσςİıDŽ'sll'RE'Ve 0123٣½²́ \u0085\x1c\x0b日本語한글😀<|>startoftext_-|.,\n\t​﻿　ﬁÅ"
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40))) + rnd.choice(["", "<|endoftext|>", " <|startoftext|>x"]) for _ in range(3000)]
    texts += ["a" * 5000, "qz" * 3000, "é" * 2000, "the" * 2000, "ab" * 33 + "c"]
    for t in texts:
        ids = both[1].encode(t, add_special_tokens=False).ids
        got, text = both[0].both(t)
        assert np.frombuffer(got, dtype="<u4").tolist() == ids and text == both[1].decode(ids, skip_special_tokens=False)
        assert both[0].decode(ids) == text


def test_short_and_long_merges_agree(both):
    rnd = random.Random(2)
    for _ in range(500):
        parts = [rnd.choice("etaoinshr") for _ in range(rnd.randint(1, 60))]
        assert both[0].merge_short(list(parts)) == both[0].merge_long(list(parts))


def test_cuts_are_forced(both):
    inside = both[0].inside
    assert any((a, b) not in inside for a in "qxzjw" for b in "qxzjw")
    assert both[0].fragments("theqzthe") == (["theq", "zthe"] if ("q", "z") not in inside else ["theqzthe"])


def test_nulls_repeats_empty_table_and_clashing_columns(spark):
    path = bpe.default_vocabulary()
    df = spark.createDataFrame([(1, None, "x"), (1, None, "x"), (2, "", "x"), (None, "hi hi", "x")], "doc_id long, text string, token_ids string")
    rows = bpe.encode(df, path).collect()
    assert sorted(len(r["token_ids"]) for r in rows) == [0, 0, 0, 2]
    assert {r["decoded"] for r in bpe.decode(bpe.encode(df, path), path).collect()} == {"", "hi</w> hi</w>"}
    assert bpe.digests(df.limit(0), path).collect() == []
    assert {r["n_tokens"] for r in bpe.tokenized(df, path).collect()} == {0, 2}


def test_chunks_of_lines(spark):
    from corpuskiln.llm import bpe

    path = bpe.default_vocabulary()
    lines = spark.createDataFrame([("f", i, f"line {i} of text") for i in range(7)] + [("g", 0, None)], "file string, pos long, value string")
    got = {(r["file"], r["chunk"]): r["token_ids"] for r in bpe.encoded_chunks(lines, path, 3).collect()}
    joined = {("f", k): "\n".join(f"line {i} of text" for i in range(7)[3 * k : 3 * k + 3]) for k in range(3)}
    e = bpe.encoder(path)
    import numpy as np

    assert {k: got[k] for k in joined} == {k: np.frombuffer(e.both(t)[0], dtype="<u4").tolist() for k, t in joined.items()} and got["g", 0] == []


def test_files_that_ask_for_other_steps_are_refused(tmp_path):
    import json

    spec = json.load(open(bpe.default_vocabulary(), encoding="utf-8"))
    bpe.understood(spec)
    for key, value in (("normalizer", None), ("decoder", {"type": "BPEDecoder", "suffix": "</w>"}), ("pre_tokenizer", None), ("model", spec["model"] | {"byte_fallback": True})):
        with pytest.raises(ValueError):
            bpe.understood(spec | {key: value})


def test_texts_come_from_their_ids(both):
    """The decoder sees nothing but ids: other ids give another text, whatever was encoded before."""
    ids, text = both[0].both("Hello there <|endoftext|> world")
    array = np.frombuffer(ids, dtype="<u4").tolist()
    assert text == both[1].decode(array, skip_special_tokens=False)
    assert both[0].decode(array[::-1]) == both[1].decode(array[::-1], skip_special_tokens=False) and both[0].decode([*array, 10**6]) == text
