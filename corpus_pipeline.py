"""The corpus pipeline over documents: each stage is written as a table and read again by the next.

1. quality: documents that the line model scores below its threshold go.
2. near_dedup: of each group of near-duplicates the document with the smallest id stays.
3. repeats: word runs that repeat an earlier document's are cut out of the texts.
4. mixing: documents of weak languages are repeated towards flattened target weights; none is lost.
5. bpe: texts become token ids.

All stages but the last return the columns of documents. Rows with null or empty texts pass through
them, as the line model can't judge them; rows with a null id link with nothing and stay; an empty table
stays one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskiln.llm import bpe, mixing, near_dedup, quality, substrings
from corpuskiln.llm.common import materialize, table


def quality_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs less those predicted bad; the model is learned from the labels of this input's documents."""
    return quality.only_good(docs, quality.learn(docs, table(spark, sf_dir, "labels")))


def near_dedup_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.one_of_each(docs)


def repeats_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The count of characters follows the text."""
    return substrings.remove_repeats(docs).withColumn("n_chars", F.length("text").cast("bigint"))


def mixing_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.resampled(docs)


def bpe_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, token_ids, n_tokens, ids_sha256, decoded_sha256)."""
    return bpe.tokenized(docs, bpe.default_vocabulary())


STAGES = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("repeats", repeats_stage),
    ("mixing", mixing_stage),
    ("bpe", bpe_stage),
]

#: The stages learn models and follow links; tests hold them against brute force.
ORACLE_SQL = None


def run(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, f"pipeline-{name}")
    return docs
