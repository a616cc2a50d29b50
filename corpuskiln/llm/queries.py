"""The subpackage's registered queries and their DuckDB SQL."""

from __future__ import annotations

from corpuskiln.llm.bpe import op8_bpe
from corpuskiln.llm.centroids import OP12_SQL, op12_centroids
from corpuskiln.llm.decontamination import OP11_SQL, op11_decontamination
from corpuskiln.llm.embeddings import op7_embeddings
from corpuskiln.llm.fingerprint import op10_fingerprint
from corpuskiln.llm.language import op5_language
from corpuskiln.llm.mixing import op4_mixing
from corpuskiln.llm.near_dedup import op1_minhash
from corpuskiln.llm.quality import op9_quality
from corpuskiln.llm.resampling import OP13_SQL, op13_resampling
from corpuskiln.llm.sharding import OP2_SQL, op2_sharding
from corpuskiln.llm.substrings import op6_substrings
from corpuskiln.llm.warc import OP3_SQL, op3_warc

QUERIES = {
    "op1_minhash": op1_minhash,
    "op2_sharding": op2_sharding,
    "op3_warc": op3_warc,
    "op4_mixing": op4_mixing,
    "op5_language": op5_language,
    "op6_substrings": op6_substrings,
    "op7_embeddings": op7_embeddings,
    "op8_bpe": op8_bpe,
    "op9_quality": op9_quality,
    "op10_fingerprint": op10_fingerprint,
    "op11_decontamination": op11_decontamination,
    "op12_centroids": op12_centroids,
    "op13_resampling": op13_resampling,
}

ORACLE_SQL: dict[str, str] = {
    "op2_sharding": OP2_SQL,
    "op3_warc": OP3_SQL,
    "op11_decontamination": OP11_SQL,
    "op12_centroids": OP12_SQL,
    "op13_resampling": OP13_SQL,
}
