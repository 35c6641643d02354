"""Registered queries of the corpus operators, and their SQL where there is one."""

from __future__ import annotations

from wattline.llm import (
    bpe,
    filter_audit,
    fingerprints,
    mixing,
    near_vectors,
    ngram_join,
    quality,
    sharding,
    spelling,
    token_counts,
    topk,
    url_filters,
    warc,
)

QUERIES = {
    "op1_sharding": sharding.op1_sharding,
    "op2_quality": quality.op2_quality,
    "op3_url_filters": url_filters.op3_url_filters,
    "op4_ngram_join": ngram_join.op4_ngram_join,
    "op5_warc": warc.op5_warc,
    "op6_topk": topk.op6_topk,
    "op7_bpe": bpe.op7_bpe,
    "op8_token_counts": token_counts.op8_token_counts,
    "op9_mixing": mixing.op9_mixing,
    "op10_near_vectors": near_vectors.op10_near_vectors,
    "op11_spelling": spelling.op11_spelling,
    "op12_filter_audit": filter_audit.op12_filter_audit,
    "op13_fingerprints": fingerprints.op13_fingerprints,
}

ORACLE = {
    "op3_url_filters": url_filters.OP3_SQL,
    "op4_ngram_join": ngram_join.OP4_SQL,
    "op5_warc": warc.OP5_SQL,
    "op6_topk": topk.OP6_SQL,
    "op9_mixing": mixing.OP9_SQL,
    "op10_near_vectors": near_vectors.OP10_SQL,
    "op12_filter_audit": filter_audit.OP12_SQL,
}
