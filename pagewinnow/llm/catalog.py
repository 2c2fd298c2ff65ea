"""Queries of this subpackage and their SQL twins."""

from __future__ import annotations

from pagewinnow.llm import (
    conversations,
    knn,
    links,
    mixing,
    negatives,
    packing,
    pair_index,
    quality_classifier,
    quality_rules,
    simhash,
    substrings,
    toxicity,
    warc,
)

QUERIES = {
    "op1_quality_rules": quality_rules.query,
    "op2_substring_dedup": substrings.query,
    "op3_toxicity": toxicity.query,
    "op4_mixing": mixing.query,
    "op5_quality_classifier": quality_classifier.query,
    "op6_warc": warc.query,
    "op7_exact_top_k": knn.query,
    "op8_url_filters": links.query,
    "op9_simhash_near_dedup": simhash.query,
    "op10_packing": packing.query,
    "op11_conversation_repair": conversations.query,
    "op12_hard_negatives": negatives.query,
    "op13_pair_index": pair_index.query,
}
#: the others can't be expressed in SQL: trained models, a tokenizer, a hash that the other engine lacks
ORACLES = {
    "op2_substring_dedup": substrings.ORACLE,
    "op4_mixing": mixing.oracle(),
    "op6_warc": warc.ORACLE,
    "op7_exact_top_k": knn.ORACLE,
    "op8_url_filters": links.oracle(),
    "op12_hard_negatives": negatives.ORACLE,
}
