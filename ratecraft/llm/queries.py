"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

import corpus_pipeline
from ratecraft.llm import (audit, bpe, chunks, language, lines, merkle, mixing, periodic, quality, sharding, simhash,
                           toxicity, urlrules)

QUERIES = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_fuzzy_line_dedup": lines.op2_fuzzy_line_dedup,
    "op3_merkle_fingerprints": merkle.op3_merkle_fingerprints,
    "op4_language_id": language.op4_language_id,
    "op5_simhash_near_dedup": simhash.op5_simhash_near_dedup,
    "op6_line_quality": quality.op6_line_quality,
    "op7_byte_bpe": bpe.op7_byte_bpe,
    "op8_source_mixing": mixing.op8_source_mixing,
    "op9_chunk_dedup": chunks.op9_chunk_dedup,
    "op10_rendezvous_sharding": sharding.op10_rendezvous_sharding,
    "op11_periodic_runs": periodic.op11_periodic_runs,
    "op12_filter_audit": audit.op12_filter_audit,
    "op13_url_filters": urlrules.op13_url_filters,
    "pipeline": corpus_pipeline.run,
}

ORACLES = {
    "op3_merkle_fingerprints": merkle.OP3_SQL,
    "op8_source_mixing": mixing.OP8_SQL,
    "op10_rendezvous_sharding": sharding.OP10_SQL,
    "op12_filter_audit": audit.OP12_SQL,
    "op13_url_filters": urlrules.OP13_SQL,
}
