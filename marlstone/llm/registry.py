"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from marlstone.llm import (
    fm_index, language, licences, line_chunks, merkle, mixing, ngram_join, periodic, placement, quality, token_files, topk, toxicity,
)

QUERIES = {
    "op1_language_id": language.op1_language_id,
    "op2_threshold_top_k": topk.op2_threshold_top_k,
    "op4_lookup_sharding": placement.op4_lookup_sharding,
    "op3_ngram_jaccard_join": ngram_join.op3_ngram_jaccard_join,
    "op5_source_mix": mixing.op5_source_mix,
    "op6_line_chunks": line_chunks.op6_line_chunks,
    "op6b_repeated_passages": line_chunks.op6b_repeated_passages,
    "op7_fm_index_decontamination": fm_index.op7_fm_index_decontamination,
    "op8_quality": quality.op8_quality,
    "op9_toxicity": toxicity.op9_toxicity,
    "op10_token_files": token_files.op10_token_files,
    "op11_merkle_manifest": merkle.op11_merkle_manifest,
    "op12_periodic_runs": periodic.op12_periodic_runs,
    "op13_license_scan": licences.op13_license_scan,
}

ORACLES = {
    "op6_line_chunks": line_chunks.OP6_SQL,
    "op2_threshold_top_k": topk.OP2_SQL,
    "op3_ngram_jaccard_join": ngram_join.OP3_SQL,
    "op7_fm_index_decontamination": fm_index.OP7_SQL,
    "op11_merkle_manifest": merkle.OP11_SQL,
    "op13_license_scan": licences.OP13_SQL,
}
