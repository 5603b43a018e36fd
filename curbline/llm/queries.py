"""Registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from curbline.llm import (
    decontamination, line_dedup, merkle, mixture, ngram_join, personal_data, secrets, substring_dedup, token_counts,
    token_planes, toxicity, vector_dedup, whitening,
)

QUERIES = {
    "op1_ngram_join": ngram_join.query,
    "op2_substring_dedup": substring_dedup.query,
    "op3_secret_scan": secrets.query,
    "op4_mixture": mixture.query,
    "op5_vector_dedup": vector_dedup.query,
    "op6_line_dedup": line_dedup.query,
    "op7_toxicity": toxicity.query,
    "op8_decontamination": decontamination.query,
    "op9_token_counts": token_counts.query,
    "op10_token_planes": token_planes.query,
    "op11_whitening": whitening.query,
    "op12_merkle_manifest": merkle.query,
    "op13_personal_data": personal_data.query,
}

ORACLES = {
    "op4_mixture": mixture.SQL,
    "op6_line_dedup": line_dedup.SQL,
    "op12_merkle_manifest": merkle.SQL,
}
