"""Queries and SQL of the training-data operators."""

from __future__ import annotations

from . import bpe, hnsw, licenses, minhash, packing, preference, quality, secrets, simhash, suffixes

QUERIES = {
    "op1_paragraph_minhash": minhash.op1_paragraph_minhash,
    "op2_gray_simhash": simhash.op2_gray_simhash,
    "op3_host_quality": quality.op3_host_quality,
    "op4_trigram_secrets": secrets.op4_trigram_secrets,
    "op5_preference_pairs": preference.op5_preference_pairs,
    "op6_license_inheritance": licenses.op6_license_inheritance,
    "op7_hnsw": hnsw.op7_hnsw,
    "op8_concatenate_and_cut": packing.op8_concatenate_and_cut,
    "op9_forced_boundary_bpe": bpe.op9_forced_boundary_bpe,
    "op10_prefix_doubling": suffixes.op10_prefix_doubling,
}
ORACLE_SQL = {
    "op5_preference_pairs": preference.SQL,
    "op6_license_inheritance": licenses.SQL,
    "op3_host_quality": quality.SQL,
}
