"""Queries of this subpackage: one opN_<name> for each operator."""

from __future__ import annotations

from spanforge.llm import bpe, change_points, fill_middle, fingerprints, language_id, license_scan, near_dedup, packing, quality, sharding, token_files, transcripts, vector_packing

QUERIES = {
    "op1_byte_network": language_id.query,
    "op2_license_templates": license_scan.query,
    "op3_backtracking_bpe": bpe.query,
    "op4_weighted_sampling": fingerprints.query,
    "op5_transcripts": transcripts.query,
    "op6_host_rules": quality.query,
    "op7_near_dedup": near_dedup.query,
    "op8_token_files": token_files.query,
    "op9_stratified_shards": sharding.query,
    "op10_best_fit": packing.query,
    "op11_vector_packing": vector_packing.query,
    "op12_fill_middle": fill_middle.query,
    "op13_change_points": change_points.query,
}

ORACLES = {
    "op6_host_rules": quality.ORACLE_SQL,
    "op9_stratified_shards": sharding.ORACLE_SQL,
    "op12_fill_middle": fill_middle.ORACLE_SQL,
    "op13_change_points": change_points.ORACLE_SQL,
}
