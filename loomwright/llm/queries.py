"""The queries opN_<name> and their DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from . import bpe, conversation_repair, exact_dedup, filter_audit, fingerprints, language_model, license_scan, mixing, ngram_join, rank_bpe, token_counts, token_files, toxicity

QUERIES = {
    "op1_fingerprints": fingerprints.op1_fingerprints,
    "op2_language_model": language_model.op2_language_model,
    "op3_license_scan": license_scan.op3_license_scan,
    "op4_bpe": bpe.op4_bpe,
    "op5_ngram_join": ngram_join.op5_ngram_join,
    "op6_token_counts": token_counts.op6_token_counts,
    "op7_token_files": token_files.op7_token_files,
    "op8_toxicity": toxicity.op8_toxicity,
    "op9_mixing": mixing.op9_mixing,
    "op10_exact_dedup": exact_dedup.op10_exact_dedup,
    "op11_rank_bpe": rank_bpe.op11_rank_bpe,
    "op12_filter_audit": filter_audit.op12_filter_audit,
    "op13_conversation_repair": conversation_repair.op13_conversation_repair,
}

ORACLE_SQL = {
    "op3_license_scan": license_scan.ORACLE,
    "op9_mixing": mixing.ORACLE,
    "op10_exact_dedup": exact_dedup.ORACLE,
    "op12_filter_audit": filter_audit.ORACLE,
    "op13_conversation_repair": conversation_repair.ORACLE,
}
