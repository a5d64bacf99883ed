"""Queries of this subpackage and their SQL."""

from . import decontaminate, divergence, jaccard_join, language_id, license_scan, merkle_manifest, ngram_model, period_runs, source_mix, suffix_dedup, token_files, topk_search, url_filter

QUERIES = {
    "op1_ngram_score": ngram_model.op1_ngram_score,
    "op2_url_filter": url_filter.op2_url_filter,
    "op3_language_id": language_id.op3_language_id,
    "op4_source_mix": source_mix.op4_source_mix,
    "op5_divergence": divergence.op5_divergence,
    "op6_decontaminate": decontaminate.op6_decontaminate,
    "op7_suffix_dedup": suffix_dedup.op7_suffix_dedup,
    "op8_jaccard_join": jaccard_join.op8_jaccard_join,
    "op9_license_scan": license_scan.op9_license_scan,
    "op10_token_files": token_files.op10_token_files,
    "op11_period_runs": period_runs.op11_period_runs,
    "op12_exact_top_k": topk_search.op12_exact_top_k,
    "op13_merkle_manifest": merkle_manifest.op13_merkle_manifest,
}
ORACLE_SQL = {
    "op1_ngram_score": ngram_model.ORACLE_SQL,
    "op2_url_filter": url_filter.ORACLE_SQL,
    "op5_divergence": divergence.ORACLE_SQL,
    "op8_jaccard_join": jaccard_join.ORACLE_SQL,
    "op12_exact_top_k": topk_search.ORACLE_SQL,
    "op13_merkle_manifest": merkle_manifest.ORACLE_SQL,
}
