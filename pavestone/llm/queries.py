"""The queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from . import chat, decontaminate, html_text, jaccard, licenses, merkle, oracles, packing, quality, resampling, sharding, substrings, token_files, warc

QUERIES = {
    "op1_html_text": html_text.op1_html_text,
    "op8_perspectives": chat.op8_perspectives,
    "op9_license_scan": licenses.op9_license_scan,
    "op2_decontamination": decontaminate.op2_decontamination,
    "op3_ngram_jaccard_join": jaccard.op3_ngram_jaccard_join,
    "op3_ngram_jaccard_links": jaccard.op3_ngram_jaccard_links,
    "op7_substring_dedup": substrings.op7_substring_dedup,
    "op5_warc": warc.op5_warc,
    "op4_sharding": sharding.op4_sharding,
    "op6_best_fit_packing": packing.op6_best_fit_packing,
    "op10_quality_rules": quality.op10_quality_rules,
    "op11_token_planes": token_files.op11_token_planes,
    "op12_merkle_manifest": merkle.op12_merkle_manifest,
    "op13_importance_resampling": resampling.op13_importance_resampling,
}

ORACLES: dict[str, str] = {
    "op2_decontamination": oracles.OP2,
    "op3_ngram_jaccard_join": oracles.OP3,
    "op7_substring_dedup": oracles.OP7,
    "op10_quality_rules": oracles.OP10,
    "op12_merkle_manifest": oracles.OP12,
    "op13_importance_resampling": oracles.OP13,
    "op8_perspectives": chat.ORACLE_OP8,
    "op9_license_scan": licenses.ORACLE_OP9,
    "op5_warc": warc.ORACLE_OP5,
}
