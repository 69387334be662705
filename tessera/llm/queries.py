"""Registered queries of this package and their SQL twins."""

from tessera.llm import (fingerprints, jaccard, licenses, maxscore, merkle, mixing, packing, personal, quality, spelling,
                         suffix_dedup, tokens, window_dedup)

QUERIES = {f.__name__: f for f in (
    fingerprints.op1_document_fingerprints,
    jaccard.op2_ngram_jaccard_join,
    packing.op3_packing,
    mixing.op4_source_mixing,
    tokens.op5_token_counts,
    suffix_dedup.op6_suffix_array_dedup,
    window_dedup.op7_substring_dedup,
    licenses.op8_license_scan,
    maxscore.op9_exact_top_k,
    quality.op10_quality_classifier,
    personal.op11_personal_data,
    spelling.op12_spelling_variants,
    merkle.op13_merkle_manifest,
)}

ORACLES = {
    "op2_ngram_jaccard_join": jaccard.OP2_SQL,
    "op4_source_mixing": mixing.OP4_SQL,
    "op6_suffix_array_dedup": suffix_dedup.OP6_SQL,
    "op7_substring_dedup": window_dedup.OP7_SQL,
    "op9_exact_top_k": maxscore.OP9_SQL,
    "op12_spelling_variants": spelling.OP12_SQL,
    "op13_merkle_manifest": merkle.OP13_SQL,
}
