"""The operators applied to whole tables, and the SQL each must equal where SQL can express it."""

from __future__ import annotations

from tramline.llm import (
    alignment,
    centroids,
    chat,
    exact,
    mixing,
    near,
    packing,
    paragraphs,
    quality,
    repeats,
    simhash,
    suffix_tree,
    toxicity,
)

QUERIES = {
    "op1_mixing": mixing.op1_mixing,
    "op2_packing": packing.op2_packing,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_substring_dedup": paragraphs.op4_substring_dedup,
    "op5_minhash_near_dedup": near.op5_minhash_near_dedup,
    "op6_exact_dedup": exact.op6_exact_dedup,
    "op7_lm_scoring": suffix_tree.op7_lm_scoring,
    "op8_suffix_array_dedup": repeats.op8_suffix_array_dedup,
    "op9_chat_formatting": chat.op9_chat_formatting,
    "op10_quality_rules": quality.op10_quality_rules,
    "op11_centroid_clustering": centroids.op11_centroid_clustering,
    "op12_cross_tokenizer_alignment": alignment.op12_cross_tokenizer_alignment,
    "op13_simhash_near_dedup": simhash.op13_simhash_near_dedup,
}

ORACLE = {
    "op6_exact_dedup": exact.OP6_SQL,
    "op9_chat_formatting": chat.OP9_SQL,
    "op10_quality_rules": quality.OP10_SQL,
    "op11_centroid_clustering": centroids.OP11_SQL,
}
