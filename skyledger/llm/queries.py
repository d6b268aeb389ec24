"""The registered queries of the operators here, with the SQL each must equal, if any."""

from __future__ import annotations

from skyledger.llm import (
    ann,
    fingerprints,
    hard_negatives,
    html_layout,
    jaccard,
    langid,
    mixing,
    packing,
    prefix_trie,
    quality,
    rule_votes,
    toxicity,
    url_filters,
)

ENTRIES = {
    "op1_tree_budgets": (mixing.op1_tree_budgets, mixing.ORACLE),
    "op2_layout_text": (html_layout.op2_layout_text, None),
    "op3_coin_tossing": (fingerprints.op3_coin_tossing, None),
    "op4_shared_queue_forest": (ann.op4_shared_queue_forest, None),
    "op5_segment_pigeonhole": (jaccard.op5_segment_pigeonhole, None),
    "op6_concatenate_and_cut": (packing.op6_concatenate_and_cut, None),
    "op7_nearest_votes": (quality.op7_nearest_votes, None),
    "op8_redirect_rules": (url_filters.op8_redirect_rules, url_filters.ORACLE),
    "op9_naive_bayes_ratios": (toxicity.op9_naive_bayes_ratios, None),
    "op10_family_then_pairs": (langid.op10_family_then_pairs, None),
    "op11_focus_coordinates": (hard_negatives.op11_focus_coordinates, hard_negatives.ORACLE),
    "op12_rollup_prefixes": (prefix_trie.op12_rollup_prefixes, prefix_trie.ORACLE),
    "op13_rule_votes": (rule_votes.op13_rule_votes, None),
}
