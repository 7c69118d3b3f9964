"""The queries of this subpackage and, where SQL can say the same, the SQL they are checked against."""

from __future__ import annotations

import corpus_pipeline
from plumbline.llm import chat, host_rules, html_text, mixing, packing, periodic, pii, quality, repair, simhash, suffix, token_counts, winnowing

QUERIES = {
    "op1_suffix_dedup": suffix.suffix_query,
    "op2_source_mix": mixing.mix_query,
    "op3_line_field_quality": quality.quality_query,
    "op4_token_counts": token_counts.tokens_query,
    "op5_best_fit_packing": packing.packing_query,
    "op6_simhash_groups": simhash.near_query,
    "op7_pseudonyms": pii.pii_query,
    "op8_winnowing": winnowing.winnowing_query,
    "op9_host_rules": host_rules.rules_query,
    "op10_chat_format": chat.chat_query,
    "op11_periodic_runs": periodic.runs_query,
    "op12_conversation_repair": repair.repair_query,
    "op13_html_text": html_text.html_query,
    "pipeline": corpus_pipeline.run,
}

ORACLES = {
    "op1_suffix_dedup": suffix.SUFFIX_SQL,
    "op2_source_mix": mixing.MIX_SQL,
    "op9_host_rules": host_rules.RULES_SQL,
    "op10_chat_format": chat.CHAT_SQL,
    "op12_conversation_repair": repair.REPAIR_SQL,
}
