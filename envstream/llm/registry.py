"""The text operators' queries and their SQL."""

from __future__ import annotations

from envstream.llm import (
    binary, chat, counts, decontaminate, jaccard, licenses, mixing, phrases, pii, prefixes, rules,
    substring, toxicity,
)


def registered():
    queries = (
        mixing.op1_source_mixing, toxicity.op2_toxicity, substring.op3_substring_dedup,
        binary.op4_token_binary,
        counts.op5_token_counts, decontaminate.op6_benchmark_decontamination,
        rules.op7_quality_rules, chat.op8_chat_formatting, jaccard.op9_ngram_jaccard,
        pii.op10_personal_data, licenses.op11_license_scans,
        prefixes.op12_conversation_prefix_trie, phrases.op13_phrase_collocations,
    )
    return {query.__name__: query for query in queries}


def oracle():
    return {
        "op6_benchmark_decontamination": decontaminate.op6_sql(),
        "op7_quality_rules": rules.op7_sql(),
        "op9_ngram_jaccard": jaccard.op9_sql(),
        "op11_license_scans": licenses.op11_sql(),
        "op12_conversation_prefix_trie": prefixes.op12_sql(),
        "op13_phrase_collocations": phrases.op13_sql(),
    }
