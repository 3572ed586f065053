"""The registered queries of the training-data operators and their DuckDB texts where SQL expresses them."""

from __future__ import annotations

from cirrus.llm import op1_chat, op2_near, op3_substring, op4_decontaminate, op5_language, op6_mix, op7_fingerprint, op8_score, op9_pii, op10_toxicity, op11_fill, op12_trie, op13_shard

QUERIES = {
    "op1_chat": op1_chat.query,
    "op2_near": op2_near.query,
    "op3_substring": op3_substring.query,
    "op4_decontaminate": op4_decontaminate.query,
    "op5_language": op5_language.query,
    "op6_mix": op6_mix.query,
    "op7_fingerprint": op7_fingerprint.query,
    "op8_score": op8_score.query,
    "op9_pii": op9_pii.query,
    "op10_toxicity": op10_toxicity.query,
    "op11_fill": op11_fill.query,
    "op12_trie": op12_trie.query,
    "op13_shard": op13_shard.query,
}

ORACLE_SQL = {
    "op1_chat": op1_chat.ORACLE,
    "op2_near": op2_near.ORACLE,
    "op3_substring": op3_substring.ORACLE,
    "op4_decontaminate": op4_decontaminate.ORACLE,
    "op6_mix": op6_mix.ORACLE,
    "op11_fill": op11_fill.ORACLE,
    "op12_trie": op12_trie.ORACLE,
}
