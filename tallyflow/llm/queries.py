"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from tallyflow.llm import (
    chat_format,
    collocations,
    conversation_repair,
    decontamination,
    exact_dedup,
    jaccard_join,
    language_id,
    license_scan,
    lm_scoring,
    mixing,
    sharding,
    substring_dedup,
    warc,
)

QUERIES = {
    "op1_exact_dedup": exact_dedup.op1_exact_dedup,
    "op2_chat_format": chat_format.op2_chat_format,
    "op3_jaccard_join": jaccard_join.op3_jaccard_join,
    "op4_sharding": sharding.op4_sharding,
    "op5_decontamination": decontamination.op5_decontamination,
    "op6_warc": warc.op6_warc,
    "op7_license_scan": license_scan.op7_license_scan,
    "op8_mixing": mixing.op8_mixing,
    "op9_language_id": language_id.op9_language_id,
    "op10_lm_scoring": lm_scoring.op10_lm_scoring,
    "op11_collocations": collocations.op11_collocations,
    "op12_substring_dedup": substring_dedup.op12_substring_dedup,
    "op13_conversation_repair": conversation_repair.op13_conversation_repair,
}

#: Operators without an entry here are tested against a brute-force version.
ORACLE_SQL = {
    "op1_exact_dedup": exact_dedup.SQL,
    "op6_warc": warc.SQL,
    "op8_mixing": mixing.SQL,
    "op10_lm_scoring": lm_scoring.SQL,
    "op11_collocations": collocations.SQL,
    "op12_substring_dedup": substring_dedup.SQL,
}
