"""The queries of this package and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from . import chat, decontaminate, fim, language, license, lm, mixing, quality, rules, sharding, simhash, structure, toxicity

QUERIES = {
    "op1_benchmark_decontamination": decontaminate.op1_benchmark_decontamination,
    "op2_sharding": sharding.op2_sharding,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_language_id": language.op4_language_id,
    "op5_simhash_near_dedup": simhash.op5_simhash_near_dedup,
    "op6_mixing_to_weights": mixing.op6_mixing_to_weights,
    "op7_chat_formatting": chat.op7_chat_formatting,
    "op8_lm_scoring": lm.op8_lm_scoring,
    "op9_license_scan": license.op9_license_scan,
    "op10_quality_rules": quality.op10_quality_rules,
    "op11_quality_classifier": rules.op11_quality_classifier,
    "op12_fill_in_middle": fim.op12_fill_in_middle,
    "op13_structure_repair": structure.op13_structure_repair,
}

ORACLES = {
    "op1_benchmark_decontamination": decontaminate.ORACLE,
    "op6_mixing_to_weights": mixing.ORACLE,
    "op7_chat_formatting": chat.ORACLE,
    "op10_quality_rules": quality.ORACLE,
    "op12_fill_in_middle": fim.ORACLE,
    "op13_structure_repair": structure.ORACLE,
}
