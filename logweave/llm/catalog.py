"""The queries of this subpackage and their SQL twins."""

from __future__ import annotations

from logweave.llm import chat, decontaminate, licenses, lines, packing, passages, quality, sharding, simhash, tokens


def queries() -> dict:
    return {
        "op1_simhash": simhash.op1_simhash,
        "op2_quality_rules": quality.op2_quality_rules,
        "op3_substring_dedup": passages.op3_substring_dedup,
        "op4_sharding": sharding.op4_sharding,
        "op5_line_dedup": lines.op5_line_dedup,
        "op6_chat_format": chat.op6_chat_format,
        "op7_decontamination": decontaminate.op7_decontamination,
        "op8_license_scan": licenses.op8_license_scan,
        "op9_token_counts": tokens.op9_token_counts,
        "op10_best_fit_packing": packing.op10_best_fit_packing,
    }


def oracle_sql() -> dict:
    return {"op2_quality_rules": quality.SQL, "op5_line_dedup": lines.SQL, "op6_chat_format": chat.SQL, "op7_decontamination": decontaminate.SQL, "op8_license_scan": licenses.SQL}
