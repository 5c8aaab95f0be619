"""The queries of this subpackage, by name."""

from __future__ import annotations

from lakeshift.llm import chat, decontamination, fingerprints, language_model, line_dedup, packing, pipeline, quality, resharding, simhash, substring_dedup


def queries() -> dict:
    return {
        "op1_syncmers": fingerprints.op1_syncmers,
        "op2_backoff": language_model.op2_backoff,
        "op3_line_dedup": line_dedup.op3_line_dedup,
        "op4_quality": quality.op4_quality,
        "op5_passages": substring_dedup.op5_passages,
        "op6_pack": packing.op6_pack,
        "op7_reshard": resharding.op7_reshard,
        "op8_simhash": simhash.op8_simhash,
        "op9_decontaminate": decontamination.op9_decontaminate,
        "op10_chat": chat.op10_chat,
        "pipeline": pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {"op3_line_dedup": line_dedup.OP3_SQL}
