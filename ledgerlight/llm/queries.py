"""The queries of this subpackage by name, and SQL for those that SQL can express."""

from __future__ import annotations

from ledgerlight.llm import capfilters, chat, compression, language, lines, merkle, mixing, packing, pii, quality, similarity, substrings, whitening

QUERIES = {
    "op1_jaccard_join": similarity.op1_jaccard_join,
    "op2_line_dedup": lines.op2_line_dedup,
    "op3_chat_format": chat.op3_chat_format,
    "op4_substring_dedup": substrings.op4_substring_dedup,
    "op5_quality_rules": quality.op5_quality_rules,
    "op6_personal_data": pii.op6_personal_data,
    "op7_language_id": language.op7_language_id,
    "op8_pack_documents": packing.op8_pack_documents,
    "op9_near_vectors": capfilters.op9_near_vectors,
    "op10_mix_sources": mixing.op10_mix_sources,
    "op11_quality_classifier": compression.op11_quality_classifier,
    "op12_merkle_manifest": merkle.op12_merkle_manifest,
    "op13_whiten_embeddings": whitening.op13_whiten_embeddings,
}
ORACLES = {"op2_line_dedup": lines.SQL, "op10_mix_sources": mixing.SQL, "op12_merkle_manifest": merkle.SQL}
