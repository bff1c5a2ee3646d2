"""The subpackage's queries and their SQL, as __spark_entry__.py registers them."""

from __future__ import annotations

from plumbline.llm import chat, jaccard, licenses, media, mixing, ngram_lm, packing, quality, token_counts, url_filter

QUERIES = {
    "op1_token_counts": token_counts.op1_token_counts,
    "op2_license_scan": licenses.op2_license_scan,
    "op3_url_filter": url_filter.op3_url_filter,
    "op4_mix_sources": mixing.op4_mix_sources,
    "op5_pack_documents": packing.op5_pack_documents,
    "op6_jaccard_join": jaccard.op6_jaccard_join,
    "op7_format_chats": chat.op7_format_chats,
    "op8_quality_rules": quality.op8_quality_rules,
    "op9_lm_score": ngram_lm.op9_lm_score,
    "op10_media_columns": media.op10_media_columns,
}
ORACLE = {
    "op2_license_scan": licenses.OP2_SQL,
    "op3_url_filter": url_filter.OP3_SQL,
    "op6_jaccard_join": jaccard.OP6_SQL,
    "op7_format_chats": chat.OP7_SQL,
    "op8_quality_rules": quality.OP8_SQL,
}
