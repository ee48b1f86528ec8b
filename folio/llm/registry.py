"""The queries of this subpackage and the SQL that gives the same rows, where there is some."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from folio.llm import bilinear, bpe, chat, decontaminate, fill_middle, host_quality, language, line_dedup, near_dup, secrets, tiered_search, toxicity, url_filter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": toxicity.query,
    "op2_bilinear_lm": bilinear.query,
    "op3_secrets": secrets.query,
    "op4_near_dup": near_dup.query,
    "op5_line_dedup": line_dedup.query,
    "op6_chat": chat.query,
    "op7_bpe": bpe.query,
    "op8_decontaminate": decontaminate.query,
    "op9_language": language.query,
    "op10_host_quality": host_quality.query,
    "op11_fill_middle": fill_middle.query,
    "op12_url_filter": url_filter.query,
    "op13_tiered_search": tiered_search.query,
    # quotes written into all messages
    "chat_quoted": chat.quoted_query,
    "chat_conversations": chat.transcript_query,
    # the parts of learned operators that SQL can say
    "lm_base_scores": bilinear.base_query,
    "secret_base_counts": secrets.base_query,
}

ORACLE_SQL: dict[str, str] = {
    "op4_near_dup": near_dup.SQL,
    "op5_line_dedup": line_dedup.SQL,
    "op6_chat": chat.SQL,
    "op8_decontaminate": decontaminate.SQL,
    "op10_host_quality": host_quality.SQL,
    "op11_fill_middle": fill_middle.SQL,
    "op12_url_filter": url_filter.SQL,
    "op13_tiered_search": tiered_search.SQL,
    "chat_quoted": chat.QUOTED_SQL,
    "chat_conversations": chat.TRANSCRIPT_SQL,
    "lm_base_scores": bilinear.BASE_SQL,
    "secret_base_counts": secrets.BASE_SQL,
}
