"""Registered queries of this subpackage and the SQL that states them."""

from shiplens.llm import (
    chat_format,
    exact_dedup,
    html_extract,
    language_id,
    mixing,
    periodic,
    phrases,
    piece_codec,
    quality,
    simhash,
    topk_search,
    toxicity,
    warc,
)

QUERIES = {
    "op1_warc": warc.op1_warc,
    "op2_chat_formatting": chat_format.op2_chat_formatting,
    "op3_sentencepiece_codec": piece_codec.op3_sentencepiece_codec,
    "op4_html_extraction": html_extract.op4_html_extraction,
    "op5_soft_mixing": mixing.op5_soft_mixing,
    "op6_exact_dedup": exact_dedup.op6_exact_dedup,
    "op7_quality_classifier": quality.op7_quality_classifier,
    "op8_language_id": language_id.op8_language_id,
    "op9_exact_topk": topk_search.op9_exact_topk,
    "op10_simhash_near_dedup": simhash.op10_simhash_near_dedup,
    "op11_phrase_collocations": phrases.op11_phrase_collocations,
    "op12_periodic_runs": periodic.op12_periodic_runs,
    "op13_toxicity": toxicity.op13_toxicity,
}

# The others have no SQL: tests/llm holds them against brute force.
ORACLE: dict[str, str] = {
    "op1_warc": warc.ORACLE_SQL,
    "op2_chat_formatting": chat_format.ORACLE_SQL,
    "op6_exact_dedup": exact_dedup.ORACLE_SQL,
    "op9_exact_topk": topk_search.ORACLE_SQL,
    "op11_phrase_collocations": phrases.ORACLE_SQL,
}
