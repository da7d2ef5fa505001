"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from almanac.llm import decontaminate, embeddings, language, lexical_search, lines, marked_words, mixing, ngram_join, quality, toxicity, urls, warc, word_runs

QUERIES = {
    "op1_mix_sources": mixing.op1_mix_sources,
    "op2_quality": quality.op2_quality,
    "op3_judge_urls": urls.op3_judge_urls,
    "op4_ngram_join": ngram_join.op4_ngram_join,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_decontaminate": decontaminate.op6_decontaminate,
    "op7_near_duplicates": embeddings.op7_near_duplicates,
    "op8_line_dedup": lines.op8_line_dedup,
    "op9_merkle_audit": warc.op9_merkle_audit,
    "op10_language_id": language.op10_language_id,
    "op11_marked_words": marked_words.op11_marked_words,
    "op12_word_runs": word_runs.op12_word_runs,
    "op13_lexical_search": lexical_search.op13_lexical_search,
}

#: What SQL cannot say (random rounding, trained models) is tested against brute force instead.
ORACLE_SQL = {
    "op3_judge_urls": urls.OP3_SQL,
    "op4_ngram_join": ngram_join.OP4_SQL,
    "op6_decontaminate": decontaminate.OP6_SQL,
    "op7_near_duplicates": embeddings.OP7_SQL,
    "op8_line_dedup": lines.OP8_SQL,
    "op9_merkle_audit": warc.OP9_SQL,
    "op13_lexical_search": lexical_search.OP13_SQL,
}
