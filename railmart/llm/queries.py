"""The operators' queries by name, each over its whole table, and the SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from railmart.llm import (
    chat_turns, common, language_id, mixing, ngram_join, one_bit_ann, packing, periodic, quality_rules, spelling, suffix_dedup, token_counts,
    toxicity, url_filter,
)


def shipped(query: Callable) -> Callable:
    def run(spark, sf_dir):
        common.ship(spark)
        return query(spark, sf_dir)

    return run


QUERIES = {
    "op1_one_bit_ann": shipped(one_bit_ann.query),
    "op2_chat_turns": shipped(chat_turns.query),
    "op3_mixing": shipped(mixing.query),
    "op4_toxicity": shipped(toxicity.query),
    "op5_url_filter": shipped(url_filter.query),
    "op6_quality_rules": shipped(quality_rules.query),
    "op7_packing": shipped(packing.query),
    "op8_language_id": shipped(language_id.query),
    "op9_suffix_dedup": shipped(suffix_dedup.query),
    "op10_ngram_join": shipped(ngram_join.query),
    "op11_token_counts": shipped(token_counts.query),
    "op12_spelling_variants": shipped(spelling.query),
    "op13_periodic_runs": shipped(periodic.query),
}
SQL = {"op3_mixing": mixing.SQL}
