"""The queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marketlens.llm import (chat, decontaminate, html_text, language_id, line_dedup, lsh_forest, mixing, order_minhash,
                            packing, prefix_trie, repair, token_rollup, toxicity)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_text": html_text.op1_html_text,
    "op2_mix_sources": mixing.op2_mix_sources,
    "op3_chat_format": chat.op3_chat_format,
    "op4_decontaminate": decontaminate.op4_decontaminate,
    "op5_language_id": language_id.op5_language_id,
    "op6_token_rollup": token_rollup.op6_token_rollup,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_line_dedup": line_dedup.op8_line_dedup,
    "op9_near_duplicates": lsh_forest.op9_near_duplicates,
    "op10_order_minhash": order_minhash.op10_order_minhash,
    "op11_prefix_trie": prefix_trie.op11_prefix_trie,
    "op12_repair": repair.op12_repair,
    "op13_pack": packing.op13_pack,
}

# Where SQL cannot express the result, the tests hold the query against a brute-force version.
SQL: dict[str, str] = {
    "op2_mix_sources": mixing.OP2_SQL,
    "op3_chat_format": chat.OP3_SQL,
    "op4_decontaminate": decontaminate.OP4_SQL,
    "op6_token_rollup": token_rollup.OP6_SQL,
    "op8_line_dedup": line_dedup.OP8_SQL,
    "op9_near_duplicates": lsh_forest.OP9_SQL,
    "op11_prefix_trie": prefix_trie.OP11_SQL,
    "op12_repair": repair.OP12_SQL,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
