"""The registered queries of the numbered operators and their DuckDB SQL."""

from __future__ import annotations

import importlib

MODULES = {
    "op2_ngram_join": "ngram_join",
    "op5_quality_rules": "quality_rules",
    "op9_pii": "pii",
    "op3_warc": "warc",
    "op10_html_text": "html_text",
    "op6_embedding_dedup": "embedding_dedup",
    "op8_packing": "packing",
    "op4_sentencepiece": "sentencepiece_fst",
    "op7_kneser_ney": "kneser_ney",
    "op1_substring_dedup": "substring_dedup",
    "op11_best_fit_shards": "best_fit_shards",
    "op12_whitening": "whitening",
    "op13_prefix_trie": "prefix_trie",
}


def _of(name: str):
    return importlib.import_module(f"rankwell.llm.{MODULES[name]}")


def all_queries() -> dict:
    return {name: getattr(_of(name), name) for name in MODULES}


def all_oracles() -> dict:
    return {name: _of(name).ORACLE_SQL for name in MODULES if getattr(_of(name), "ORACLE_SQL", None)}
