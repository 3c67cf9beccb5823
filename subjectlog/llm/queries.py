"""The registered queries of this subpackage and their SQL twins, where SQL can express one."""

from __future__ import annotations

import importlib

_NAMES = {
    "op9_ngram_join": "ngram_join",
    "op1_secrets": "secrets",
    "op10_embedding_dedup": "hnsw",
    "op3_language": "language",
    "op5_ann": "ann",
    "op6_quality": "quality",
    "op2_mixing": "mixing",
    "op4_sentencepiece": "sentencepiece",
    "op7_substring_dedup": "substring",
    "op8_token_codes": "token_codes",
    "op11_whitening": "whitening",
    "op12_url_filter": "url_filter",
    "op13_prefix_trie": "prefix_trie",
}


def _query(name: str, module: str):
    return getattr(importlib.import_module(f"{__package__}.{module}"), name)


QUERIES = {name: _query(name, module) for name, module in _NAMES.items()}
ORACLES = {"op2_mixing": _query("OP2_SQL", "mixing"), "op13_prefix_trie": _query("OP13_SQL", "prefix_trie")}
