"""Queries of this subpackage by name, with DuckDB SQL where it expresses them."""

from __future__ import annotations

from . import bpe, chat_format, decontaminate, embedding_dedup, filter_audit, langid, license_scan, line_dedup, packing, prefix_trie, sharding, simhash, toxicity

_QUERIES = {
    "op1_line_dedup": line_dedup,
    "op2_license_scan": license_scan,
    "op3_embedding_dedup": embedding_dedup,
    "op4_langid": langid,
    "op5_toxicity": toxicity,
    "op6_sharding": sharding,
    "op7_simhash": simhash,
    "op8_chat_format": chat_format,
    "op9_decontaminate": decontaminate,
    "op10_packing": packing,
    "op11_prefix_trie": prefix_trie,
    "op12_bpe": bpe,
    "op13_filter_audit": filter_audit,
}


def queries() -> dict:
    return {name: module.query for name, module in _QUERIES.items()}


def oracle_sql() -> dict:
    return {name: module.ORACLE_SQL for name, module in _QUERIES.items() if getattr(module, "ORACLE_SQL", None)}
