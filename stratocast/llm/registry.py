"""Queries of this package and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stratocast.llm import decontamination, hamming, katz, language_id, lemp, licenses, mixing, near_dedup, passages, pii, secrets, toxicity, trie


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_mixing": mixing.op1_mixing,
        "op10_hamming": hamming.op10_hamming,
        "op11_trie": trie.op11_trie,
        "op12_pii": pii.op12_pii,
        "op13_lemp": lemp.op13_lemp,
        "op2_katz": katz.op2_katz,
        "op3_passages": passages.op3_passages,
        "op4_language_id": language_id.op4_language_id,
        "op5_licenses": licenses.op5_licenses,
        "op6_decontamination": decontamination.op6_decontamination,
        "op7_near_dedup": near_dedup.op7_near_dedup,
        "op8_secrets": secrets.op8_secrets,
        "op9_toxicity": toxicity.op9_toxicity,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op11_trie": trie.ORACLE_SQL,
        "op12_pii": pii.ORACLE_SQL,
        "op13_lemp": lemp.ORACLE_SQL,
        "op5_licenses": licenses.ORACLE_SQL,
    }
