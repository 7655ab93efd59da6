"""Registered queries of the training-data operators and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from seawake.llm import chat, decontam, packing, pii, pseudolm, quality, repair, rules, search, secrets, simhash, toxicity, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_chat_format": chat.op2_chat_format,
    "op3_secrets": secrets.op3_secrets,
    "op4_warc": warc.op4_warc,
    "op5_packing": packing.op5_packing,
    "op6_pseudo_likelihood": pseudolm.op6_pseudo_likelihood,
    "op7_quality_rules": rules.op7_quality_rules,
    "op8_simhash": simhash.op8_simhash,
    "op9_quality": quality.op9_quality,
    "op10_decontamination": decontam.op10_decontamination,
    "op11_repair": repair.op11_repair,
    "op12_search": search.op12_search,
    "op13_personal_data": pii.op13_personal_data,
}

# The other operators have no SQL form; tests/llm holds them against brute force,
# exact round trips or held-out accuracy.
ORACLE: dict[str, str] = {
    "op2_chat_format": chat.ORACLE,
    "op4_warc": warc.ORACLE,
    "op7_quality_rules": rules.ORACLE,
    "op11_repair": repair.ORACLE,
    "op12_search": search.ORACLE,
}
