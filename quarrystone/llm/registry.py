"""Queries of the corpus operators and the SQL that states their results, where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quarrystone.llm import alignment, decontaminate, fingerprint, licence_scan, main_text, near_dup, passage_dedup, piece_bpe, quality, secret_scan, spelling, token_store, warc


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality": quality.op1_quality,
        "op2_fingerprints": fingerprint.op2_fingerprints,
        "op3_passages": passage_dedup.op3_passages,
        "op4_licences": licence_scan.op4_licences,
        "op5_main_text": main_text.op5_main_text,
        "op6_secrets": secret_scan.op6_secrets,
        "op7_contamination": decontaminate.op7_contamination,
        "op8_near_duplicates": near_dup.op8_near_duplicates,
        "op9_sentencepiece": piece_bpe.op9_sentencepiece,
        "op10_token_store": token_store.op10_token_store,
        "op11_warc": warc.op11_warc,
        "op12_alignment": alignment.op12_alignment,
        "op13_spelling": spelling.op13_spelling,
    }


def oracle_sql() -> dict[str, str]:
    return dict(warc.ORACLE_SQL)
