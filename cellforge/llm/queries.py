"""The ten queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontam, htmltext, language, lm, neardup, packing, quality, shards, substrings, tokens

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": quality.query,
    "op2_decontamination": decontam.query,
    "op3_token_counts": tokens.query,
    "op4_near_duplicates": neardup.query,
    "op5_html_text": htmltext.query,
    "op6_packing": packing.query,
    "op7_lm_scores": lm.query,
    "op8_shards": shards.query,
    "op9_repeated_windows": substrings.query,
    "op10_language": language.query,
}

ORACLES: dict[str, str] = {"op1_quality_rules": quality.ORACLE, "op9_repeated_windows": substrings.ORACLE}
