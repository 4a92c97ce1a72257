"""Queries of this subpackage by name, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from foldmark.llm.codes import OP12_SQL, op12_vector_codes
from foldmark.llm.decontamination import op5_decontamination
from foldmark.llm.fingerprints import op9_fingerprints
from foldmark.llm.html import op1_html_text
from foldmark.llm.importance import OP11_SQL, op11_importance
from foldmark.llm.mixing import OP4_SQL, op4_mixing
from foldmark.llm.near_duplicates import op2_near_duplicates
from foldmark.llm.pii import op10_pii
from foldmark.llm.quality import op3_quality
from foldmark.llm.repeats import op7_repeats
from foldmark.llm.secrets import op13_secrets
from foldmark.llm.token_files import op6_token_files
from foldmark.llm.toxicity import op8_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_text": op1_html_text,
    "op2_near_duplicates": op2_near_duplicates,
    "op3_quality": op3_quality,
    "op4_mixing": op4_mixing,
    "op5_decontamination": op5_decontamination,
    "op6_token_files": op6_token_files,
    "op7_repeats": op7_repeats,
    "op8_toxicity": op8_toxicity,
    "op9_fingerprints": op9_fingerprints,
    "op10_pii": op10_pii,
    "op11_importance": op11_importance,
    "op12_vector_codes": op12_vector_codes,
    "op13_secrets": op13_secrets,
}

ORACLE_SQL: dict[str, str] = {"op4_mixing": OP4_SQL, "op11_importance": OP11_SQL, "op12_vector_codes": OP12_SQL}
