"""Queries of the corpus operators and, where SQL can express them, their SQL."""

from __future__ import annotations

import corpus_pipeline
from recordloom.llm import (
    decontaminate, htmltext, licenses, mixing, neardup, pii, quality, runs, sharding, substrings, treeweight, urlfilter, whitening,
)

QUERIES = {
    "op1_mixing": mixing.op1,
    "op2_decontamination": decontaminate.op2,
    "op10_html_extraction": htmltext.op10,
    "op3_minhash_near_dedup": neardup.op3,
    "op4_quality_rules": quality.op4,
    "op5_license_scans": licenses.op5,
    "op6_sharding": sharding.op6,
    "op7_url_filters": urlfilter.op7,
    "op8_suffix_array_dedup": substrings.op8,
    "op9_pii": pii.op9,
    "op11_embedding_whitening": whitening.op11,
    "op12_periodic_runs": runs.op12,
    "op13_lm_scoring": treeweight.op13,
    "pipeline": corpus_pipeline.run,
}

ORACLES = {
    "op2_decontamination": decontaminate.ORACLE,
    "op3_minhash_near_dedup": neardup.ORACLE,
    "op4_quality_rules": quality.ORACLE,
    "op7_url_filters": urlfilter.ORACLE,
    "op8_suffix_array_dedup": substrings.ORACLE,
}
