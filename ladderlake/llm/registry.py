"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from . import decontamination, hard_negatives, html_extraction, jaccard_join, language_id, line_dedup, mixing, ngram_lm, quality_classifier, quality_rules, sharding, source_divergence, warc

QUERIES = {
    "op1_line_dedup": line_dedup.op1_line_dedup,
    "op2_language_id": language_id.op2_language_id,
    "op3_decontamination": decontamination.op3_decontamination,
    "op4_sharding": sharding.op4_sharding,
    "op5_mixing": mixing.op5_mixing,
    "op6_lm_scoring": ngram_lm.op6_lm_scoring,
    "op7_jaccard_join": jaccard_join.op7_jaccard_join,
    "op8_warc": warc.op8_warc,
    "op9_quality_rules": quality_rules.op9_quality_rules,
    "op10_quality_classifier": quality_classifier.op10_quality_classifier,
    "op11_html_extraction": html_extraction.op11_html_extraction,
    "op12_hard_negatives": hard_negatives.op12_hard_negatives,
    "op13_source_divergence": source_divergence.op13_source_divergence,
}
ORACLE_SQL = {"op1_line_dedup": line_dedup.SQL, "op8_warc": warc.SQL, "op12_hard_negatives": hard_negatives.SQL, "op13_source_divergence": source_divergence.SQL}
