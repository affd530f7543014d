"""The registered queries of the subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from . import (bpe, collocations, exact_dedup, importance, language_id, license_scan, line_dedup, mixing, near_dedup,
               pii, quality_model, quality_rules, substring_dedup)

QUERIES = {
    "op1_near_dedup": near_dedup.query,
    "op2_mixing": mixing.query,
    "op3_exact_dedup": exact_dedup.query,
    "op4_language_id": language_id.query,
    "op5_quality_model": quality_model.query,
    "op6_license_scan": license_scan.query,
    "op7_bpe": bpe.query,
    "op8_quality_rules": quality_rules.query,
    "op9_substring_dedup": substring_dedup.query,
    "op10_line_dedup": line_dedup.query,
    "op11_importance": importance.query,
    "op12_pii": pii.query,
    "op13_collocations": collocations.query,
}

ORACLES = {
    "op1_near_dedup": near_dedup.SQL,
    "op3_exact_dedup": exact_dedup.SQL,
    "op9_substring_dedup": substring_dedup.SQL,
    "op10_line_dedup": line_dedup.SQL,
    "op11_importance": importance.SQL,
    "op13_collocations": collocations.SQL,
}
