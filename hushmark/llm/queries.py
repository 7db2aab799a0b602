"""The queries of this subpackage and the SQL that they are checked against."""

from __future__ import annotations

from hushmark.llm import (
    decontamination,
    filter_audit,
    hard_negatives,
    language_id,
    licenses,
    main_text,
    packing,
    perspectives,
    quality_classifier,
    quality_rules,
    secrets,
    simhash,
    token_counts,
)

QUERIES = {
    "op1_decontamination": decontamination.op1_decontamination,
    "op2_quality_rules": quality_rules.op2_quality_rules,
    "op3_perspectives": perspectives.op3_perspectives,
    "op4_language_id": language_id.op4_language_id,
    "op5_token_counts": token_counts.op5_token_counts,
    "op6_simhash": simhash.op6_simhash,
    "op7_license_scan": licenses.op7_license_scan,
    "op8_quality_classifier": quality_classifier.op8_quality_classifier,
    "op9_packing": packing.op9_packing,
    "op10_main_text": main_text.op10_main_text,
    "op11_secret_scan": secrets.op11_secret_scan,
    "op12_hard_negatives": hard_negatives.op12_hard_negatives,
    "op13_filter_audit": filter_audit.op13_filter_audit,
}

SQL = {
    "op1_decontamination": decontamination.ORACLE,
    "op3_perspectives": perspectives.ORACLE,
    "op7_license_scan": licenses.oracle(),
    "op11_secret_scan": secrets.oracle(),
    "op13_filter_audit": filter_audit.ORACLE,
}
