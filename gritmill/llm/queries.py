"""The queries of this subpackage and the SQL they must agree with."""

from __future__ import annotations

from . import decontam, html_extract, license_scan, line_dedup, mixing, near_dedup, quality, secret_scan, suffix_dedup, toxicity


def queries():
    return {
        "op1_line_dedup": line_dedup.op1_line_dedup,
        "op2_toxicity": toxicity.op2_toxicity,
        "op3_quality_rules": quality.op3_quality_rules,
        "op4_benchmark_decontamination": decontam.op4_benchmark_decontamination,
        "op5_secret_scan": secret_scan.op5_secret_scan,
        "op6_near_dedup": near_dedup.op6_near_dedup,
        "op7_html_extraction": html_extract.op7_html_extraction,
        "op8_suffix_dedup": suffix_dedup.op8_suffix_dedup,
        "op9_license_scan": license_scan.op9_license_scan,
        "op10_mixing": mixing.op10_mixing,
    }


def oracle_sql():
    return {
        "op1_line_dedup": line_dedup.OP1_SQL,
        "op3_quality_rules": quality.op3_sql(),
        "op4_benchmark_decontamination": decontam.OP4_SQL,
        "op6_near_dedup": near_dedup.OP6_SQL,
        "op9_license_scan": license_scan.op9_sql(),
        "op10_mixing": mixing.OP10_SQL,
    }
