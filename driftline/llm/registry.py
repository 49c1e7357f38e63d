"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from driftline.llm import fmindex, htmlcrf, minhash, mixing, pii, quality, sketch, sql, substring, tokenstore, toxicity

QUERIES = {
    "op1_pii": pii.op1_pii,
    "op2_mixing": mixing.op2_mixing,
    "op3_quality": quality.op3_quality,
    "op4_near_dedup": minhash.op4_near_dedup,
    "op5_decontamination": fmindex.op5_decontamination,
    "op6_html_text": htmlcrf.op6_html_text,
    "op7_token_store": tokenstore.op7_token_store,
    "op8_fingerprints": sketch.op8_fingerprints,
    "op9_toxicity": toxicity.op9_toxicity,
    "op10_substring_dedup": substring.op10_substring_dedup,
}

#: DuckDB SQL; a query that is missing here is held against a brute-force version in tests/llm.
ORACLE: dict[str, str] = {
    "op2_mixing": mixing.ORACLE_SQL,
    "op4_near_dedup": sql.NEAR_DEDUP,
    "op5_decontamination": sql.DECONTAMINATION,
    "op8_fingerprints": sketch.ORACLE_SQL,
    "op10_substring_dedup": sql.SUBSTRING,
}
