"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from . import ann, decontam, html_text, language_model, mixing, neardup, phrases, pii, quality, runs, sharding, suffix_dedup, toxicity

QUERIES = {
    "op1_mixing": mixing.op1_mixing,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_pii": pii.op3_pii,
    "op4_neardup": neardup.op4_neardup,
    "op6_ann": ann.op6_ann,
    "op7_decontamination": decontam.op7_decontamination,
    "op5_sharding": sharding.op5_sharding,
    "op8_html_text": html_text.op8_html_text,
    "op9_suffix_dedup": suffix_dedup.op9_suffix_dedup,
    "op10_quality": quality.op10_quality,
    "op11_lm": language_model.op11_lm,
    "op12_phrases": phrases.op12_phrases,
    "op13_runs": runs.op13_runs,
}

ORACLES = {
    "op1_mixing": mixing.OP1_SQL,
    "op12_phrases": phrases.OP12_SQL,
}
