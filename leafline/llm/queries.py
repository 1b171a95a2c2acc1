"""The queries of the operators and of the pipeline, and SQL for those that SQL can express."""

from __future__ import annotations

import corpus_pipeline
from leafline.llm import op1_tokens, op2_sharding, op3_pii, op4_mixing, op5_simhash, op6_quality, op7_packing, op8_rules, op9_media, op10_licenses, op11_divergence, op12_whitening, op13_sentencepiece

QUERIES = {
    "op1_token_counts": op1_tokens.query,
    "op2_sharding": op2_sharding.query,
    "op3_pii": op3_pii.query,
    "op4_mixing": op4_mixing.query,
    "op5_simhash": op5_simhash.query,
    "op6_quality": op6_quality.query,
    "op7_packing": op7_packing.query,
    "op8_quality_rules": op8_rules.query,
    "op9_media": op9_media.query,
    "op10_licenses": op10_licenses.query,
    "op11_divergence": op11_divergence.query,
    "op12_whitening": op12_whitening.query,
    "op13_sentencepiece": op13_sentencepiece.query,
    "pipeline": corpus_pipeline.run,
}

ORACLES: dict[str, str] = {"op2_sharding": op2_sharding.ORACLE, "op8_quality_rules": op8_rules.ORACLE, "op11_divergence": op11_divergence.ORACLE}
