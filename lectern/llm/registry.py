"""The subpackage's queries, and SQL for those that SQL can express."""

from __future__ import annotations

from lectern.llm import codes, divergence, substrings, suffixes, topk
from lectern.llm.codes import op12_vector_code_compression
from lectern.llm.divergence import op11_source_divergence_audit
from lectern.llm.packing import op5_best_fit_packing
from lectern.llm.pieces import op6_sentencepiece
from lectern.llm.pii import op4_pii
from lectern.llm.quality import op13_quality_classifier
from lectern.llm.rollups import op9_token_counts
from lectern.llm.simhash import op2_simhash_near_dedup
from lectern.llm.substrings import op8_substring_dedup
from lectern.llm.suffixes import op10_suffix_array_dedup
from lectern.llm.topk import op1_exact_top_k
from lectern.llm.toxicity import op3_toxicity
from lectern.llm.vectors import op7_embedding_near_dedup

QUERIES = {
    "op1_exact_top_k": op1_exact_top_k,
    "op2_simhash_near_dedup": op2_simhash_near_dedup,
    "op3_toxicity": op3_toxicity,
    "op4_pii": op4_pii,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_embedding_near_dedup": op7_embedding_near_dedup,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_token_counts": op9_token_counts,
    "op10_suffix_array_dedup": op10_suffix_array_dedup,
    "op11_source_divergence_audit": op11_source_divergence_audit,
    "op12_vector_code_compression": op12_vector_code_compression,
    "op13_quality_classifier": op13_quality_classifier,
}
ORACLES = {"op1_exact_top_k": topk.ORACLE, "op8_substring_dedup": substrings.ORACLE, "op10_suffix_array_dedup": suffixes.ORACLE, "op11_source_divergence_audit": divergence.ORACLE, "op12_vector_code_compression": codes.ORACLE}
