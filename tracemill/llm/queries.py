"""The registered queries of the corpus operators and the SQL of those that SQL can express."""

from __future__ import annotations

from tracemill.llm import centroid_clustering, chain_dedup, decontaminate, exact_dedup, hard_negatives, html_extraction, jaccard_join, language_id, license_scan, packing, recurrent_lm, substring_dedup, warc

QUERIES = {
    "op1_license_scan": license_scan.op1_license_scan,
    "op2_language_id": language_id.op2_language_id,
    "op3_ngram_jaccard_join": jaccard_join.op3_ngram_jaccard_join,
    "op4_substring_chain_dedup": chain_dedup.op4_substring_chain_dedup,
    "op5_benchmark_decontamination": decontaminate.op5_benchmark_decontamination,
    "op6_exact_dedup": exact_dedup.op6_exact_dedup,
    "op7_recurrent_lm": recurrent_lm.op7_recurrent_lm,
    "op8_best_fit_packing": packing.op8_best_fit_packing,
    "op9_warc": warc.op9_warc,
    "op10_substring_dedup": substring_dedup.op10_substring_dedup,
    "op11_html_extraction": html_extraction.op11_html_extraction,
    "op12_centroid_clustering": centroid_clustering.op12_centroid_clustering,
    "op13_hard_negatives": hard_negatives.op13_hard_negatives,
}
ORACLES = {
    "op3_ngram_jaccard_join": jaccard_join.ORACLE,
    "op6_exact_dedup": exact_dedup.ORACLE,
    "op9_warc": warc.ORACLE,
    "op10_substring_dedup": substring_dedup.ORACLE,
    "op12_centroid_clustering": centroid_clustering.ORACLE,
    "op13_hard_negatives": hard_negatives.ORACLE,
}
