"""The registered queries of this package and their check queries."""

from __future__ import annotations

from claimlens.llm import (
    op1_pii,
    op2_spotsigs,
    op3_quality_gam,
    op4_bpe_automaton,
    op5_suffix_dedup,
    op6_chosen_path_join,
    op7_license_scan,
    op8_url_filter,
    op9_best_fit_packing,
    op10_va_topk,
    op11_weak_supervision,
    op12_angular_negatives,
    op13_chebyshev_whitening,
)

QUERIES = {
    "op1_pii": op1_pii.query,
    "op2_spotsigs": op2_spotsigs.query,
    "op3_quality_gam": op3_quality_gam.query,
    "op4_bpe_automaton": op4_bpe_automaton.query,
    "op5_suffix_dedup": op5_suffix_dedup.query,
    "op6_chosen_path_join": op6_chosen_path_join.query,
    "op7_license_scan": op7_license_scan.query,
    "op8_url_filter": op8_url_filter.query,
    "op9_best_fit_packing": op9_best_fit_packing.query,
    "op10_va_topk": op10_va_topk.query,
    "op11_weak_supervision": op11_weak_supervision.query,
    "op12_angular_negatives": op12_angular_negatives.query,
    "op13_chebyshev_whitening": op13_chebyshev_whitening.query,
}

ORACLES = {
    "op10_va_topk": op10_va_topk.oracle(),
    "op12_angular_negatives": op12_angular_negatives.oracle(),
    "op8_url_filter": op8_url_filter.oracle(),
}
