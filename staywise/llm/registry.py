"""Queries of the training-data operators: name -> (query, SQL or None)."""

from __future__ import annotations

from . import (exact_dedup, jaccard_join, language, lexical, line_dedup, mixing, packing, quality, repeats,
               secrets, spelling, token_counts, topk)

QUERIES = {
    "op1_packing": (packing.op1_packing, None),
    "op2_line_dedup": (line_dedup.op2_line_dedup, None),
    "op3_jaccard_join": (jaccard_join.op3_jaccard_join, None),
    "op4_exact_dedup": (exact_dedup.op4_exact_dedup, exact_dedup.SQL),
    "op5_source_mixing": (mixing.op5_source_mixing, mixing.SQL),
    "op6_secret_scan": (secrets.op6_secret_scan, None),
    "op7_token_counts": (token_counts.op7_token_counts, None),
    "op8_language_id": (language.op8_language_id, None),
    "op9_quality_classifier": (quality.op9_quality_classifier, None),
    "op10_topk_search": (topk.op10_topk_search, topk.SQL),
    "op11_spelling_variants": (spelling.op11_spelling_variants, spelling.SQL),
    "op12_suffix_dedup": (repeats.op12_suffix_dedup, repeats.SQL),
    "op13_lexical_search": (lexical.op13_lexical_search, lexical.SQL),
}
