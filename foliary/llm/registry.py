"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from . import bpe, extraction, jaccard, licenses, mixing, neardup, quality, suffixes, topk, toxicity
from .shared import Query


def queries() -> dict[str, Query]:
    return {
        "op1_html_extraction": extraction.query,
        "op2_voronoi_topk": topk.query,
        "op3_suffix_dedup": suffixes.query,
        "op4_pivot_permutation_neardup": neardup.query,
        "op5_bpe_round_trip": bpe.query,
        "op6_quality_classifier": quality.query,
        "op7_toxicity": toxicity.query,
        "op8_license_scan": licenses.query,
        "op9_source_mix": mixing.query,
        "op10_ngram_jaccard_join": jaccard.query,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_voronoi_topk": topk.sql(),
        "op4_pivot_permutation_neardup": neardup.sql(),
        "op8_license_scan": licenses.sql(),
        "op9_source_mix": mixing.sql(),
        "op10_ngram_jaccard_join": jaccard.sql(),
    }
