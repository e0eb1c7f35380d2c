"""The queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bytepairs, decontaminate, html, innerproduct, jaccard, licenses, lines, pieces, quality, ranked, secrets, toxicity, whitening

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {
    "op1_license_scan": licenses.query,
    "op2_quality_classifier": quality.query,
    "op3_sentencepiece": pieces.query,
    "op4_topk_search": innerproduct.query,
    "op5_jaccard_join": jaccard.query,
    "op6_line_dedup": lines.query,
    "op7_decontaminate": decontaminate.query,
    "op8_html_extraction": html.query,
    "op9_secret_scan": secrets.query,
    "op10_toxicity": toxicity.query,
    "op11_ranked_search": ranked.query,
    "op12_whitening": whitening.query,
    "op13_byte_bpe": bytepairs.query,
}

ORACLE: dict[str, str] = {
    "op1_license_scan": licenses.SQL,
    "op4_topk_search": innerproduct.SQL,
    "op6_line_dedup": lines.SQL,
    "op7_decontaminate": decontaminate.SQL,
    "op9_secret_scan": secrets.SQL,
    "op11_ranked_search": ranked.SQL,
}
