"""The queries of this subpackage, and their SQL counterparts where SQL can express them."""

from __future__ import annotations

import corpus_pipeline
from tidemark.llm import (
    op01_content_regions,
    op02_quote_threads,
    op03_dominance_packing,
    op04_nb_svm,
    op05_bloom_lookup,
    op06_cover_tree,
    op07_merge_replay,
    op08_toxicity,
    op09_bagminhash,
    op10_line_dedup,
    op11_packed_products,
    op12_prefix_join,
    op13_pair_bitmaps,
)

QUERIES = {
    "op1_content_regions": op01_content_regions.op1_content_regions,
    "op2_quote_threads": op02_quote_threads.op2_quote_threads,
    "op3_dominance_packing": op03_dominance_packing.op3_dominance_packing,
    "op4_nb_svm": op04_nb_svm.op4_nb_svm,
    "op5_bloom_lookup": op05_bloom_lookup.op5_bloom_lookup,
    "op6_cover_tree": op06_cover_tree.op6_cover_tree,
    "op7_merge_replay": op07_merge_replay.op7_merge_replay,
    "op8_levenshtein_toxicity": op08_toxicity.op8_levenshtein_toxicity,
    "op9_bagminhash": op09_bagminhash.op9_bagminhash,
    "op10_line_dedup": op10_line_dedup.op10_line_dedup,
    "op11_packed_products": op11_packed_products.op11_packed_products,
    "op12_prefix_join": op12_prefix_join.op12_prefix_join,
    "op13_pair_bitmaps": op13_pair_bitmaps.op13_pair_bitmaps,
    "pipeline": corpus_pipeline.run,
}

ORACLE = {
    "op10_line_dedup": op10_line_dedup.ORACLE_SQL,
    "op11_packed_products": op11_packed_products.ORACLE_SQL,
    "op12_prefix_join": op12_prefix_join.ORACLE_SQL,
}
