"""Queries of this folder's operators, and their SQL where it can express them."""

from __future__ import annotations

from . import decontaminate, infilling, linkgraph, mixing, neartiles, ngramjoin, resampling, sstable, suffixdedup, surrogates, topk, toxicity, warc

QUERIES = {
    "op1_link_graph": linkgraph.op1_link_graph,
    "op2_suffix_array_dedup": suffixdedup.op2_suffix_array_dedup,
    "op3_template_decontamination": decontaminate.op3_template_decontamination,
    "op4_surrogate_generation": surrogates.op4_surrogate_generation,
    "op5_warc_round_trip": warc.op5_warc_round_trip,
    "op6_sstable_tokens": sstable.op6_sstable_tokens,
    "op7_count_rtree_join": ngramjoin.op7_count_rtree_join,
    "op8_impact_topk": topk.op8_impact_topk,
    "op9_noisy_channel_toxicity": toxicity.op9_noisy_channel_toxicity,
    "op10_pareto_mixing": mixing.op10_pareto_mixing,
    "op11_crc_resampling": resampling.op11_crc_resampling,
    "op12_pca_tiles": neartiles.op12_pca_tiles,
    "op13_fill_in_middle": infilling.op13_fill_in_middle,
}

ORACLE_SQL = {
    "op5_warc_round_trip": warc.SQL,
    "op8_impact_topk": topk.SQL,
    "op10_pareto_mixing": mixing.SQL,
    "op12_pca_tiles": neartiles.SQL,
    "op13_fill_in_middle": infilling.SQL,
}
