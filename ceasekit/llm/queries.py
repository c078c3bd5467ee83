"""Queries of the operators and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from ceasekit.llm import (
    block_search,
    centroids,
    classifier,
    decontaminate,
    fill_in_middle,
    fixity,
    mixing,
    near_dedup,
    pii,
    quality,
    sharding,
    suffix_dedup,
    url_filter,
)

QUERIES = {
    "op1_mix_sources": mixing.op1_mix_sources,
    "op2_shard": sharding.op2_shard,
    "op3_quality_rules": quality.op3_quality_rules,
    "op4_decontaminate": decontaminate.op4_decontaminate,
    "op5_url_filter": url_filter.op5_url_filter,
    "op6_quality_classifier": classifier.op6_quality_classifier,
    "op7_near_dedup": near_dedup.op7_near_dedup,
    "op8_fixity_audit": fixity.op8_fixity_audit,
    "op9_suffix_dedup": suffix_dedup.op9_suffix_dedup,
    "op10_personal_data": pii.op10_personal_data,
    "op11_fill_in_middle": fill_in_middle.op11_fill_in_middle,
    "op12_nearest_neighbours": block_search.op12_nearest_neighbours,
    "op13_centroids": centroids.op13_centroids,
}

SQL = {
    "op1_mix_sources": mixing.OP1_SQL,
    "op4_decontaminate": decontaminate.OP4_SQL,
    "op8_fixity_audit": fixity.OP8_SQL,
    "op11_fill_in_middle": fill_in_middle.OP11_SQL,
    "op12_nearest_neighbours": block_search.OP12_SQL,
    "op13_centroids": centroids.OP13_SQL,
}
