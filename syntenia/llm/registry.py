"""Queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from syntenia.llm import centroid_clusters, decision_list, decontaminate, hard_negatives, jaccard_join, language_id, licenses, line_templates, mixing, oracles, secrets, shards, token_counts, url_rules


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_latent_decontamination": decontaminate.op1_latent_decontamination,
        "op2_sharding": shards.op2_sharding,
        "op3_line_templates": line_templates.op3_line_templates,
        "op4_mixing": mixing.op4_mixing,
        "op5_token_counts": token_counts.op5_token_counts,
        "op6_decision_list": decision_list.op6_decision_list,
        "op7_secret_links": secrets.op7_secret_links,
        "op8_url_rules": url_rules.op8_url_rules,
        "op9_license_templates": licenses.op9_license_templates,
        "op10_jaccard_join": jaccard_join.op10_jaccard_join,
        "op11_language_id": language_id.op11_language_id,
        "op12_hard_negatives": hard_negatives.op12_hard_negatives,
        "op13_weighted_clusters": centroid_clusters.op13_weighted_clusters,
    }


def oracle_sql() -> dict[str, str]:
    return dict(oracles.ORACLES)
