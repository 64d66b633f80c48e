"""The checked queries of the training-data operators: each runs one over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from spinneret.llm import (
    decontamination, fill_middle, fingerprints, html_text, importance, line_dedup, mixing, near_dups, privacy, secret_scan,
    sharding, simhash, toxicity,
)
from spinneret.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_sharding(spark, sf_dir):
    return sharding.shard_digest(table(spark, sf_dir, "documents"))


def op2_line_dedup(spark, sf_dir):
    return line_dedup.line_digest(table(spark, sf_dir, "documents"))


def op3_mixing(spark, sf_dir):
    return mixing.mix_digest(table(spark, sf_dir, "documents"))


def op4_secret_scan(spark, sf_dir):
    return secret_scan.find_secrets(table(spark, sf_dir, "documents"))


def op5_toxicity(spark, sf_dir):
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_html_text(spark, sf_dir):
    return html_text.extract_text(table(spark, sf_dir, "pages"))


def op7_privacy(spark, sf_dir):
    return privacy.private_digest(table(spark, sf_dir, "documents"))


def op8_decontamination(spark, sf_dir):
    return decontamination.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_near_dups(spark, sf_dir):
    return near_dups.near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85)


def op10_fingerprints(spark, sf_dir):
    return fingerprints.edit_digest(table(spark, sf_dir, "documents"))


def op11_fill_middle(spark, sf_dir):
    return fill_middle.fill_digest(table(spark, sf_dir, "documents"))


def op12_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), width=3, distance=3)


def op13_importance(spark, sf_dir):
    return importance.importance_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def all_queries() -> dict[str, Query]:
    listed = [
        op1_sharding, op2_line_dedup, op3_mixing, op4_secret_scan, op5_toxicity, op6_html_text, op7_privacy,
        op8_decontamination, op9_near_dups, op10_fingerprints, op11_fill_middle, op12_simhash, op13_importance,
    ]
    return {query.__name__: query for query in listed}


def all_statements() -> dict[str, str]:
    """SQL for the operators that SQL can express."""
    return {
        "op2_line_dedup": line_dedup.LINES_SQL, "op3_mixing": mixing.MIX_SQL, "op9_near_dups": near_dups.NEAR_DUPS_SQL,
        "op11_fill_middle": fill_middle.FILL_SQL,
    }
