"""The operators as named queries over the benchmark tables, and their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from thermoweave.llm import (
    egojoin,
    lines,
    merkle,
    minhash,
    mixing,
    multiindex,
    orchard,
    packing,
    pagetext,
    pii,
    resampling,
    tokenfiles,
    toxicity,
)
from thermoweave.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def _over(name: str, report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: report(table(spark, sf_dir, name))


def registered() -> dict[str, Query]:
    return {
        "op1_ego_join": _over("embeddings", egojoin.near_vector_report),
        "op2_minhash_dedup": _over("documents", minhash.near_duplicate_report),
        "op3_line_dedup": _over("documents", lines.line_report),
        "op4_packing": _over("documents", packing.packing_report),
        "op5_pii": _over("documents", pii.pii_report),
        "op6_token_files": lambda spark, sf_dir: tokenfiles.token_file_report(
            spark, table(spark, sf_dir, "documents")
        ),
        "op7_mixing": lambda spark, sf_dir: mixing.mixing_report(
            table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
        ),
        "op8_multi_index": _over("embeddings", multiindex.neighbour_report),
        "op9_main_text": _over("pages", pagetext.page_report),
        "op10_toxicity": lambda spark, sf_dir: toxicity.toxicity_report(
            table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
        ),
        "op11_orchard_codes": _over("embeddings", orchard.code_report),
        "op12_merkle": _over("documents", merkle.fingerprint_report),
        "op13_resampling": lambda spark, sf_dir: resampling.resampling_report(
            table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
        ),
    }


def oracles() -> dict[str, str]:
    return {
        "op1_ego_join": egojoin.REPORT_SQL,
        "op2_minhash_dedup": minhash.REPORT_SQL,
        "op3_line_dedup": lines.REPORT_SQL,
        "op11_orchard_codes": orchard.REPORT_SQL,
        "op12_merkle": merkle.REPORT_SQL,
        "op13_resampling": resampling.REPORT_SQL,
    }
