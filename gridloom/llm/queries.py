"""The corpus queries and their SQL, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gridloom.llm import exact_dedup, fingerprint, packing, pieces, pii, probminhash, secrets, toxicity, url_filter, warc


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_packing": packing.op1_packing,
        "op2_pii": pii.op2_pii,
        "op3_pieces": pieces.op3_pieces,
        "op4_warc": warc.op4_warc,
        "op5_fingerprints": fingerprint.op5_fingerprints,
        "op6_secrets": secrets.op6_secrets,
        "op7_url_filter": url_filter.op7_url_filter,
        "op8_near_dedup": probminhash.op8_near_dedup,
        "op9_toxicity": toxicity.op9_toxicity,
        "op10_exact_dedup": exact_dedup.op10_exact_dedup,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_pii": pii.ORACLE, "op4_warc": warc.ORACLE, "op6_secrets": secrets.ORACLE, "op7_url_filter": url_filter.ORACLE, "op10_exact_dedup": exact_dedup.ORACLE}
