"""The queries of this subpackage and their SQL, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, chunks, html_text, langid, neighbours, packing, quality, sharding, simhash, suffix


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_simhash": simhash.op1_simhash,
        "op2_html": html_text.op2_html,
        "op3_quality": quality.op3_quality,
        "op4_sharding": sharding.op4_sharding,
        "op5_langid": langid.op5_langid,
        "op6_chunks": chunks.op6_chunks,
        "op7_neighbours": neighbours.op7_neighbours,
        "op8_bpe": bpe.op8_bpe,
        "op9_suffix_array": suffix.op9_suffix_array,
        "op10_packing": packing.op10_packing,
    }


def oracle_sql() -> dict[str, str]:
    return {}
