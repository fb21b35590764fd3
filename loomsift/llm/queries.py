"""The registered queries of this subpackage and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loomsift.llm import audit, chatformat, decontam, htmltext, langid, media, neardup, packing, quality, secrets, simhash, toxicity, vectorcodes


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_near_duplicates": neardup.op1_near_duplicates,
        "op4_secret_scan": secrets.op4_secret_scan,
        "op2_html_extraction": htmltext.op2_html_extraction,
        "op3_quality": quality.op3_quality,
        "op5_toxicity": toxicity.op5_toxicity,
        "op6_best_fit_packing": packing.op6_best_fit_packing,
        "op7_chat_formatting": chatformat.op7_chat_formatting,
        "op8_language_id": langid.op8_language_id,
        "op9_benchmark_decontamination": decontam.op9_benchmark_decontamination,
        "op10_media_columns": media.op10_media_columns,
        "op11_vector_codes": vectorcodes.op11_vector_codes,
        "op12_simhash_near_duplicates": simhash.op12_simhash_near_duplicates,
        "op13_filter_audit": audit.op13_filter_audit,
    }


def oracle_sql() -> dict[str, str]:
    return {"op11_vector_codes": vectorcodes.OP11_SQL, "op13_filter_audit": audit.OP13_SQL}
