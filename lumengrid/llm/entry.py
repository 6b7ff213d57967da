"""The queries of this subpackage and their SQL."""

from __future__ import annotations

import corpus_pipeline

from . import bpe, centroids, chat, decontaminate, exact_dedup, language, licenses, merkle, near_dedup, pii, quality, toxicity, warc


def queries() -> dict:
    return {
        "op1_warc": warc.op1_warc,
        "op2_bpe": bpe.op2_bpe,
        "op3_exact_dedup": exact_dedup.op3_exact_dedup,
        "op4_chat": chat.op4_chat,
        "op5_quality": quality.op5_quality,
        "op6_pii": pii.op6_pii,
        "op7_decontamination": decontaminate.op7_decontamination,
        "op8_toxicity": toxicity.op8_toxicity,
        "op9_licenses": licenses.op9_licenses,
        "op10_near_dedup": near_dedup.op10_near_dedup,
        "op11_language": language.op11_language,
        "op12_merkle": merkle.op12_merkle,
        "op13_centroids": centroids.op13_centroids,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_warc": warc.SQL, "op3_exact_dedup": exact_dedup.SQL, "op4_chat": chat.SQL, "op7_decontamination": decontaminate.SQL, "op10_near_dedup": near_dedup.SQL, "op12_merkle": merkle.SQL, "op13_centroids": centroids.SQL}
