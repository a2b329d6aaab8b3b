"""The operators over the given tables, and SQL for those that SQL can express."""

from __future__ import annotations

from pageloom.llm import (
    centroids,
    decontamination,
    embedding_dups,
    html_text,
    licenses,
    mixing,
    pii,
    quality,
    resampling,
    secrets,
    simhash,
    toxicity,
    winnowing,
)

QUERIES = {
    "op1_quality": quality.query,
    "op2_decontaminate": decontamination.query,
    "op3_simhash": simhash.query,
    "op4_pii": pii.query,
    "op5_winnow": winnowing.query,
    "op6_license": licenses.query,
    "op7_toxicity": toxicity.query,
    "op8_secrets": secrets.query,
    "op9_html": html_text.query,
    "op10_mix": mixing.query,
    "op11_resample": resampling.query,
    "op12_centroids": centroids.query,
    "op13_near_embeddings": embedding_dups.query,
}

ORACLE_SQL = {
    "op2_decontaminate": decontamination.ORACLE,
    "op6_license": licenses.ORACLE,
    "op8_secrets": secrets.ORACLE,
    "op10_mix": mixing.ORACLE,
    "op11_resample": resampling.ORACLE,
    "op12_centroids": centroids.ORACLE,
}
