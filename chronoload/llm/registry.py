"""The queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

import corpus_pipeline
from chronoload.llm import (
    align,
    bpe,
    chat,
    decontaminate,
    langid,
    licenses,
    linededup,
    pii,
    ppm,
    resample,
    simhash,
    tokenfile,
    topk,
)

QUERIES = {
    "op1_lm_scoring": ppm.query,
    "op2_decontamination": decontaminate.query,
    "op3_byte_bpe": bpe.query,
    "op4_simhash": simhash.query,
    "op5_token_files": tokenfile.query,
    "op6_personal_data": pii.query,
    "op7_line_dedup": linededup.query,
    "op8_language_id": langid.query,
    "op9_license_scan": licenses.query,
    "op10_top_k": topk.query,
    "op11_chat_formatting": chat.query,
    "op12_importance_resampling": resample.query,
    "op13_tokenizer_alignment": align.query,
    "pipeline": corpus_pipeline.run,
}

SQL = {
    "op2_decontamination": decontaminate.SQL,
    "op7_line_dedup": linededup.SQL,
    "op10_top_k": topk.SQL,
    "op11_chat_formatting": chat.SQL,
    "op12_importance_resampling": resample.SQL,
}
