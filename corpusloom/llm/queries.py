"""Registered queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

from . import align, chat, decontam, embeddings, mixing, ngram, phrases, quality, resample, secrets, simhash, suffix, warc

QUERIES = {
    "op1_chat_format": chat.op1_chat,
    "op2_secret_scan": secrets.op2_secret_scan,
    "op3_warc": warc.op3_warc,
    "op4_suffix_array": suffix.op4_suffix_array,
    "op5_quality_rules": quality.op5_quality,
    "op6_phrases": phrases.op6_phrases,
    "op7_mixing": mixing.op7_mixing,
    "op8_kneser_ney": ngram.op8_kneser_ney,
    "op9_decontamination": decontam.op9_decontamination,
    "op10_simhash": simhash.op10_simhash,
    "op11_alignment": align.op11_alignment,
    "op12_resample": resample.op12_resample,
    "op13_embeddings": embeddings.op13_embeddings,
}

ORACLE = {
    "op1_chat_format": chat.OP1_SQL,
    "op3_warc": warc.OP3_SQL,
    "op5_quality_rules": quality.OP5_SQL,
    "op7_mixing": mixing.OP7_SQL,
    "op9_decontamination": decontam.OP9_SQL,
    "op12_resample": resample.OP12_SQL,
    "op13_embeddings": embeddings.OP13_SQL,
}
