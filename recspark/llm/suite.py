"""The registered queries of this subpackage and, where SQL can express one, the same result in SQL."""

from __future__ import annotations

import corpus_pipeline

from . import bpe, chat, language, lines, mixing, periodic, perplexity, rules, simhash, sketches, toxicity, urls, whitening

QUERIES = {
    "op1_perplexity": perplexity.op1_perplexity,
    "op2_document_sketch": sketches.op2_document_sketch,
    "op3_url_filter": urls.op3_url_filter,
    "op4_line_dedup": lines.op4_line_dedup,
    "op5_chat_format": chat.op5_chat_format,
    "op6_byte_bpe": bpe.op6_byte_bpe,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_simhash": simhash.op8_simhash,
    "op9_pareto_mix": mixing.op9_pareto_mix,
    "op10_host_rules": rules.op10_host_rules,
    "op11_periodic_runs": periodic.op11_periodic_runs,
    "op12_whitening": whitening.op12_whitening,
    "op13_language_id": language.op13_language_id,
    "pipeline": corpus_pipeline.run,
}

ORACLES = {
    "op3_url_filter": urls.ORACLE,
    "op5_chat_format": chat.ORACLE,
    "op9_pareto_mix": mixing.ORACLE,
    "op10_host_rules": rules.ORACLE,
}
