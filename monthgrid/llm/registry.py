"""The named queries of this subpackage, with their SQL where SQL can express them."""

from __future__ import annotations

import corpus_pipeline
from monthgrid.llm import bpe, collocation, conversation, decontaminate, extract, near_dup, perplexity, pieces, pii, pitman_yor, resample, toxicity, warc

QUERIES = {
    "pipeline": corpus_pipeline.run,
    "op1_byte_bpe": bpe.op1_byte_bpe,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_importance_resampling": resample.op3_importance_resampling,
    "op4_perplexity_bands": perplexity.op4_perplexity_bands,
    "op5_pii": pii.op5_pii,
    "op6_decontaminate": decontaminate.op6_decontaminate,
    "op7_page_differencing": extract.op7_page_differencing,
    "op8_warc": warc.op8_warc,
    "op9_minhash_near_dup": near_dup.op9_minhash_near_dup,
    "op10_pitman_yor": pitman_yor.op10_pitman_yor,
    "op11_conversation_repair": conversation.op11_conversation_repair,
    "op12_sentencepiece": pieces.op12_sentencepiece,
    "op13_phrase_collocations": collocation.op13_phrase_collocations,
}
ORACLES = {"op6_decontaminate": decontaminate.SQL, "op8_warc": warc.SQL, "op9_minhash_near_dup": near_dup.SQL,
           "op11_conversation_repair": conversation.SQL, "op13_phrase_collocations": collocation.SQL}
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL


def load():
    """(queries, oracle SQL)."""
    return QUERIES, ORACLES
