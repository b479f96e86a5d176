"""The queries of this subpackage, by name, and the SQL of those that SQL can express."""

from leafloom.llm import ann, ctw, html_text, jaccard, langid, mix, pieces, quality, topk, warc

QUERIES = {
    "op1_ivf_pq": ann.op1_ivf_pq,
    "op2_crf_language": langid.op2_crf_language,
    "op3_ordinal_quality": quality.op3_ordinal_quality,
    "op4_warc_derivatives": warc.op4_warc_derivatives,
    "op5_ngram_jaccard": jaccard.op5_ngram_jaccard,
    "op6_context_tree": ctw.op6_context_tree,
    "op7_maxscore_topk": topk.op7_maxscore_topk,
    "op8_main_text": html_text.op8_main_text,
    "op9_merge_dropout": pieces.op9_merge_dropout,
    "op10_source_mix": mix.op10_source_mix,
}

ORACLE_SQL = {
    "op5_ngram_jaccard": jaccard.OP5_SQL,
    "op7_maxscore_topk": topk.OP7_SQL,
}
