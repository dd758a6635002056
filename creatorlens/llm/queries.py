"""Queries of the training-data operators and their DuckDB SQL, for ``__spark_entry__``."""

from __future__ import annotations

from creatorlens.llm import arc, bpe, chat, decontaminate, jaccard, lexical, quality, repair, repeats, secrets, tokenbin, topk, urls


def pipeline(spark, sf_dir):
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_urls": urls.op1_urls,
    "op2_topk": topk.op2_topk,
    "op3_secrets": secrets.op3_secrets,
    "op4_decontaminate": decontaminate.op4_decontaminate,
    "op5_tokenbin": tokenbin.op5_tokenbin,
    "op6_quality": quality.op6_quality,
    "op7_chat": chat.op7_chat,
    "op8_jaccard": jaccard.op8_jaccard,
    "op9_warc": arc.op9_warc,
    "op10_bpe": bpe.op10_bpe,
    "op11_repeats": repeats.op11_repeats,
    "op12_search": lexical.op12_search,
    "op13_repair": repair.op13_repair,
    "pipeline": pipeline,
}

#: Queries that SQL can express; the others are tested against brute force in ``tests/llm``.
SQL: dict[str, str] = {
    "op2_topk": topk.SQL,
    "op3_secrets": secrets.SQL,
    "op7_chat": chat.SQL,
    "op8_jaccard": jaccard.SQL,
    "op9_warc": arc.SQL,
    "op11_repeats": repeats.SQL,
    "op12_search": lexical.SQL,
    "op13_repair": repair.SQL,
}
