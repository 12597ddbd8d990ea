"""The registered queries of this subpackage and their DuckDB oracles."""

from __future__ import annotations

from . import align, classify, exact_dedup, extract, jaccard, licenses, packing, pieces, pii, quality, sharding, trie, warc

QUERIES = {
    "op1_quality_rules": quality.query,
    "op2_warc": warc.query,
    "op3_sentencepiece": pieces.query,
    "op4_license_scan": licenses.query,
    "op5_packing": packing.query,
    "op6_exact_dedup": exact_dedup.query,
    "op7_ngram_jaccard": jaccard.query,
    "op8_sharding": sharding.query,
    "op9_html_extraction": extract.query,
    "op10_pii": pii.query,
    "op11_conversation_trie": trie.query,
    "op12_quality_classifier": classify.query,
    "op13_tokenizer_alignment": align.query,
}

ORACLES = {
    "op1_quality_rules": quality.ORACLE,
    "op2_warc": warc.ORACLE,
    "op6_exact_dedup": exact_dedup.ORACLE,
    "op7_ngram_jaccard": jaccard.ORACLE,
    "op11_conversation_trie": trie.ORACLE,
}
