"""The queries of the training-data operators and their SQL."""

from __future__ import annotations

from . import decontamination, langid, mixing, ngram_join, prefix_trie, quality, secrets, spelling, token_counts, token_files, toxicity, vectors, warc

QUERIES = {
    "op1_vectors": vectors.op1_vectors,
    "op2_ngram_join": ngram_join.op2_ngram_join,
    "op3_langid": langid.op3_langid,
    "op4_secrets": secrets.op4_secrets,
    "op5_token_files": token_files.op5_token_files,
    "op6_mix": mixing.op6_mix,
    "op7_quality": quality.op7_quality,
    "op8_token_counts": token_counts.op8_token_counts,
    "op9_warc": warc.op9_warc,
    "op10_decontamination": decontamination.op10_decontamination,
    "op11_toxicity": toxicity.op11_toxicity,
    "op12_prefix_trie": prefix_trie.op12_prefix_trie,
    "op13_spelling": spelling.op13_spelling,
}

SQL = {"op6_mix": mixing.SQL, "op9_warc": warc.SQL, "op10_decontamination": decontamination.SQL, "op12_prefix_trie": prefix_trie.SQL, "op13_spelling": spelling.SQL}
