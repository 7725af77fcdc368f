"""The queries of this subpackage, with their SQL where SQL can state them."""

from weirgate.llm import bpe, exact_dedup, jaccard_join, main_text, manifest, mixing, phrases, pii, repeats, sharding, topk, toxicity, url_filter

QUERIES = {
    "op1_top_k_search": topk.query,
    "op2_main_text": main_text.query,
    "op3_repeats": repeats.query,
    "op4_url_filter": url_filter.query,
    "op5_jaccard_join": jaccard_join.query,
    "op6_bpe": bpe.query,
    "op7_toxicity": toxicity.query,
    "op8_mix_sources": mixing.query,
    "op9_pii": pii.query,
    "op10_exact_dedup": exact_dedup.query,
    "op11_collocations": phrases.query,
    "op12_sharding": sharding.query,
    "op13_merkle_manifest": manifest.query,
}
SQL = {
    "op1_top_k_search": topk.SQL,
    "op3_repeats": repeats.SQL,
    "op4_url_filter": url_filter.SQL,
    "op5_jaccard_join": jaccard_join.SQL,
    "op10_exact_dedup": exact_dedup.SQL,
    "op11_collocations": phrases.SQL,
    "op12_sharding": sharding.SQL,
    "op13_merkle_manifest": manifest.SQL,
}
