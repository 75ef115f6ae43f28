"""The numbered queries of this subpackage and the SQL they are held against."""

from __future__ import annotations

from toolgraph.llm import alignment, bpe, exact_dedup, language_id, lattice_dedup, minhash, mixing, packing, passages, preference, prefix_trie, token_blocks, toxicity

QUERIES = {
    "op1_language_id": language_id.op1_language_id,
    "op2_bpe": bpe.op2_bpe,
    "op3_lattice_dedup": lattice_dedup.op3_lattice_dedup,
    "op4_preference": preference.op4_preference,
    "op5_passages": passages.op5_passages,
    "op6_token_blocks": token_blocks.op6_token_blocks,
    "op7_exact_dedup": exact_dedup.op7_exact_dedup,
    "op8_minhash": minhash.op8_minhash,
    "op9_mixing": mixing.op9_mixing,
    "op10_toxicity": toxicity.op10_toxicity,
    "op11_packing": packing.op11_packing,
    "op12_alignment": alignment.op12_alignment,
    "op13_prefix_trie": prefix_trie.op13_prefix_trie,
}
ORACLE = {
    "op3_lattice_dedup": lattice_dedup.SQL,
    "op4_preference": preference.SQL,
    "op7_exact_dedup": exact_dedup.SQL,
    "op9_mixing": mixing.SQL,
    "op13_prefix_trie": prefix_trie.SQL,
}
