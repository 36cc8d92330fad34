"""The registered queries of this subpackage, and DuckDB SQL where SQL expresses one."""

from trendlens.llm import op1_covertree, op2_pii, op3_paragraphs, op4_secrets, op5_mixing, op6_sharding, op7_bpe, op8_language, op9_simhash, op10_fingerprints, op11_prefix_trie, op12_alignment, op13_blocks

QUERIES = {f.__name__: f for f in (
    op1_covertree.op1_cover_trees,
    op2_pii.op2_feistel_pseudonyms,
    op3_paragraphs.op3_paragraph_minhash,
    op4_secrets.op4_multipart_secrets,
    op5_mixing.op5_soft_membership,
    op6_sharding.op6_sampled_splitters,
    op7_bpe.op7_transducer_bpe,
    op8_language.op8_cross_parsing,
    op9_simhash.op9_simhash_bktrees,
    op10_fingerprints.op10_piecewise_hashing,
    op11_prefix_trie.op11_prefix_trie,
    op12_alignment.op12_token_incidence,
    op13_blocks.op13_block_naming,
)}

ORACLE: dict[str, str] = {
    "op1_cover_trees": op1_covertree.OP1_SQL,
    "op11_prefix_trie": op11_prefix_trie.OP11_SQL,
    "op13_block_naming": op13_blocks.OP13_SQL,
}
