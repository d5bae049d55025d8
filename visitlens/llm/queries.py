"""The dealt operators as registered queries, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from visitlens.llm import chat_format, decontaminate, hard_negatives, jaccard_join, near_vectors, secrets
from visitlens.llm.chat_format import op9_chat_format
from visitlens.llm.decontaminate import op6_decontaminate
from visitlens.llm.hard_negatives import op11_hard_negatives
from visitlens.llm.jaccard_join import op10_jaccard_join
from visitlens.llm.lexicon_bpe import op1_lexicon_bpe
from visitlens.llm.near_vectors import op12_near_vectors
from visitlens.llm.order_minhash import op5_order_minhash
from visitlens.llm.quality import op4_compression_quality
from visitlens.llm.secrets import op2_secret_scan
from visitlens.llm.sharding import op8_sharding
from visitlens.llm.token_align import op13_token_align
from visitlens.llm.token_count import op7_token_count
from visitlens.llm.toxicity import op3_toxicity_chain

QUERIES = {
    f.__name__: f
    for f in (op1_lexicon_bpe, op2_secret_scan, op3_toxicity_chain, op4_compression_quality, op5_order_minhash,
              op6_decontaminate, op7_token_count, op8_sharding, op9_chat_format, op10_jaccard_join,
              op11_hard_negatives, op12_near_vectors, op13_token_align)
}

ORACLE = {
    "op2_secret_scan": secrets.ORACLE,
    "op6_decontaminate": decontaminate.ORACLE,
    "op9_chat_format": chat_format.ORACLE,
    "op10_jaccard_join": jaccard_join.ORACLE,
    "op11_hard_negatives": hard_negatives.ORACLE,
    "op12_near_vectors": near_vectors.ORACLE,
}
