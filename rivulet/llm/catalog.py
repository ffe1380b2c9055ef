"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from rivulet.llm.chat import OP9_SQL, op9_chat
from rivulet.llm.embedding import op7_embedding
from rivulet.llm.langid import op2_langid
from rivulet.llm.lexical import OP12_SQL, op12_lexical
from rivulet.llm.linededup import OP5_SQL, op5_line_dedup
from rivulet.llm.mixing import OP13_SQL, op13_mixing
from rivulet.llm.negatives import OP11_SQL, op11_negatives
from rivulet.llm.packing import op3_packing
from rivulet.llm.quality import op8_quality
from rivulet.llm.secrets import op10_secrets
from rivulet.llm.sharding import op6_resharding
from rivulet.llm.simhash import op4_simhash
from rivulet.llm.tokenizing import op1_byte_bpe

LLM_QUERIES = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_langid": op2_langid,
    "op3_packing": op3_packing,
    "op4_simhash": op4_simhash,
    "op5_line_dedup": op5_line_dedup,
    "op6_resharding": op6_resharding,
    "op7_embedding": op7_embedding,
    "op8_quality": op8_quality,
    "op9_chat": op9_chat,
    "op10_secrets": op10_secrets,
    "op11_negatives": op11_negatives,
    "op12_lexical": op12_lexical,
    "op13_mixing": op13_mixing,
}

#: The other operators have no SQL form; their tests compare with brute force.
LLM_ORACLE = {
    "op5_line_dedup": OP5_SQL,
    "op9_chat": OP9_SQL,
    "op11_negatives": OP11_SQL,
    "op12_lexical": OP12_SQL,
    "op13_mixing": OP13_SQL,
}
